"""SentencePiece encoding of merge-type (BPE) models by a score-ordered agenda, checked against the library.

A text is normalised as the model says, cut into characters, and every pair of neighbouring symbols whose join is a
piece goes on an agenda ordered by the piece's score (ties: the pair further left). The best pair is merged, stale
entries are skipped, and only the two new neighbour pairs are added. Symbols that are no piece fall back to their
UTF-8 bytes. Each Arrow batch is also encoded by the sentencepiece library, and `agrees` says whether the two match.

The new stretches of a slice have an agenda each. Those of like length are worked through in step, in arrays: a step
takes the best pair off every agenda, merges it and offers its two new neighbour pairs. Long stretches, and lengths of
which a slice holds few, have a heap each.

Defined cases: a null or empty text gives no ids and an empty decoded text; a text of any length is encoded whole;
equal texts give equal ids. Other columns of the frame are left as they are, whatever their names.
"""

from __future__ import annotations

import heapq
import re
from bisect import bisect_right
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

#: The model's word boundary mark, which stands for a space.
SPACE = "▁"

OUT = "struct<ids: array<int>, decoded: string, agrees: boolean>"

#: Characters of text in Python at once; a longer text is a slice of its own.
SLICE_CHARS = 4_000_000

#: Stretches whose ids a worker keeps for its later batches; when there are more it forgets them all, which costs
#: time and no result.
KEEP_STRETCHES = 400_000
SEEN: dict[bytes, bytes] = {}

#: Stretches of up to so many characters are worked through in step with others up to that width, if there are at
#: least IN_STEP of them, some BLOCK characters at once. Places in an agenda entry take PLACE_BITS bits.
WIDTHS = (4, 6, 8, 10, 12, 16, 24, 32, 48)
IN_STEP = 100
BLOCK = 200_000
PLACE_BITS = 8

#: An agenda entry that stands for no pair.
NONE = np.iinfo(np.int64).max

IDS = np.dtype("<i4")


class Model:
    """Pieces of a merge-type model with their ids and scores, and what its normaliser does."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        if proto.trainer_spec.model_type != sentencepiece_model_pb2.TrainerSpec.BPE:
            raise ValueError("only merge-type (BPE) models are encoded by the agenda")
        spec = proto.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("the agenda is written for identity normalisation with a leading mark")
        kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
        # Pieces that merges may make, as the library takes them: normal, user-defined and unused pieces.
        mergeable = (kinds.NORMAL, kinds.USER_DEFINED, kinds.UNUSED)
        self.score = {p.piece: p.score for p in proto.pieces if p.type in mergeable}
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type in mergeable}
        self.byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == kinds.BYTE}
        self.unk = next(i for i, p in enumerate(proto.pieces) if p.type == kinds.UNKNOWN)
        self.prefix = spec.add_dummy_prefix
        self.escape = spec.escape_whitespaces
        # Merges never cross a place where a mark follows another character if no piece holds such a place, nor one
        # between two bytes that no piece has at the end of a character and the start of the next: each stretch
        # between such places is encoded alone, and once per batch.
        self.cuts = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.score)
        apart = np.ones((256, 256), bool)
        apart[:, 0x80:0xC0] = False
        for a, b in {p[i : i + 2] for p in self.score for i in range(len(p) - 1)}:
            apart[a.encode("utf-8")[-1], b.encode("utf-8")[0]] = False
        self.apart = apart.ravel()
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.number_symbols()

    def number_symbols(self) -> None:
        """Numbers for the symbols that merges meet, and every mergeable pair with its rank and what it becomes."""
        number = {p: i for i, p in enumerate(self.score)}
        for p in self.score:
            for c in p:
                number.setdefault(c, len(number))
        # One more number stands for characters in no piece and for places outside a stretch; it is in no pair.
        self.blank = len(number)
        self.number_of = np.full(0x110000, self.blank, np.int32)
        for p, i in number.items():
            if len(p) == 1:
                self.number_of[ord(p)] = i
        self.id_of = np.full(self.blank + 1, -1, np.int32)
        self.id_of[: len(self.score)] = list(self.ids.values())
        rank = {s: r for r, s in enumerate(sorted(set(self.score.values()), reverse=True))}
        pairs = sorted(
            (number[p[:i]] * (self.blank + 1) + number[p[i:]], rank[s], number[p])
            for p, s in self.score.items() for i in range(1, len(p)) if p[:i] in number and p[i:] in number
        )
        # The last row ends the search for pairs beyond all others.
        pairs.append(((self.blank + 1) ** 2, 0, self.blank))
        self.pairs, ranks, self.joins = (np.array(x, np.int64) for x in zip(*pairs))
        self.entries = ranks << PLACE_BITS

    def normalise(self, texts: pa.Array) -> pa.Array:
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if self.escape:
            texts = pc.replace_substring(texts, " ", SPACE)
        if self.prefix:
            marked = pc.binary_join_element_wise(pa.scalar(SPACE, pa.large_string()), texts, pa.scalar("", pa.large_string()))
            texts = pc.if_else(pc.equal(texts, ""), texts, marked)
        return texts

    def stretches(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """All stretches of normalised texts, and how many of them stand before each text and in all."""
        offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
        if offsets[0] == offsets[-1]:
            return pa.array([], pa.large_string()), np.zeros(len(texts) + 1, np.int64)
        bytes_ = texts.buffers()[2].slice(int(offsets[0]), int(offsets[-1] - offsets[0]))
        data, offsets = np.frombuffer(bytes_, np.uint8), offsets - offsets[0]
        cut = np.zeros(len(data), bool)
        cut[1:] = self.apart[data[:-1].astype(np.uint16) << 8 | data[1:]]
        if self.cuts and len(data) > 2:
            a, b, c = SPACE.encode("utf-8")
            mark = (data[:-2] == a) & (data[1:-1] == b) & (data[2:] == c)
            cut[:-2] |= mark
            cut[3:-2] &= ~(mark[:-3] & mark[3:])
        cut[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(cut)
        out = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, len(data))), bytes_)
        return out, np.searchsorted(starts, offsets)

    def spell(self, char: str) -> list[int]:
        """Ids of a character that is no piece."""
        return [self.byte_ids[b] for b in char.encode("utf-8")] if self.byte_ids else [self.unk]

    def merge(self, text: str) -> list[int]:
        """Ids of a normalised stretch by the agenda of neighbour pairs."""
        symbols = list(text)
        n = len(symbols)
        if not n:
            return []
        score, push, pop = self.score.get, heapq.heappush, heapq.heappop
        prev, nxt = list(range(-1, n - 1)), list(range(1, n + 1))
        nxt[-1] = -1
        agenda: list[tuple[float, int, str, str]] = []
        for i in range(n - 1):
            found = score(symbols[i] + symbols[i + 1])
            if found is not None:
                agenda.append((-found, i, symbols[i], symbols[i + 1]))
        heapq.heapify(agenda)
        while agenda:
            _, left, a, b = pop(agenda)
            right = nxt[left]
            # Skip entries whose symbols have changed since they were offered.
            if right < 0 or symbols[left] != a or symbols[right] != b:
                continue
            joined = symbols[left] = a + b
            symbols[right] = ""
            after = nxt[left] = nxt[right]
            before = prev[left]
            if after >= 0:
                prev[after] = left
                found = score(joined + symbols[after])
                if found is not None:
                    push(agenda, (-found, left, joined, symbols[after]))
            if before >= 0:
                found = score(symbols[before] + joined)
                if found is not None:
                    push(agenda, (-found, before, symbols[before], joined))
        out: list[int] = []
        i = 0
        while i >= 0:
            piece = symbols[i]
            found = self.ids.get(piece)
            if found is not None:
                out.append(found)
            else:
                out.extend(self.spell(piece))
            i = nxt[i]
        return out

    def offer(self, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Agenda entries of neighbour pairs, best lowest and ties by place, and what each pair becomes."""
        pair = left.astype(np.int64) * (self.blank + 1) + right
        at = np.searchsorted(self.pairs, pair)
        return np.where(self.pairs[at] == pair, self.entries[at] + place, NONE), self.joins[at]

    def merge_in_step(self, stretches: list[str], width: int) -> list[bytes]:
        """Ids of normalised stretches of at most `width` characters, an agenda each, the best of all taken at once.

        Arrays have a row for each place and a column for each stretch, flattened; a blank row follows the last place
        and stands before the first.
        """
        n = len(stretches)
        lengths = np.fromiter(map(len, stretches), np.int64, n)
        padded = "".join([s.ljust(width) for s in stretches])
        points = np.frombuffer(padded.encode("utf-32-le"), "<u4").reshape(n, width).T
        places = np.arange(width + 1)[:, None]
        alive = places[:-1] < lengths
        symbols = np.full((width + 1, n), self.blank, np.int64)
        symbols[:-1][alive] = self.number_of[points[alive]]
        agenda = np.full((width + 1, n), NONE)
        joins = np.empty((width + 1, n), np.int64)
        agenda[:-1], joins[:-1] = self.offer(symbols[:-1], symbols[1:], places[:-1])
        prev = np.repeat(np.roll(places, 1), n)
        nxt = np.repeat(np.minimum(places + 1, width), n)
        symbols, entries, joins, alive = symbols.ravel(), agenda.ravel(), joins.ravel(), alive.ravel()
        while True:
            best = agenda.min(axis=0)
            live = np.flatnonzero(best < NONE)
            if not len(live):
                break
            place = best[live] & ((1 << PLACE_BITS) - 1)
            left = place * n + live
            right = nxt[left] * n + live
            before, after = prev[left], nxt[right]
            joined = symbols[left] = joins[left]
            alive[right] = False
            entries[right] = NONE
            nxt[left] = after
            after = after * n + live
            prev[after] = place
            entries[left], joins[left] = self.offer(joined, symbols[after], place)
            at = before * n + live
            entries[at], joins[at] = self.offer(symbols[at], joined, before)
        # What is left of each stretch, one after another: ids, and characters in no piece as -1 minus their number.
        alive = alive.reshape(width, n).T
        points = points.T[alive]
        ids = self.id_of[symbols.reshape(width + 1, n)[:-1].T[alive]]
        sizes = np.ones(len(ids), np.int64)
        odd = np.flatnonzero(ids < 0)
        if len(odd):
            known, which = np.unique(points[odd], return_inverse=True)
            spelled = [self.spell(chr(c)) for c in known]
            sizes[odd] = np.array([len(s) for s in spelled])[which]
            starts = np.cumsum(sizes) - sizes
            ids = np.repeat(ids, sizes)
            for k in range(max(map(len, spelled))):
                has = np.flatnonzero(sizes[odd] > k)
                ids[starts[odd[has]] + k] = np.array([s[k] if k < len(s) else -1 for s in spelled])[which[has]]
        ends = np.cumsum(sizes)[np.cumsum(alive.sum(axis=1)) - 1] * IDS.itemsize
        flat = ids.astype(IDS).tobytes()
        return [flat[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def merge_all(self, stretches: list[str]) -> dict[str, bytes]:
        """Ids of distinct normalised stretches."""
        stretches.sort(key=len)
        out: dict[str, bytes] = {}
        start = bisect_right(stretches, 0, key=len)
        for width in WIDTHS:
            end = bisect_right(stretches, width, key=len)
            if end - start >= IN_STEP:
                step = BLOCK // width
                for i in range(start, end, step):
                    some = stretches[i : min(i + step, end)]
                    out.update(zip(some, self.merge_in_step(some, width)))
                start = end
        for s in stretches:
            if s not in out:
                out[s] = np.array(self.merge(s), IDS).tobytes()
        return out

    def encode_all(self, texts: pa.Array, seen: dict[bytes, bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts, one text after another, and where each text's begin; `seen` keeps stretches encoded."""
        stretches, before = self.stretches(self.normalise(texts))
        coded = stretches.dictionary_encode()
        distinct = coded.dictionary.cast(pa.large_binary()).to_pylist()
        new = self.merge_all([s.decode("utf-8") for s in distinct if s not in seen])
        seen.update((s.encode("utf-8"), ids) for s, ids in new.items())
        found = [seen[s] for s in distinct]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // IDS.itemsize
        which = coded.indices.to_numpy()
        ends = np.cumsum(sizes[which])
        shift = (np.cumsum(sizes) - sizes)[which] - ends + sizes[which]
        ids = np.frombuffer(b"".join(found), IDS)[np.repeat(shift, sizes[which]) + np.arange(ends[-1] if len(ends) else 0)]
        return ids, np.append(0, ends)[before]

    def encode(self, text: str | None, seen: dict[bytes, bytes] | None = None) -> list[int]:
        """Ids of a whole text; `seen` keeps the stretches already encoded."""
        return self.encode_all(pa.array([text], pa.string()), {} if seen is None else seen)[0].tolist()


@lru_cache(maxsize=2)
def load(path: str) -> Model:
    return Model(path)


def encode(text: str | Column, path: str) -> Column:
    """A struct of ids (the agenda's), the library's decoding of them, and whether the library encodes alike.

    A batch is worked through in slices of at most SLICE_CHARS characters, so that Python lists never hold more
    than one slice; the stretches already encoded are kept by the worker for its later slices and batches.
    """

    @arrow_udf(OUT)
    def run(texts: pa.Array) -> pa.Array:
        model = load(path)
        parts, start = [], 0
        lengths = pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False) if len(texts) else []
        while start < len(texts):
            end, size = start, 0
            while end < len(texts) and (end == start or size + lengths[end] <= SLICE_CHARS):
                size += lengths[end]
                end += 1
            some = texts.slice(start, end - start)
            if len(SEEN) > KEEP_STRETCHES:
                SEEN.clear()
            found, offsets = model.encode_all(some, SEEN)
            column = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(found, pa.int32()))
            decoded, agrees = [], []
            # Lists of ids, which take nine times their arrays, are held for one text at a time.
            for text, a, b in zip(some.to_pylist(), offsets[:-1], offsets[1:]):
                ids = found[a:b].tolist()
                decoded.append(model.library.decode(ids))
                agrees.append(ids == model.library.encode(text or ""))
            parts.append(pa.StructArray.from_arrays([column, pa.array(decoded, pa.string()), pa.array(agrees, pa.bool_())], ["ids", "decoded", "agrees"]))
            start = end
        return pa.concat_arrays(parts) if parts else pa.array([], pa.struct([("ids", pa.list_(pa.int32())), ("decoded", pa.string()), ("agrees", pa.bool_())]))

    return run(F.col(text) if isinstance(text, str) else text)
