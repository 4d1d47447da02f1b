"""Byte-level BPE by merge replay over a block of the corpus.

The distinct words of a block of documents are laid out in one array of symbols. An inverted index holds, for every
pair of neighbouring symbols that has a rank, the places where it stands; ranks are replayed in order, each applied at
all its places, and only the neighbours of a merged place are looked at again. Blocks are bounded in bytes, need no
shuffle and are recomputed alone when an executor is lost.
"""

from __future__ import annotations

import base64
import heapq
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from catchment.llm.buffers import giving_back

#: Words whose ids a worker keeps for its later blocks. When it is full it is emptied, which costs time and no result.
KEEP_WORDS = 200_000


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: base64 of the token's bytes and its id on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Merges:
    """A vocabulary: tokens by id, ids of single bytes, and every pair of tokens that makes a token, sorted by key."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {
            (ranks[token[:cut]] << 32) | ranks[token[cut:]]: rank
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        }
        self.keys = np.array(sorted(pairs), np.int64)
        self.made = np.array([pairs[k] for k in self.keys.tolist()], np.int64)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank that each pair of ids merges into, -1 without one."""
        if not len(self.keys):
            return np.full(len(left), -1)
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.made[at], -1)


@lru_cache(maxsize=4)
def load_merges(path: str) -> Merges:
    return Merges(load_ranks(path))


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """One word by the definition: the leftmost pair of the least rank merges, until none has a rank."""
    parts = [word[i : i + 1] for i in range(len(word))]
    while len(parts) > 1:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], 1 << 62), i) for i in range(len(parts) - 1))
        if rank == 1 << 62:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


def replay(words: list[bytes], merges: Merges) -> list[np.ndarray]:
    """Ids of each word, by replaying merges in rank order over all words at once.

    A word that is a token as a whole is that token. Where places of one rank overlap, the left one of each two merges.
    Should a merge make a pair of lower rank, which a vocabulary trained by merges hardly allows, its word is done
    again by the definition.
    """
    ranks = merges.ranks
    whole = [ranks.get(w, -1) for w in words]
    split = [i for i, r in enumerate(whole) if r < 0]
    out = [np.array([max(r, 0)], "<u4") for r in whole]
    lengths = np.array([len(words[i]) for i in split], np.int64)
    ends = np.cumsum(lengths)
    symbols = merges.byte_ids[np.frombuffer(b"".join(words[i] for i in split), np.uint8)]
    n = len(symbols)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    after[ends - 1] = -1
    before[ends - lengths] = -1
    rank_at = np.full(n, -1, np.int64)
    inner = np.flatnonzero(after >= 0)
    rank_at[inner] = merges.of(symbols[inner], symbols[inner + 1])
    odd: set[int] = set()

    # The inverted index: for each rank, the places of its pairs.
    index: dict[int, list[np.ndarray]] = defaultdict(list)
    queue: list[int] = []

    def enter(at: np.ndarray, found: np.ndarray) -> None:
        order = np.argsort(found, kind="stable")
        at, found = at[order], found[order]
        cuts = np.flatnonzero(found[1:] != found[:-1]) + 1
        for rank, places in zip(found[np.concatenate([[0], cuts])].tolist(), np.split(at, cuts)):
            if rank not in index:
                heapq.heappush(queue, rank)
            index[rank].append(places)

    first = np.flatnonzero(rank_at >= 0)
    if len(first):
        enter(first, rank_at[first])
    while queue:
        rank = heapq.heappop(queue)
        entries = index.pop(rank)
        at = entries[0] if len(entries) == 1 else np.unique(np.concatenate(entries))
        at = at[rank_at[at] == rank]
        if not len(at):
            continue
        # In a chain of overlapping places every second one is left.
        chained = np.zeros(len(at), bool)
        chained[1:] = after[at[:-1]] == at[1:]
        if chained.any():
            place = np.arange(len(at))
            head = np.maximum.accumulate(np.where(chained, 0, place))
            at = at[(place - head) % 2 == 0]
        right = after[at]
        follower = after[right]
        beside = np.flatnonzero(follower[:-1] == at[1:])
        if len(beside):  # the left one of two neighbours merges first, and then stands beside what the right one still is
            between = merges.of(np.full(len(beside), rank), symbols[at[beside + 1]])
            lower = (between >= 0) & (between < rank)
            odd.update(np.searchsorted(ends, at[beside[lower]], side="right").tolist())
        symbols[at], after[at] = rank, follower
        rank_at[right] = -1
        symbols[right] = -1
        follows = follower >= 0
        before[follower[follows]] = at[follows]
        left = before[at]
        near = np.unique(np.concatenate([at, left[left >= 0]]))
        last = after[near]
        found = np.where(last >= 0, merges.of(symbols[near], symbols[last]), -1)
        rank_at[near] = found
        alive = found >= 0
        if alive.any():
            near, found = near[alive], found[alive]
            if found.min() < rank:
                odd.update(np.searchsorted(ends, near[found < rank], side="right").tolist())
            enter(near, found)
    kept = np.flatnonzero(symbols >= 0)
    cuts = np.searchsorted(kept, ends[:-1]) if len(split) else []
    for i, ids in zip(split, np.split(symbols[kept].astype("<u4"), cuts)):
        out[i] = ids
    for i in odd:
        out[split[i]] = np.array(merge_word(words[split[i]], ranks), "<u4")
    return out


class _Numbers(dict):
    """Gives each new word the next number."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


class Encoder:
    """Encodes blocks of texts; keeps the ids of words already seen, packed as little-endian 32-bit integers."""

    def __init__(self, path: str, pattern: str, keep: int = KEEP_WORDS):
        self.merges, self.find, self.keep = load_merges(path), regex.compile(pattern).findall, keep
        self.numbers, self.packed = _Numbers(), []

    def block(self, texts: Iterable[str | None]) -> list[bytes]:
        if len(self.numbers) > self.keep:
            self.numbers, self.packed = _Numbers(), []
        number = self.numbers.__getitem__
        docs = [np.fromiter(map(number, self.find(t)), np.int32) if t else np.empty(0, np.int32) for t in texts]
        new = list(islice(self.numbers, len(self.packed), None))
        self.packed += [ids.tobytes() for ids in replay([w.encode() for w in new], self.merges)]
        return [b"".join(map(self.packed.__getitem__, d.tolist())) for d in docs]


@lru_cache(maxsize=1)
def _encoder(path: str, pattern: str) -> Encoder:
    """One for each worker process, so that tasks that follow each other know each other's words."""
    return Encoder(path, pattern)


#: Characters of text that are encoded as one block.
BLOCK_CHARS = 3_000_000


def encode(text: Column | str, path: str, pattern: str) -> Column:
    """Ids of a text column, packed as little-endian unsigned 32-bit integers; see `ids_array` for an array.

    Every match of `pattern` is encoded on its own, without special tokens. A null text is an empty one.
    """

    @arrow_udf("binary")
    @giving_back
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _encoder(path, pattern)
        for texts in batches:
            out, block, size = [], [], 0
            for text in texts:  # one at a time, as a batch as strings would be held twice
                block.append(text.as_py())
                size += len(block[-1] or "")
                if size >= BLOCK_CHARS:
                    out.append(pa.array(encoder.block(block), pa.binary()))
                    block, size = [], 0
            out.append(pa.array(encoder.block(block), pa.binary()))
            yield pa.concat_arrays(out)

    return run(text)


def decode(ids: Column | str, path: str) -> Column:
    """The bytes that packed ids stand for. Null and empty give no bytes."""

    @arrow_udf("binary")
    @giving_back
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = {i: t for t, i in load_ranks(path).items()}
        for packed in batches:
            texts = (b"".join(map(tokens.__getitem__, np.frombuffer(p.as_buffer(), "<u4").tolist())) if p.is_valid else b"" for p in packed)
            yield pa.array(texts, pa.binary(), size=len(packed))

    return run(ids)


def n_tokens(ids: Column | str) -> Column:
    return (F.octet_length(ids) / 4).cast("long")


def ids_array(ids: Column | str) -> Column:
    """Packed ids as an array of integers."""

    @arrow_udf("array<int>")
    def run(packed: pa.Array) -> pa.Array:
        return pa.array([np.frombuffer(p or b"", "<u4").astype(np.int32) for p in packed.to_pylist()], pa.list_(pa.int32()))

    return run(ids)
