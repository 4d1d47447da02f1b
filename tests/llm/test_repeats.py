"""Parsing and recompression against brute force, with copies, overlaps, runs, nulls and very long texts."""

from __future__ import annotations

import hashlib
import random

import pytest

from catchment.llm import parsing, recompression, repeats

WORDS = [f"w{i}" for i in range(40)]


def corpus(rng: random.Random, passages: int = 4) -> list[tuple[int | None, str | None]]:
    shared = [" ".join(rng.choices(WORDS, k=rng.randint(48, 130))) for _ in range(passages)]
    texts: list[tuple[int | None, str | None]] = []
    for i in range(40):
        parts = []
        for _ in range(rng.randint(0, 4)):
            passage = rng.choice(shared)
            if rng.random() < 0.5:
                cut = passage.split()
                a = rng.randint(0, len(cut) // 3)
                passage = " ".join(cut[a : a + rng.randint(20, 110)])
            parts += [" ".join(rng.choices(WORDS, k=rng.randint(0, 60))), passage]
        texts.append((i, " \n".join(parts)))
    texts += [(50, texts[3][1]), (51, texts[3][1]), (52, None), (53, ""), (54, "  \t"), (55, "na " * 300), (56, "x " + "na " * 120)]
    texts += [(57, "la lo " * 200), (58, "lo la " * 90), (59, "é" * 400), (60, "aé" + "é" * 150), (None, texts[3][1]), (50, texts[3][1])]
    texts += [(61, "a" * 99), (62, "a" * 100), (63, "z" * 1000), (64, " ".join(WORDS[:25]) * 3)]
    rng.shuffle(texts)
    return texts


def brute_bytes(rows, length):
    first: dict[bytes, tuple[int, int]] = {}
    for doc, text in rows:
        data = (text or "").encode()
        if doc is not None:
            for i in range(len(data) - length + 1):
                w = data[i : i + length]
                first[w] = min(first.get(w, (doc, i)), (doc, i))
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        gone = [False] * len(data)
        for i in range(len(data) - length + 1 if doc is not None else 0):
            if first[data[i : i + length]] < (doc, i):
                gone[i : i + length] = [True] * length
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((doc, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def brute_words(rows, length):
    first: dict[tuple, int] = {}
    split = [(doc, (text or "").encode().split()) for doc, text in rows]
    for doc, words in split:
        if doc is not None:
            for i in range(len(words) - length + 1):
                w = tuple(words[i : i + length])
                first[w] = min(first.get(w, doc), doc)
    out = []
    for doc, words in split:
        gone = [False] * len(words)
        for i in range(len(words) - length + 1 if doc is not None else 0):
            if first[tuple(words[i : i + length])] < doc:
                gone[i : i + length] = [True] * length
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((doc, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def frame(spark, rows):
    clash = [(d, t, "x", 1, None) for d, t in rows]
    return spark.createDataFrame(clash, "doc_id long, text string, key string, n int, ranges string").repartition(5)


@pytest.fixture
def small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("seed", [1, 2])
def test_parsing(spark, small_batches, seed):
    rows = corpus(random.Random(seed))
    got = parsing.remove_repeats(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in got), key=str) == brute_bytes(rows, 100)


@pytest.mark.parametrize("seed", [3, 4])
def test_recompression(spark, small_batches, seed):
    rows = corpus(random.Random(seed))
    got = recompression.remove_repeats(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in got), key=str) == brute_words(rows, 50)


@pytest.mark.parametrize("seed,block,chunk", [(11, 24_000_000, 1 << 20), (12, 3000, 300), (13, 1, 157)])
@pytest.mark.parametrize("kind", ["bytes", "words"])
def test_in_one_process(monkeypatch, seed, block, chunk, kind):
    """The same steps without Spark, so that small blocks and chunks are in force."""
    monkeypatch.setattr(repeats, "BLOCK_BYTES", block)
    monkeypatch.setattr(repeats, "CHUNK", chunk)
    rows = [r for r in corpus(random.Random(seed), 6) if r[0] is not None]
    rows = sorted(set(rows), key=str)
    kinds = [parsing.windows(100, t) for t in parsing.TRIGGERS] if kind == "bytes" else [recompression.windows()]
    run = Local(rows)
    asked = run.docs
    for w in kinds:
        asked = run.joined(run.by_document(run.step(repeats.second_look, run.step(repeats.first_look, asked, w), w)))
    last = run.step(repeats.last_look, run.step(repeats.windows_of, asked, w), w)
    found: dict[int, set[int]] = {}
    for doc, start, n, _ in last:
        found.setdefault(doc, set()).update(range(start, start + n))
    first = {}
    units = [(d, t.encode() if kind == "bytes" else t.encode().split()) for d, t in rows if t is not None]
    for d, u in units:
        for i in range(len(u) - w.length + 1):
            x = bytes(u[i : i + w.length]) if kind == "bytes" else tuple(u[i : i + w.length])
            place = (d, i) if kind == "bytes" else d
            first[x] = min(first.get(x, place), place)
    for d, u in units:
        want = set()
        for i in range(len(u) - w.length + 1):
            x = bytes(u[i : i + w.length]) if kind == "bytes" else tuple(u[i : i + w.length])
            if first[x] < ((d, i) if kind == "bytes" else d):
                want.add(i)
        assert found.get(d, set()) == want
    assert any(found.values())


class Local:
    """Enough of a frame to run the mapInArrow steps on lists."""

    def __init__(self, rows):
        import pyarrow as pa

        self.rows, self.pa = rows, pa
        self.docs = [pa.record_batch({"doc": [d for d, t in rows[i : i + 6] if t is not None], "text": [t for _, t in rows[i : i + 6] if t is not None]}, schema=pa.schema([("doc", pa.int64()), ("text", pa.string())])) for i in range(0, len(rows), 6)]

    def step(self, step, data, w):
        pa = self.pa
        caught = []

        class Frame:
            columns = data[0].schema.names

            def select(self, *_):
                return self

            def repartition(self, *_):
                return self

            def sortWithinPartitions(self, *keys):
                self.keys = keys
                return self

            def mapInArrow(self, run, schema):
                batches = data
                if getattr(self, "keys", None):
                    table = pa.Table.from_batches(data).sort_by([(k, "ascending") for k in self.keys])
                    batches = table.to_batches(max_chunksize=13)
                caught.extend(run(iter(batches)))
                return caught

        out = step(Frame(), w)
        if step in (repeats.second_look, repeats.last_look):
            return [tuple(r.values()) for b in out for r in b.to_pylist()]
        return out

    def by_document(self, ranges):
        out = {}
        for doc, start, n, kind in ranges:
            out.setdefault(doc, []).append({"start": start, "n": n, "kind": kind})
        return out

    def joined(self, by_doc):
        pa = self.pa
        kind = pa.list_(pa.struct([("start", pa.int32()), ("n", pa.int32()), ("kind", pa.int32())]))
        rows = [(d, t, by_doc[d]) for d, t in self.rows if d in by_doc]
        return [pa.record_batch([pa.array([r[0] for r in rows[i : i + 5]]), pa.array([r[1] for r in rows[i : i + 5]]), pa.array([r[2] for r in rows[i : i + 5]], kind)], names=["doc", "text", "ranges"]) for i in range(0, len(rows), 5)]


def test_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert parsing.remove_repeats(empty).count() == 0 and recompression.remove_repeats(empty).count() == 0
