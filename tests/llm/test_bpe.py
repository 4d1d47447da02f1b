"""BPE against the public library, over the same ranks and pattern, and exact round trips."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from catchment.llm import bpe
from catchment.llm.queries import op3_bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(PATH), special_tokens={})
OURS = bpe.Encoder(PATH, public_tokenizers.PATTERN)


def expected(text: str | None) -> list[int]:
    return LIBRARY.encode_ordinary(text or "")


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=120))
def test_any_text(text):
    assert np.frombuffer(OURS.block([text])[0], "<u4").tolist() == expected(text)


def test_repetitive_and_long_words():
    rng = random.Random(1)
    texts = ["a" * 5000, "ab" * 900, " " * 333 + "x", "\n\n \t x", "<|endoftext|>", None, ""]
    texts += ["".join(rng.choices("ab c\n", k=rng.randint(0, 200))) for _ in range(200)]
    texts += ["".join(rng.choices("éèñü日本🎉 a'll", k=60)) for _ in range(50)]
    for keep in (bpe.KEEP_WORDS, 0):
        encoder = bpe.Encoder(PATH, public_tokenizers.PATTERN, keep)
        for i in range(0, len(texts), 40):
            got = encoder.block(texts[i : i + 40])
            assert [np.frombuffer(p, "<u4").tolist() for p in got] == [expected(t) for t in texts[i : i + 40]]


def test_vocabularies_out_of_merge_order():
    """Ranks that no training gives: a merge may make a pair of lower rank, and pairs overlap."""
    rng = random.Random(2)
    for _ in range(60):
        tokens = {bytes([b]) for b in range(256)}
        tokens |= {bytes(rng.choices(b"abc", k=rng.randint(2, 5))) for _ in range(25)}
        order = list(tokens)
        rng.shuffle(order)
        ranks = {t: i for i, t in enumerate(order)}
        words = [bytes(rng.choices(b"abc", k=rng.randint(1, 14))) for _ in range(40)]
        got = bpe.replay(words, bpe.Merges(ranks))
        assert [g.tolist() for g in got] == [[ranks[w]] if w in ranks else bpe.merge_word(w, ranks) for w in words]
    assert bpe.replay([], OURS.merges) == []


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows = [(1, "Hello, world! 123", "x"), (2, None, "x"), (2, None, "x"), (None, "", "x"), (3, "Été  \n\n ça va?", "x"), (4, "long " * 30000, "x")]
    at = tmp_path_factory.mktemp("bpe")
    spark.createDataFrame(rows, "doc_id long, text string, ids string").write.parquet(f"{at}/documents.parquet")
    return str(at), rows


def test_query(spark, folder):
    at, rows = folder
    want = []
    for doc, text, _ in rows:
        ids = expected(text)
        raw = np.array(ids, "<u4").tobytes()
        want.append((doc, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    got = [tuple(r) for r in op3_bpe(spark, at).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_ids_as_arrays(spark):
    docs = spark.createDataFrame([("a b",), (None,)], "text string").select(bpe.encode("text", PATH, public_tokenizers.PATTERN).alias("ids"))
    assert [r[0] for r in docs.select(bpe.ids_array("ids")).collect()] == [expected("a b"), []]
    assert docs.limit(0).select(bpe.decode("ids", PATH)).count() == 0
