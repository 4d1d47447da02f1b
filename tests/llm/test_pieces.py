"""SentencePiece by the agenda against the public library: any text, edge cases, and the whole query."""

from __future__ import annotations

import hashlib
import io
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from catchment.llm import pieces
from catchment.llm.queries import op13_pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = pieces.load(PATH)
SF_DIR = "/root/testdata/sf0.001"


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=150))
def test_any_text(text):
    assert MODEL.encode(text) == MODEL.library.encode(text)


def test_edge_cases_and_long_texts():
    texts = ["", " ", "  a", "a  ", "\x00", "▁▁x", "x▁ y", "12345 6789", "日本語のテキスト。", "é" * 3000, "ab " * 20000, "🎉" * 500]
    seen: dict[str, list[int]] = {}
    for text in texts:
        assert MODEL.encode(text, seen) == MODEL.library.encode(text), text[:30]
    assert MODEL.encode(None) == []


def test_query_equals_library_on_every_document(spark):
    got = {r["doc_id"]: r for r in op13_pieces(spark, SF_DIR).collect()}
    docs = pq.read_table(f"{SF_DIR}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    assert len(got) == len(docs)
    for doc in docs:
        ids = MODEL.library.encode(doc["text"] or "")
        row = got[doc["doc_id"]]
        assert row["n_tokens"] == len(ids) and row["library_agrees"]
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(MODEL.library.decode(ids).encode()).hexdigest()


def test_nulls_empty_table_and_clashing_columns(spark):
    frame = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (3, "a b", "z")], "doc_id long, text string, enc string")
    got = sorted(frame.select("doc_id", "enc", pieces.encode("text", PATH).alias("out")).collect())
    assert [r["out"]["ids"] for r in got] == [[], [], MODEL.library.encode("a b")]
    assert [r["out"]["decoded"] for r in got] == ["", "", "a b"] and [r["enc"] for r in got] == ["x", "y", "z"]
    empty = frame.limit(0).select(pieces.encode("text", PATH).alias("out"))
    assert empty.count() == 0


def words(n, alphabet="etaoinshrdlu", longest=14, seed=3):
    rng = random.Random(seed)
    return list({"".join(rng.choices(alphabet, k=rng.randint(1, longest))) for _ in range(n)})


def test_new_stretches_are_merged_in_step_not_one_by_one(monkeypatch):
    alone, heap = [], MODEL.merge
    monkeypatch.setattr(pieces.Model, "merge", lambda self, text: alone.append(text) or heap(text))
    text = " ".join(words(6000))
    seen = {}
    assert MODEL.encode(text, seen) == MODEL.library.encode(text)
    assert len(seen) > 4000 and len(alone) < 400


def test_lines_and_words_are_stretches_of_their_own():
    text = "the end.\nthe other\nthe end.\nthe"
    seen = {}
    assert MODEL.encode(text, seen) == MODEL.library.encode(text)
    assert b"\n" in seen and b"the" in seen and not any(b"\n" in s and len(s) > 1 for s in seen)


def test_steps_equal_the_heap_for_all_lengths_and_characters():
    some = words(8000, "▁▁th einaa.\n\x00éßж日🎉", 60)
    got = MODEL.merge_all(list(some))
    assert got.keys() == set(some)
    for s in some:
        assert np.frombuffer(got[s], pieces.IDS).tolist() == MODEL.merge(s)


def test_many_texts_at_once_with_nulls_and_marks_anywhere():
    rng = random.Random(5)
    texts = [None if rng.random() < 0.1 else " ".join(rng.choices(["▁", "", "a▁", "▁b", "the", "日本", "x\n", "–▁–"], k=rng.randint(0, 9))) for _ in range(3000)]
    part = pa.array(texts).slice(7, 2900)
    ids, offsets = MODEL.encode_all(part, {})
    for text, a, b in zip(part.to_pylist(), offsets[:-1], offsets[1:], strict=True):
        assert ids[a:b].tolist() == MODEL.library.encode(text or "")
    ids, offsets = MODEL.encode_all(pa.array([None, ""], pa.string()), {})
    assert len(ids) == 0 and offsets.tolist() == [0, 0, 0]


def test_model_without_a_leading_mark(tmp_path):
    made = io.BytesIO()
    sentencepiece.SentencePieceTrainer.train(
        sentence_iterator=iter([" ".join(words(300, "abcd", 6, seed)) for seed in range(50)]), model_writer=made, vocab_size=400, model_type="bpe",
        byte_fallback=True, add_dummy_prefix=False, remove_extra_whitespaces=False, normalization_rule_name="identity", minloglevel=2,
    )
    (tmp_path / "small.model").write_bytes(made.getvalue())
    model = pieces.Model(str(tmp_path / "small.model"))
    texts = ["a b", " a", "▁", "ab▁cd", "é▁a", "", *(" ".join(words(200, "abcde ▁", 9, seed)) for seed in range(20))]
    for text in texts:
        assert model.encode(text) == model.library.encode(text)
