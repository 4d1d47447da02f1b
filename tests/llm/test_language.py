"""Output codes: held-out accuracy over the given documents, decoding by hand, odd rows."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest

from catchment.llm import language
from catchment.llm.queries import op2_language

SF = "/root/testdata/sf0.01"


def test_codewords_are_far_apart():
    for n in (2, 3, 4, 7, 8, 30):
        code = language.codewords(n).astype(int)
        assert code.shape[0] == n and (np.abs(code.sum(0)) < n).all()
        apart = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
        assert min(apart) >= (2 if n < 4 else 4)
    assert language.codewords(1).shape == (1, 0)


@pytest.mark.parametrize("step", [1 << 18, 7])
def test_margins_by_recounting(monkeypatch, step):
    monkeypatch.setattr(language, "_STEP", step)
    rng = np.random.default_rng(1)
    weights = rng.standard_normal((language.BUCKETS, 3)).astype(np.float32)
    texts = ["abc", "", None, "A", "é" * 40, "the quick brown fox " * 50, "x y"]
    pieces, offsets = language.trigrams(pa.array(texts))
    buckets = np.concatenate(list(pieces))
    got = language.margins(pa.array(texts), weights)
    for i, text in enumerate(texts):
        padded = f" {text or ''} ".encode()
        own = buckets[offsets[i] : offsets[i + 1]]
        assert len(own) == len(padded) and (own[-2:] == language.BUCKETS).all() and (own[:-2] < language.BUCKETS).all()
        assert np.allclose(got[i], weights[own[:-2]].sum(0) / max(len(padded) - 2, 1), atol=1e-4)
    assert len(language.margins(pa.array([], pa.string()), weights)) == 0


def test_decoding_corrects_a_wrong_bit_and_flags_close_calls():
    code = language.codewords(4)
    model = language.Model(list("abcd"), code, np.zeros((1, 7)), np.ones(7), np.full(code.shape, 1 / 7))
    wrong = code[2].astype(float)
    wrong[3] *= -0.5
    best, score, close = language.decode(model, np.array([wrong, np.zeros(7)]))
    assert best[0] == 2 and score[0] > 0.5 and not close[0] and close[1] and score[1] == pytest.approx(0.25)


def test_held_out_accuracy(spark):
    got = op2_language(spark, SF)
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in got.collect() if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in held)
    assert sum(truth[r.doc_id] == r.lang_pred for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in held)


def test_odd_rows(spark, tmp_path):
    rows = [(1, None, "en"), (2, "", "en"), (3, "123 !?", "en"), (4, "le chat est sur la table", None), (None, "the cat is on the table", "x"), (5, "the dog and the cat", "en"), (5, "the dog and the cat", "en"), (6, "le chien et le chat " * 9000, "fr"), (7, "A", "fr")]
    spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, score int").write.parquet(f"{tmp_path}/documents.parquet")
    got = op2_language(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    assert {r.doc_id for r in got if r.lang_pred == "und"} >= {1, 2, 3}
    assert all(0 <= r.score <= 1 for r in got)
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    model = language.train(docs)
    assert model.languages == [] and docs.select(language.identify("text", model).alias("c")).first().c.lang == "und"
    one = language.train(docs.selectExpr("doc_id", "text", "'en' as lang"))
    assert docs.select(language.identify("text", one).alias("c")).first().c.lang == "en"
