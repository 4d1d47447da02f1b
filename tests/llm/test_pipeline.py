"""The pipeline's stages against plain Python over small documents."""

from __future__ import annotations

import numpy as np
import pytest

import corpus_pipeline
from catchment.llm import secrets, stages, toxicity
from catchment.llm.decontamination import COVERAGE
from catchment.llm.queries import fold, table
from tests.llm.test_bpe import expected
from tests.llm.test_decontamination import brute_tiles, words_of
from tests.llm.test_simhash import by_definition, components_of

SF = "/root/testdata/sf0.001"


def test_stages_by_plain_python(spark):
    docs = table(spark, SF, "documents")
    model = toxicity.train(docs.where(fold(5) != 0), table(spark, SF, "labels"))
    heads = model.heads()
    kept = {r.doc_id: r for r in docs.collect() if toxicity.score_of(r.text, model, heads) < 0.5}
    label = components_of({i: by_definition(r.text) for i, r in kept.items()})
    kept = {i: r for i, r in kept.items() if label[i] == i}
    items = [words_of(r.text) for r in table(spark, SF, "benchmark").collect()]

    def leaked(text):
        words = words_of(text)
        grams = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
        near = [x for x in items if any(tuple(x[i : i + 5]) in grams for i in range(len(x) - 4))]
        return any(sum(t[2] for t in brute_tiles(words, x, 5)) >= COVERAGE * len(x) for x in near)

    want = {}
    for i, r in kept.items():
        if not leaked(r.text):
            want[i] = expected(secrets.redact_text(r.text, secrets.find(r.text)))
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in got} == want
    assert all(r.round_trip and r.n_tokens == len(want[r.doc_id]) for r in got) and len(got) < docs.count()


@pytest.fixture
def odd(spark):
    rows = [(1, None, "en", "s", None), (None, "a b c d e", None, None, 9), (None, "a b c d e", None, None, 9), (2, "", "x", "s", 0), (3, "one two three four five six", "en", "s", 27)]
    rows += [(4, "one two three four five six", "en", "s", 27), (4, "one two three four five six", "en", "s", 27), (5, "token = 'abcdef0123456789abcdef'", "en", "s", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_every_stage_takes_odd_rows(spark, odd):
    for docs in (odd, odd.limit(0)):
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SF)
            assert i == len(corpus_pipeline.STAGES) - 1 or out.schema.names == odd.schema.names
            out.collect()
    # Null and empty texts share fingerprint zero; rows without an id stay.
    assert sorted((r.doc_id for r in stages.simhash_dedup(spark, odd, SF).collect()), key=str) == [1, 3, 5, None, None]
    clean = {r.doc_id: (r.text, r.n_chars) for r in stages.secret_scan(spark, odd, SF).collect()}
    assert clean[5] == ("<ASSIGN>'", 9) and clean[1] == (None, None)


def test_rows_that_share_an_id(spark):
    text = lambda n: " ".join(f"w{n}x{i}" for i in range(40))
    rows = [(8, text(100)), (8, text(101)), (8, text(101))]  # far texts of one id, each alone in its group
    want = [(8, text(100)), (8, text(101))]
    for n in range(0, 40, 4):  # the group of the first text has a smaller id, the second text stands for its own
        rows += [(n + 200, text(n)), (n + 203, text(n)), (n + 203, text(n + 1)), (n + 300, text(n + 1))]
        want += [(n + 200, text(n)), (n + 203, text(n + 1))]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted((r.doc_id, r.text) for r in stages.simhash_dedup(spark, docs, SF).collect()) == sorted(want)
