"""Language identification by error-correcting output codes.

Each language has a codeword, a row of a Hadamard matrix, so any two differ in half of their bits. Each bit has a
binary classifier over hashed byte trigrams, which sums log-odds of the languages with the bit set against the others.
Decoding compares the classifiers' margins with every codeword under an exponential loss that weighs a bit by how
often it was right for that language, takes the nearest codeword and flags close calls.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from catchment.llm.buffers import LOWER, flat, giving_back

#: Training documents of each language, as expected number: half for the classifiers, half for the weights of bits.
SAMPLE = 3000
#: Languages that can be learned, the most frequent first; and buckets of trigrams. They bound the model.
MOST_LANGUAGES = 256
BUCKETS = 1 << 14
#: Share by which the second codeword's loss must exceed the first's, or the call is flagged as ambiguous.
CLEAR = 0.1
#: How sharply losses become a score.
SHARPNESS = 4.0

_STEP = 1 << 18


@dataclass(frozen=True)
class Model:
    """languages; code: ±1 by language and bit; weights: by bucket and bit; reach: by bit; trust: by language and bit."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    reach: np.ndarray
    trust: np.ndarray


def codewords(n: int) -> np.ndarray:
    """±1 codewords of n languages: rows 1 to n of the least Sylvester matrix that has them, without constant columns."""
    order = 8
    while order <= n:
        order *= 2
    bits = np.bitwise_count(np.arange(1, n + 1)[:, None] & np.arange(1, order)[None, :]) % 2
    return np.where(bits[:, (bits.min(0) < bits.max(0))], 1, -1).astype(np.int8)


def trigrams(texts: pa.Array) -> tuple[Iterator[np.ndarray], np.ndarray]:
    """Buckets of all byte trigrams of texts in lower case with a space at each end, in pieces of bounded size that
    follow each other, and row offsets. The last two places of a row, where none begins, are in the bucket BUCKETS."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    none = pa.scalar("", pa.large_string())
    data, offsets = flat(pc.binary_join_element_wise(none, texts, none, pa.scalar(" ", pa.large_string())))
    ends = np.sort(np.concatenate([offsets[1:] - 2, offsets[1:] - 1]))

    def pieces() -> Iterator[np.ndarray]:
        for at in range(0, len(data), _STEP):
            low = np.zeros(min(_STEP, len(data) - at) + 2, np.uint32)
            part = data[at : at + len(low)]
            low[: len(part)] = LOWER[part]
            hashed = (low[:-2] * np.uint32(0x9E3779B1)) ^ (low[1:-1] * np.uint32(0x85EBCA77)) ^ (low[2:] * np.uint32(0xC2B2AE3D))
            hashed *= np.uint32(0x27D4EB2F)
            hashed >>= np.uint32(18)
            first, last = np.searchsorted(ends, [at, at + len(hashed)])
            hashed[ends[first:last] - at] = BUCKETS
            yield hashed

    return pieces(), offsets


def margins(texts: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Mean weight of each text's trigrams, by text and bit; zero without trigrams."""
    pieces, offsets = trigrams(texts)
    table = np.vstack([weights, np.zeros((1, weights.shape[1]), weights.dtype)])
    sums = np.zeros((len(texts), weights.shape[1]))
    at = 0
    for piece in pieces:
        first = int(np.searchsorted(offsets, at, side="right")) - 1
        last = int(np.searchsorted(offsets, at + len(piece), side="left"))
        starts = np.maximum(offsets[first:last] - at, 0)
        sums[first:last] += np.add.reduceat(np.take(table, piece, axis=0), starts, axis=0)
        at += len(piece)
    return sums / np.maximum(np.diff(offsets) - 2, 1)[:, None]


def losses(model: Model, found: np.ndarray) -> np.ndarray:
    """Loss of each text against each codeword."""
    signed = np.clip(found * model.reach, -3, 3)
    return np.exp(-signed) @ np.where(model.code > 0, model.trust, 0).T + np.exp(signed) @ np.where(model.code < 0, model.trust, 0).T


def decode(model: Model, found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the nearest codeword, score from 0 to 1, and whether the second one is near too. Ties go to the first."""
    if model.code.shape[1] == 0:
        n = len(found)
        return np.zeros(n, np.int64), np.ones(n), np.zeros(n, bool)
    loss = losses(model, found)
    best = loss.argmin(1)
    least = loss.min(1)
    score = 1 / np.exp(SHARPNESS * (least[:, None] - loss)).sum(1)
    second = np.partition(loss, 1, axis=1)[:, 1]
    return best, score, second < least * (1 + CLEAR)


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from rows with text and lang. Without any, the model has no language and every text is undetermined."""
    known = docs.where("text is not null and lang is not null").select("doc_id", "text", "lang")
    counts = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES).collect()
    languages = sorted(r["lang"] for r in counts)
    if not languages:
        return Model([], np.zeros((0, 0), np.int8), np.zeros((BUCKETS, 0), np.float32), np.zeros(0), np.zeros((0, 0)))
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, sample / r["count"]))])
    draw = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 20)) / float(1 << 20)
    chosen = known.where(draw < F.try_element_at(share, F.col("lang")))
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)) == 0
    number = {name: i for i, name in enumerate(languages)}

    @giving_back
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for i, name in enumerate(batch.column("lang").to_pylist()):
                for piece in trigrams(batch.column("text").slice(i, 1))[0]:
                    found = np.bincount(piece, minlength=BUCKETS + 1)[:BUCKETS]
                    totals[name] = totals[name] + found if name in totals else found
        for name, found in totals.items():
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array([number[name]] * len(at), pa.int32()), pa.array(at, pa.int32()), pa.array(found[at], pa.int64())], names=["lang", "bucket", "n"])

    summed = chosen.where(half).select("text", "lang").mapInArrow(count, "lang int, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    got = summed.toArrow()
    table = np.full((len(languages), BUCKETS), 0.5)
    table[got.column("lang").to_numpy(), got.column("bucket").to_numpy()] += got.column("n").to_numpy()
    table /= table.sum(1, keepdims=True)
    code = codewords(len(languages))
    weights = np.zeros((BUCKETS, code.shape[1]), np.float32)
    for bit in range(code.shape[1]):
        weights[:, bit] = np.log(table[code[:, bit] > 0].mean(0)) - np.log(table[code[:, bit] < 0].mean(0))
    if not code.shape[1]:
        return Model(languages, code, weights, np.zeros(0), np.zeros((len(languages), 0)))

    @giving_back
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = margins(batch.column("text"), weights)
            lang = pa.array([number[x] for x in batch.column("lang").to_pylist()], pa.int32())
            yield pa.RecordBatch.from_arrays([lang, pa.array(list(found), pa.list_(pa.float64()))], names=["lang", "margins"])

    seen = chosen.where(~half).select("text", "lang").mapInArrow(measure, "lang int, margins array<double>").toArrow()
    lang = seen.column("lang").to_numpy()
    found = np.array(seen.column("margins").to_pylist()).reshape(len(lang), code.shape[1])
    reach = 1 / np.maximum(np.abs(found).mean(0), 1e-9) if len(lang) else np.ones(code.shape[1])
    trust = np.ones(code.shape)
    for i in range(len(languages)):
        if (lang == i).any():
            trust[i] = ((found[lang == i] * code[i] > 0).sum(0) + 1) / ((lang == i).sum() + 2)
    return Model(languages, code, weights, reach, trust / trust.sum(1, keepdims=True))


def identify(text: str, model: Model) -> Column:
    """Language, score and ambiguity of a text column as a struct; `und`, 0 and false for a null or without a letter."""

    @arrow_udf("struct<lang:string,score:double,ambiguous:boolean>")
    @giving_back
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            best, score, close = decode(model, margins(texts, model.weights))
            names = pa.array(model.languages, pa.string()).take(pa.array(best))
            yield pa.StructArray.from_arrays([names, pa.array(score), pa.array(close)], names=["lang", "score", "ambiguous"])

    none = F.struct(F.lit("und").alias("lang"), F.lit(0.0).alias("score"), F.lit(False).alias("ambiguous"))
    if not model.languages:
        return none
    return F.when(F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)), run(F.col(text))).otherwise(none)
