"""Toxic passages by maximum-scoring segments over token log-odds.

Tokens are words and, for words not seen in training, their longest seen beginning. A token's log-odds between toxic
and clean documents has a Dirichlet prior in proportion to all training text; only significant ones score, every other
token costs a little. A linear scan finds all maximal segments of a text; scores of segments follow an extreme-value
law in clean text, which turns them into p-values, and a text's evidence is what its significant segments add up to.
The score is a logistic curve over that evidence and over all that scored in the text; it is fitted out of fold, each
document by the log-odds of the other folds, so that few labels serve for log-odds and curve alike.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from catchment.llm.buffers import giving_back

#: Labelled documents to learn from, as expected number, and the folds they are dealt to for calibration.
SAMPLE = 24_000
FOLDS = 8
#: Characters of the beginnings that stand for words not seen, longest first, and training documents a token must be in.
BEGINNINGS = (6, 5, 4)
SEEN = 5
#: Times a token counts in one document: toxic texts repeat theirs, a long text must not outweigh the others.
REPEATS = 4
#: Weight of the prior, in toxic documents' tokens.
PRIOR = 3.0
#: Standard errors from zero at which log-odds are significant, and the least log-odds that score.
SIGNIFICANT = 2.7
LEAST_ODDS = 1.0
#: With fewer toxic documents than this a token must be in, and be, less: no token reaches the bounds above otherwise.
FEW_TOXIC = 100
SEEN_FEW = 3
SIGNIFICANT_FEW = 2.0
#: Slope of all that scored where the folds show none: a text with likelier toxic tokens still ranks higher.
LEAST_SLOPE = 0.1
#: Documents whose tokens are counted together before Spark adds counts up.
COUNTED = 256
#: What any other token takes from a segment.
DRIFT = 0.05
#: p-value at which a segment counts.
LEVEL = 0.5

WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Model:
    """weights of tokens (a word ends in $, a beginning does not); rate and factor of the extreme-value law of clean
    text; slopes (of the evidence, of the logarithm of all that scored) and offset of the logistic curve to a score."""

    weights: dict[str, float] = field(default_factory=dict)
    rate: float = 1.0
    factor: float = 1.0
    slope: float = 1.0
    offset: float = -1.0
    total_slope: float = 0.0

    def heads(self) -> set[str]:
        return {t.rstrip("$")[:4] for t, w in self.weights.items() if w > 0}


def tokens_of(word: str) -> Iterator[str]:
    """What a word can be known by, the most telling first."""
    yield word + "$"
    for n in BEGINNINGS:
        if len(word) >= n:
            yield word[:n]


def events(text: str, weights: dict[str, float], heads: set[str]) -> tuple[int, list[tuple[int, float]]]:
    """Number of words, and place and weight of those that score."""
    words = WORD.findall(text.lower())
    found = []
    for i, word in [(i, word) for i, word in enumerate(words) if word[:4] in heads]:
        weight = next((weights[t] for t in tokens_of(word) if t in weights), 0.0)
        if weight > 0:
            found.append((i, weight))
    return len(words), found


def maximal_segments(found: list[tuple[int, float]], drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal scoring segments as first place, last place and score, by Ruzzo and Tompa's linear scan.

    A candidate is kept with the sums before and after it, and with a link to the nearest earlier candidate that starts
    lower. A new one is joined to the nearest earlier candidate that starts lower, if that one ends lower than the new
    one; the search goes on with the joined one. The search follows the links, so it skips every candidate that starts
    no lower than one it has passed, and far apart hits cost linear time, not quadratic.
    """
    stack: list[list] = []  # first, last, sum before, sum after, link
    total, at = 0.0, 0
    for place, weight in found:
        total -= drift * (place - at)
        at = place + 1
        new = [place, place, total, total + weight]
        total += weight
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= new[2]:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= new[3]:
                stack.append([*new, j])
                break
            new = [stack[j][0], new[1], stack[j][2], new[3]]
            del stack[j:]
    return [(int(a), int(b), r - l) for a, b, l, r, _ in stack]


def evidence(n: int, scores: list[float] | np.ndarray, rate: float, factor: float) -> float:
    """Minus the logarithms of the p-values of the segments that count, added up."""
    total = 0.0
    for score in scores:
        expected = factor * n * math.exp(-rate * score)
        p = -math.expm1(-expected)
        if p < LEVEL:
            total -= math.log(max(p, 1e-300))
    return total


def score_of(text: str | None, model: Model, heads: set[str]) -> float:
    n, found = events(text or "", model.weights, heads)
    x = evidence(n, [s for _, _, s in maximal_segments(found)], model.rate, model.factor) if found else 0.0
    at = model.slope * x + model.total_slope * math.log1p(sum(w for _, w in found)) + model.offset
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, at))))


def _counts(sample: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Tokens in enough documents, the number of these, and clean and toxic counts by fold, kind and token."""

    @giving_back
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, COUNTED) for b in batches for i in range(0, b.num_rows, COUNTED)):
            found: dict[int, tuple[Counter, Counter, Counter]] = {}
            for text, toxic, fold in zip(*(batch.column(c).to_pylist() for c in ("text", "toxic", "fold"))):
                own = Counter()
                for word, times in Counter(WORD.findall(text.lower())).items():
                    for token in tokens_of(word):
                        own[token] += times
                kinds = found.setdefault(fold, (Counter(), Counter(), Counter()))
                kinds[toxic].update({t: min(times, REPEATS) for t, times in own.items()})
                kinds[2].update(own.keys())
            for fold, kinds in found.items():
                tokens = list(kinds[2])
                columns = [pa.array(tokens, pa.string()), pa.array([fold] * len(tokens), pa.int32()), *(pa.array([c[t] for t in tokens], pa.int64()) for c in kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=["token", "fold", "clean", "toxic", "docs"])

    counted = sample.mapInArrow(count, "token string, fold int, clean long, toxic long, docs long")
    parts = [(k, c) for k in range(FOLDS) for c in ("clean", "toxic")]
    summed = [F.sum(F.when(F.col("fold") == k, F.col(c)).otherwise(0)).cast("int").alias(f"{c}_{k}") for k, c in parts]
    seen = counted.groupBy("token").agg(F.sum("docs").alias("docs"), *summed).where(F.col("docs") >= SEEN_FEW).toArrow()
    tokens = seen.column("token").to_pylist()
    numbers = [seen.column(f"{c}_{k}").to_numpy() for k, c in parts]
    return tokens, seen.column("docs").to_numpy(), np.array(numbers, float).reshape(FOLDS, 2, len(tokens))


def _weights(tokens: list[str], clean: np.ndarray, toxic: np.ndarray, docs: np.ndarray, few: bool) -> dict[str, float]:
    """Significant tokens with their log-odds, and the seen tokens that share their first four characters, at zero or
    their own log-odds: these keep a known word from being taken for its beginning."""
    kept = (docs >= (SEEN_FEW if few else SEEN)) & (clean + toxic > 0)
    clean, toxic, tokens = clean[kept], toxic[kept], [t for t, k in zip(tokens, kept) if k]
    if not len(tokens) or not toxic.sum() or not clean.sum():
        return {}
    prior = PRIOR * toxic.sum() * (clean + toxic) / (clean + toxic).sum()
    odds = lambda y: np.log((y + prior) / (y.sum() + prior.sum() - y - prior))
    gap = odds(toxic) - odds(clean)
    least = SIGNIFICANT_FEW if few else SIGNIFICANT
    sure = (gap >= LEAST_ODDS) & (gap / np.sqrt(1 / (toxic + prior) + 1 / (clean + prior)) >= least)
    heads = {t.rstrip("$")[:4] for t, s in zip(tokens, sure) if s}
    return {t: float(g) if s else 0.0 for t, g, s in zip(tokens, gap, sure) if t.rstrip("$")[:4] in heads}


def _law(n: np.ndarray, best: np.ndarray, clean_events: np.ndarray) -> tuple[float, float]:
    """Rate and factor of the extreme-value law, from clean documents: word counts, best scores, weights that scored.

    The rate is where the mean of exp(rate * score) over the words of clean text is one. Clean text of which hardly
    any word scores is given one more word of the greatest weight, so that the rate stays finite. The factor makes
    the expected number of documents that reach a score the one seen, at the median of the scores seen.
    """
    words = float(max(n.sum(), 1))
    top = max(float(clean_events.max()) if len(clean_events) else 0.0, LEAST_ODDS)
    weights = np.append(clean_events, top)
    low, high = 1e-6, 50.0 / top
    for _ in range(60):
        rate = (low + high) / 2
        mean = (np.exp(rate * weights).sum() + (words - len(weights)) * math.exp(-rate * DRIFT)) / words
        low, high = (rate, high) if mean < 1 else (low, rate)
    reached = best[best > 0]
    at = float(np.median(reached)) if len(reached) else top
    factor = max(int((best >= at).sum()), 1) / (words * math.exp(-rate * at))
    return rate, factor


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Slopes, none below zero, and offset by a few damped Newton steps with a small penalty, so that separable data
    end as well. Where a slope comes out below zero, that column is left out and the others are fitted again."""
    used = np.ones(x.shape[1], bool)
    while True:
        design = np.column_stack([x[:, used], np.ones(len(x))])
        beta, penalty = np.zeros(design.shape[1]), np.diag([1e-2] * int(used.sum()) + [1e-3])
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
            step = np.linalg.solve((design.T * (p * (1 - p))) @ design + penalty, design.T @ (y - p) - penalty @ beta)
            beta = beta + np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-6:
                break
        if (beta[:-1] >= 0).all():
            slopes = np.zeros(x.shape[1])
            slopes[used] = beta[:-1]
            return slopes, float(beta[-1])
        used[np.flatnonzero(used)[np.argmin(beta[:-1])]] = False


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from labelled documents. Several labels of one document count as toxic if any is; null labels are ignored.

    Without labels of both kinds no token scores, and every text gets the share of toxic ones.
    """
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    total = known.count()
    draw = F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1 << 20)) / float(1 << 20)
    chosen = known.where(draw < sample / max(total, 1)) if total > sample else known
    # The sample's ids are bounded by the parameter, so they may go to every task.
    texts = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    fold = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(FOLDS)).cast("int")
    dealt = texts.select("text", "toxic", fold.alias("fold"))
    tokens, docs_with, counts = _counts(dealt)
    clean_all, toxic_all = counts.sum(axis=0)
    kinds = {r["toxic"]: r["n"] for r in dealt.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    few = kinds.get(1, 0) < FEW_TOXIC
    if not kinds.get(0) or not kinds.get(1):
        mean = (kinds.get(1, 0) + 0.5) / (sum(kinds.values()) + 1)
        return Model({}, offset=math.log(mean / (1 - mean)))
    others = [_weights(tokens, clean_all - c, toxic_all - t, docs_with, few) for c, t in counts]
    other_heads = [Model(w).heads() for w in others]

    @giving_back
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [events(t, others[k], other_heads[k]) for t, k in zip(batch.column("text").to_pylist(), batch.column("fold").to_pylist())]
            reals = pa.list_(pa.float64())
            columns = [
                batch.column("toxic"),
                pa.array([n for n, _ in rows], pa.int64()),
                pa.array([[w for _, w in e] for _, e in rows], reals),
                pa.array([[s for _, _, s in maximal_segments(e)] for _, e in rows], reals),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["toxic", "n", "events", "scores"])

    seen = dealt.mapInArrow(measure, "toxic int, n long, events array<double>, scores array<double>").toArrow().to_pydict()
    toxic, n = np.array(seen["toxic"], float), np.array(seen["n"], float)
    clean = toxic == 0
    best = np.array([max(s, default=0.0) for s in seen["scores"]])
    rate, factor = _law(n[clean], best[clean], np.array([w for e, c in zip(seen["events"], clean) if c for w in e]))
    x = np.array([[evidence(k, s, rate, factor), math.log1p(sum(e))] for k, s, e in zip(seen["n"], seen["scores"], seen["events"])])
    (slope, total_slope), offset = _logistic(x, toxic)
    if not slope and not total_slope:
        total_slope = LEAST_SLOPE
    return Model(_weights(tokens, clean_all, toxic_all, docs_with, few), rate, factor, float(slope), offset, float(total_slope))


def score(text: Column | str, model: Model) -> Column:
    """Score from 0 to 1 of a text column; a null text is an empty one."""

    @arrow_udf("double")
    @giving_back
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        heads = model.heads()
        for texts in batches:
            yield pa.array([score_of(t.as_py(), model, heads) for t in texts], pa.float64())

    return run(text)


def passages(text: Column | str, model: Model) -> Column:
    """Toxic passages of a text column: first and last word (counted from 0), score and p-value of each that counts."""

    @arrow_udf("array<struct<first:int,last:int,score:double,p:double>>")
    @giving_back
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        heads = model.heads()
        kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64()), ("p", pa.float64())]))
        for texts in batches:
            out = []
            for t in texts:
                n, found = events(t.as_py() or "", model.weights, heads)
                rows = [(a, b, s, -math.expm1(-model.factor * n * math.exp(-model.rate * s))) for a, b, s in maximal_segments(found)]
                out.append([{"first": a, "last": b, "score": s, "p": p} for a, b, s, p in rows if p < LEVEL])
            yield pa.array(out, kind)

    return run(text)
