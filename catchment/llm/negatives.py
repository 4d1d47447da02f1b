"""Hard-negative mining over an inverted multi-index, searched in certified windows.

Each vector is cut into two halves, and each half is assigned to the nearest centroid of its own codebook; a cell is
a pair of centroids. Codebooks are fitted by k-means on a bounded sample (`sample` rows, a parameter), but every row
is indexed. For a query q, the score of any row in cell (i, j) is at most u1[i] + u2[j], where u[i] = <q_h, c_i> +
|q_h| r_i and r_i is the largest distance of a row of centroid i from it (and at least l1[i] + l2[j], the same with
the radius subtracted). A multi-sequence heap walks cells by falling summed bound. Spark visits cells in windows: the
cells of a window are joined with the rows they hold (split in chunks, so one cell with a third of all rows is many
tasks), scored exactly in integers, and the best rows kept; a query is done once its k-th best score beats the bound
of the next cell, or no cell is left. Others go on with a window twice as long. Results are exact, not approximate.

Positives of an anchor: its best k other rows of the same label. Negatives of an anchor and positive: the best k
rows of another label whose score s satisfies 80 * p <= 100 * s <= 100 * p for the positive's score p.

Defined cases: rows with a null key, label or vector, or a null, NaN or infinite component, take no part; of the
remaining lengths the most frequent (ties: the longer) is used. Ties of score go to the smaller key. Repeated rows
and vectors are rows of their own. Fewer rows than k give all that exist; an empty table gives no rows. Extra
columns of the input are not carried and cannot clash.
"""

from __future__ import annotations

import heapq
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catchment.session import shared_dir

#: Queries that meet the rows of a chunk in one group, and that are scored against them at once.
QUERY_ROWS = 4096
SLICE_QUERIES = 256

#: Slack added to every bound, far above the rounding of doubles for integer vectors of this size.
SLACK = 1e-6


def stored(df: DataFrame, name: str) -> DataFrame:
    path = f"{shared_dir(df.sparkSession)}/negatives-{name}-{uuid.uuid4()}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def prepared(frame: DataFrame, column: str, key: str, label: str, scale: int) -> tuple[DataFrame, int]:
    """(key, label, x) for rows that take part, x = floor(scale * c) as longs; and the vector length."""
    whole = frame.where(F.col(key).isNotNull() & F.col(label).isNotNull() & F.col(column).isNotNull())
    whole = whole.where(F.forall(column, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf"))))
    rows = whole.select(F.col(key).cast("long").alias("key"), F.col(label).cast("long").alias("label"), F.transform(column, lambda c: F.floor(c.cast("double") * scale)).alias("x"))
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    d = lengths[0]["d"] if lengths else 0
    return rows.where(F.size("x") == d), d


def kmeans(points: np.ndarray, k: int, rounds: int = 25, seed: int = 7) -> np.ndarray:
    """Lloyd's k-means with centres started on distinct points; fewer distinct points give fewer centres."""
    distinct = np.unique(points, axis=0)
    rng = np.random.default_rng(seed)
    centres = distinct[rng.choice(len(distinct), size=min(k, len(distinct)), replace=False)].astype(np.float64)
    for _ in range(rounds):
        near = ((points[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2).argmin(axis=1)
        for c in range(len(centres)):
            if np.any(near == c):
                centres[c] = points[near == c].mean(axis=0)
    return centres


class Cells:
    """Codebooks of both halves, the largest radius of each centroid, and the rows and chunks of each cell: all of a
    size set by the number of codes, whatever the number of rows."""

    def __init__(self, books, radius, count, chunks, k2, h):
        self.books, self.radius, self.count, self.chunks, self.k2, self.h = books, radius, count, chunks, k2, h

    def order(self, q: np.ndarray, lo: float, hi: float):
        """Cells by falling upper bound from the multi-sequence heap: (cell, bound), skipping empty cells, cells
        whose lower bound is above hi, and ending where the bound falls below lo."""
        parts = (q[: self.h], q[self.h :])
        upper, lower = [], []
        for part, book, radius in zip(parts, self.books, self.radius):
            dot, norm = book @ part, float(np.linalg.norm(part))
            slack = SLACK * (1.0 + np.abs(dot) + norm * radius)
            upper.append(dot + norm * radius + slack)
            lower.append(dot - norm * radius - slack)
        rank = [np.argsort(-u, kind="stable") for u in upper]
        heap, seen = [(-(upper[0][rank[0][0]] + upper[1][rank[1][0]]), 0, 0)], {(0, 0)}
        while heap:
            neg, a, b = heapq.heappop(heap)
            if -neg < lo:
                return
            i, j = int(rank[0][a]), int(rank[1][b])
            if (i, j) in self.count and lower[0][i] + lower[1][j] <= hi:
                yield i * self.k2 + j, -neg
            for na, nb in ((a + 1, b), (a, b + 1)):
                if na < len(rank[0]) and nb < len(rank[1]) and (na, nb) not in seen:
                    seen.add((na, nb))
                    heapq.heappush(heap, (-(upper[0][rank[0][na]] + upper[1][rank[1][nb]]), na, nb))


class Index:
    """Every row placed in its cell and chunk (`rows`), and the cells' summary (`cells`)."""

    def __init__(self, rows: DataFrame, d: int, codes: int, sample: int, chunk_rows: int):
        self.d, self.h = d, d // 2
        n = rows.count()
        picked = rows.sample(fraction=min(1.0, 2.0 * sample / max(n, 1)), seed=11).limit(sample).select("x").toPandas()
        points = np.array(picked["x"].tolist(), dtype=np.float64).reshape(-1, d)
        self.books = [kmeans(points[:, : self.h], codes), kmeans(points[:, self.h :], codes)]
        self.k2 = len(self.books[1])
        books = self.books
        h = self.h

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)
                out = {"key": batch.column("key"), "label": batch.column("label"), "x": batch.column("x")}
                for half, (part, book) in enumerate(((x[:, :h], books[0]), (x[:, h:], books[1]))):
                    dist = ((part[:, None, :] - book[None, :, :]) ** 2).sum(axis=2)
                    near = dist.argmin(axis=1)
                    out[f"c{half}"] = pa.array(near.astype(np.int64))
                    out[f"r{half}"] = pa.array(np.sqrt(dist[np.arange(len(near)), near]))
                yield pa.RecordBatch.from_pydict(out)

        placed = stored(rows.mapInArrow(assign, "key long, label long, x array<bigint>, c0 long, r0 double, c1 long, r1 double"), "placed")
        self.radius = [np.zeros(len(b)) for b in self.books]
        for half in (0, 1):
            for row in placed.groupBy(f"c{half}").agg(F.max(f"r{half}").alias("r")).collect():  # one row per centroid
                self.radius[half][row[0]] = row["r"]
        self.count = {(r["c0"], r["c1"]): r["count"] for r in placed.groupBy("c0", "c1").count().collect()}  # one per cell
        chunks = {c * self.k2 + e: max(1, math.ceil(m / chunk_rows)) for (c, e), m in self.count.items()}
        self.chunks = chunks
        cell = F.col("c0") * self.k2 + F.col("c1")
        spread = F.create_map(*[v for item in sorted(chunks.items()) for v in (F.lit(item[0]), F.lit(item[1]))])
        self.rows = stored(placed.select(cell.alias("cell"), F.pmod(F.xxhash64("key"), spread[cell]).cast("int").alias("chunk"), "key", "label", "x"), "rows")
        self.cells = Cells(self.books, self.radius, self.count, self.chunks, self.k2, self.h)


def best_of_block(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """For each query of a block, its best k rows of a chunk by exact integer score, within its label rule,
    skipped key and score bounds; ties by the smaller key."""
    empty = pd.DataFrame({"qid": pd.Series([], dtype="int64"), "key": pd.Series([], dtype="int64"), "score": pd.Series([], dtype="int64")})
    if queries.empty or rows.empty:
        return empty
    x = np.stack(rows["x"].to_numpy()).astype(np.int64)
    keys, labels = rows["key"].to_numpy(np.int64), rows["label"].to_numpy(np.int64)
    out = []
    for at in range(0, len(queries), SLICE_QUERIES):
        part = queries.iloc[at : at + SLICE_QUERIES]
        q = np.stack(part["q"].to_numpy()).astype(np.int64)
        # Doubles are exact while every partial sum stays below 2^53; beyond that, integers.
        if np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * x.shape[1] < 2.0**53:
            scores = np.rint(q.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64)
        else:
            scores = q @ x.T
        for i, (qid, label, same, lo, hi, skip) in enumerate(zip(part["qid"], part["label"], part["same"], part["lo"], part["hi"], part["skip"])):
            ok = (labels == label) if same else (labels != label)
            if pd.notna(skip):
                ok &= keys != skip
            if pd.notna(lo):
                ok &= scores[i] >= lo
            if pd.notna(hi):
                ok &= scores[i] <= hi
            at_ok = np.flatnonzero(ok)
            if len(at_ok) > k:
                values = scores[i, at_ok]
                at_ok = at_ok[values >= np.partition(values, len(values) - k)[len(values) - k]]
            top = at_ok[np.lexsort((keys[at_ok], -scores[i, at_ok]))[:k]]
            out.append(pd.DataFrame({"qid": np.full(len(top), qid, np.int64), "key": keys[top], "score": scores[i, top]}))
    return pd.concat(out) if out else empty


def search(index: Index, queries: DataFrame, k: int, window: int = 32) -> DataFrame:
    """The best k rows for each query, exactly: (qid, key, score, rank).

    Queries have qid, q (the vector), label, same (a row must have the same label, else another), lo and hi (bounds of
    the score, null for none) and skip (a key that never counts)."""
    spark = queries.sparkSession
    best = spark.createDataFrame([], "qid long, key long, score long")
    open_queries = stored(queries, "queries")
    start, end = 0, window
    while open_queries.limit(1).count():

        summary = index.cells

        def cells(batches: Iterator[pa.RecordBatch], start=start, end=end) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = {"qid": [], "cell": [], "chunk": [], "bound": []}
                for qid, q, lo, hi in zip(*(batch.column(c).to_pylist() for c in ("qid", "q", "lo", "hi"))):
                    lo = -math.inf if lo is None else lo - 1
                    hi = math.inf if hi is None else hi + 1
                    for at, (cell, bound) in enumerate(summary.order(np.array(q, dtype=np.float64), lo, hi)):
                        if at >= end:
                            # The bound of the first cell not yet visited: a marker row with no chunk.
                            out["qid"].append(qid), out["cell"].append(-1), out["chunk"].append(-1), out["bound"].append(bound)
                            break
                        if at >= start:
                            for chunk in range(summary.chunks[cell]):
                                out["qid"].append(qid), out["cell"].append(cell), out["chunk"].append(chunk), out["bound"].append(bound)
                yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("qid", pa.int64()), ("cell", pa.int64()), ("chunk", pa.int32()), ("bound", pa.float64())]))

        visit = stored(open_queries.select("qid", "q", "lo", "hi").mapInArrow(cells, "qid long, cell long, chunk int, bound double"), "visit")
        # Queries of a cell come in blocks of at most QUERY_ROWS, each meeting the cell's chunks of rows.
        blocks = max(1, math.ceil(open_queries.count() / QUERY_ROWS))
        probes = visit.where("cell >= 0").join(open_queries, "qid").withColumn("block", F.pmod(F.xxhash64("qid"), F.lit(blocks)).cast("int"))
        held = index.rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        group = ["cell", "chunk", "block"]
        found = probes.select(*group, "qid", "q", "label", "same", "lo", "hi", "skip").groupBy(*group).cogroup(held.groupBy(*group)).applyInPandas(
            lambda left, right: best_of_block(left, right, k), "qid long, key long, score long"
        )
        ranked = Window.partitionBy("qid").orderBy(F.desc("score"), "key")
        best = stored(best.unionByName(found).withColumn("rank", F.row_number().over(ranked)).where(f"rank <= {k}").drop("rank"), "best")
        tally = best.groupBy("qid").agg(F.count("*").alias("n"), F.min("score").alias("kth"))
        following = visit.where("cell < 0").select("qid", F.col("bound").alias("next_bound"))
        state = open_queries.select("qid").join(following, "qid", "left").join(tally, "qid", "left")
        # A query with no row found yet has no tally: it is certified only when no cell is left.
        certified = F.col("next_bound").isNull() | ((F.coalesce(F.col("n"), F.lit(0)) == k) & (F.coalesce(F.col("kth") > F.col("next_bound"), F.lit(False))))
        still = state.where(~certified).select("qid")
        open_queries = stored(open_queries.join(still, "qid", "left_semi"), "queries")
        start, end = end, end * 2
    return best.withColumn("rank", F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "key")))


def mine(rows: DataFrame, anchors: DataFrame, d: int, positives: int = 5, negatives: int = 5, codes: int = 16, sample: int = 20_000, chunk_rows: int = 20_000) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for prepared rows (key, label, x)
    and the anchors among them (key, label, x)."""
    spark = rows.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not d or not rows.limit(1).count():
        return spark.createDataFrame([], schema)
    index = Index(rows, d, codes, sample, chunk_rows)
    first = anchors.select(
        F.monotonically_increasing_id().alias("qid"), F.col("key").alias("anchor_id"), F.col("x").alias("q"), "label", F.lit(True).alias("same"),
        F.lit(None).cast("long").alias("lo"), F.lit(None).cast("long").alias("hi"), F.col("key").alias("skip"),
    )
    first = stored(first, "anchors")
    found = search(index, first.drop("anchor_id"), positives).join(first.select("qid", "anchor_id", "q", "label"), "qid")
    pairs = found.select(
        F.monotonically_increasing_id().alias("qid"), "anchor_id", F.col("key").alias("positive_id"), F.col("score").alias("positive_score"), "q", "label",
        F.lit(False).alias("same"), F.expr("-floor(-(80 * score) / 100)").cast("long").alias("lo"), F.col("score").alias("hi"), F.lit(None).cast("long").alias("skip"),
    )
    pairs = stored(pairs, "pairs")
    negs = search(index, pairs.drop("anchor_id", "positive_id", "positive_score"), negatives)
    out = negs.join(pairs.select("qid", "anchor_id", "positive_id", "positive_score"), "qid")
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int"), F.col("key").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
