"""Near-duplicate vectors by a pigeonhole join over subspaces.

Unit vectors are turned by a fixed random rotation and rounded to 16 bits a coordinate, with a known greatest error, and
cut into blocks of dimensions. The squared distance that the threshold allows is shared out in proportion to the blocks'
dimensions, so a pair within it is within its share in some block. For each block the rounded vectors are dealt to cells
of its first coordinates and written as chunks, in the order of a tree of halvings; every two chunks meet in a task that
reads them again from there. Nothing is copied for the cells or chunks that a vector can reach, so the disk taken grows
with the vectors alone. In a task two chunks are halved down their trees, and of each half only those vectors go on that
can reach the box around the other. A pair counts in the first block that finds it, so no pair is listed, stored or
counted twice, but for those whose rounding leaves open whether they link: these are listed, and settled by the exact
cosine.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catchment.llm.buffers import giving_back
from catchment.llm.components import components, stored
from catchment.session import shared_dir

#: Least cosine of a link; least dimensions and greatest number of blocks.
LEAST_COSINE = 0.95
BLOCK_DIMS = 16
BLOCKS = 4
#: Least vectors at home in a cell, on average. A cell holds a sixteenth of the vectors if that is more and fits a chunk.
CELL = 4096
#: Vector components in a chunk at most: two chunks are held in one task. Larger cells make several chunks.
PART_VALUES = 1 << 23
#: Vectors that the cells' borders, medians of coordinates, are taken from.
SAMPLE = 4096
#: Pairs of vectors that are compared at a stroke, and vectors of a chunk that are not halved further.
TILE, LEAF = 1 << 20, 64
#: Steps of a coordinate between 0 and 1.
SCALE = 32767


@lru_cache(maxsize=8)
def rotation(dims: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(dims).standard_normal((dims, dims)))[0]


def blocks(dims: int) -> list[slice]:
    width = max(BLOCK_DIMS, -(-dims // BLOCKS))
    return [slice(i, min(i + width, dims)) for i in range(0, dims, width)]


def reach(dims: int, least_cosine: float) -> tuple[float, float]:
    """Squared distances of rounded vectors, in steps: up to the first a pair is surely linked, beyond the second surely not."""
    error = np.sqrt(dims) + 0.01  # half a step a coordinate in either vector, and a little for double precision
    apart = np.sqrt(max(0.0, 2 - 2 * least_cosine)) * SCALE
    return (apart - error) ** 2 if apart > error else -1.0, (apart + error) ** 2


def budgets(dims: int, least_cosine: float) -> np.ndarray:
    """Squared distance allowed in each block, in steps and in proportion to its dimensions."""
    share = np.array([b.stop - b.start for b in blocks(dims)]) / dims
    return share * reach(dims, least_cosine)[1] * (1 + 1e-9)


def matrix(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def level(x: np.ndarray) -> np.ndarray:
    """Each row times a power of two, so that squares neither overflow nor vanish."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])


def rounded(x: np.ndarray) -> np.ndarray:
    x = level(x)
    return np.rint((x / np.linalg.norm(x, axis=1, keepdims=True)) @ rotation(x.shape[1]) * SCALE).astype(np.int16)


def codes(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int16).reshape(-1, dims)


def halved(x: np.ndarray) -> np.ndarray:
    """The rows in the order of a tree of halvings, each across the widest column; the half of a stretch ends at its middle."""
    order, todo = np.arange(len(x)), [(0, len(x))]
    while todo:
        low, high = todo.pop()
        if high - low > LEAF:
            part, middle = x[order[low:high]], (low + high) // 2
            cut = np.argpartition(np.ascontiguousarray(part[:, np.argmax(part.std(0))]), middle - low)
            order[low:high] = order[low:high][cut]
            todo += [(low, middle), (middle, high)]
    return order


class _Sets:
    """Disjoint sets over row numbers, merged by arrays of pairs; the least member is the root."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def merge(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            a, b = self.parent[i], self.parent[j]
            differ = a != b
            if not differ.any():
                return
            i, j, a, b = i[differ], j[differ], a[differ], b[differ]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(up := self.parent[self.parent], self.parent):
                self.parent = up


class _Pair:
    """The links that block b is the first to find between two chunks, or within one where both are the same."""

    def __init__(self, chunks: list[dict], dims: int, b: int, least_cosine: float):
        self.parts, self.b = blocks(dims), b
        self.budget, (self.sure, self.open) = budgets(dims, least_cosine), reach(dims, least_cosine)
        self.codes = np.concatenate([np.frombuffer(c["codes"], np.int16) for c in chunks]).reshape(-1, dims)
        self.node, self.copies = (np.concatenate([np.frombuffer(c[k], np.int64) for c in chunks]) for k in ("nodes", "copies"))
        self.links, self.sets, self.unsure = np.zeros(len(self.node), np.int64), _Sets(len(self.node)), []
        self.cut = self.codes[:, self.parts[b]].astype(np.float32) / np.float32(SCALE)
        width = self.cut.shape[1]
        self.most = np.float32(self.budget[b] / SCALE**2 + (width + 8) * 2.5e-7)  # for single precision; the exact test follows
        square, ones = (self.cut * self.cut).sum(1, keepdims=True), np.ones((len(self.cut), 1), np.float32)
        self.turned, self.cut_ones = np.hstack([self.cut * -2, square, ones]), np.hstack([self.cut, ones, square])  # their product is the squared distance
        self.fold, self.ones = max(1, 128 // width), np.ones(width, np.float32)
        ends = np.cumsum([0, *(c["n"] for c in chunks)]).tolist()
        whole = [(np.arange(low, high), low, high) for low, high in zip(ends, ends[1:])]
        self.todo = [(whole[0], None)] if len(whole) == 1 else [(whole[0], whole[1])]
        while self.todo:
            self._step(*self.todo.pop())

    def _wide(self, rows: np.ndarray) -> np.ndarray:
        """The rows' coordinates, many rows in one of the array, as short ones are slow; the last row fills up."""
        if more := -len(rows) % self.fold:
            rows = np.concatenate([rows, rows[-1:].repeat(more)])
        return self.cut.take(rows, 0).reshape(len(rows) // self.fold, -1)

    def _near(self, rows: np.ndarray, others: np.ndarray) -> np.ndarray:
        """Those of `rows` that can reach the box around `others`."""
        box, shape = self._wide(others), (self.fold, len(self.ones))
        low = np.broadcast_to(np.minimum.reduce(np.minimum.reduce(box, 0).reshape(shape), 0), shape).ravel()
        high = np.broadcast_to(np.maximum.reduce(np.maximum.reduce(box, 0).reshape(shape), 0), shape).ravel()
        out = []
        for i in range(0, len(rows), 4096):
            x = self._wide(some := rows[i : i + 4096])
            gap = np.maximum(x, low)
            np.minimum(gap, high, out=gap)
            gap -= x
            gap *= gap
            out.append(some[(gap.reshape(-1, len(self.ones)) @ self.ones)[: len(some)] <= self.most])
        return np.concatenate(out) if len(out) > 1 else out[0]

    def _step(self, left: tuple, right: tuple | None) -> None:
        """A side: rows in order, and the stretch of the tree that they are of. Without a right side, the pairs within the left."""
        rows, low, high = left
        others = rows if right is None else right[0]
        if len(rows) * len(others) <= TILE or max(high - low, 0 if right is None else right[2] - right[1]) <= LEAF:
            wide = 512 if right is None else max(512, TILE // len(rows))
            for i in range(0, len(rows), 512):
                for j in range(i if right is None else 0, len(others), wide):
                    self._compare(rows[i : i + 512], others[j : j + wide], right is None and i == j)
            return
        if right is not None and (len(rows) < len(others) and right[2] - right[1] > LEAF or high - low <= LEAF):
            left, right = right, left
            rows, low, high = left
        middle = (low + high) // 2
        at = int(np.searchsorted(rows, middle))
        halves = [h for h in ((rows[:at], low, middle), (rows[at:], middle, high)) if len(h[0])]
        if right is None:
            self.todo += [(h, None) for h in halves]
            pairs = [halves] if len(halves) == 2 else []
        else:
            pairs = [(h, right) for h in halves]
        for (some, start, end), (others, first, last) in pairs:
            others = self._near(others, some)
            some = self._near(some, others) if len(others) else others
            if len(some):
                self.todo.append(((some, start, end), (others, first, last)))

    def _compare(self, rows: np.ndarray, others: np.ndarray, once: bool) -> None:
        """Count and merge the links between `rows` and `others`; once: both are the same."""
        distance = self.turned.take(rows, 0) @ self.cut_ones.take(others, 0).T
        if not once and distance.min() > self.most:
            return
        near = distance <= self.most
        if once:
            near = np.triu(near, 1)
        u, v = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
        if not len(u):
            return
        near, u, v = near[np.ix_(u, v)], rows[u], others[v]
        x, y, total = self.codes[u].astype(np.float64), self.codes[v].astype(np.float64), 0.0
        for b, s in enumerate(self.parts):  # whole numbers, which double precision holds exactly
            apart = (x[:, s] ** 2).sum(1)[:, None] + (y[:, s] ** 2).sum(1)[None, :] - 2 * (x[:, s] @ y[:, s].T)
            total = total + apart
            if b <= self.b:
                near &= (apart <= self.budget[b]) == (b == self.b)
        linked = near & (total <= self.sure)
        p, q = np.nonzero(near & ~linked & (total <= self.open))
        if len(p):
            self.unsure.append((self.node[u[p]], self.node[v[q]]))
        self.links[u] += linked @ self.copies[v]
        self.links[v] += self.copies[u] @ linked
        while True:  # each row's first link across sets, until no link is
            across = linked & (self.sets.parent[u][:, None] != self.sets.parent[v][None, :])
            some = np.flatnonzero(across.any(1))
            if not len(some):
                return
            self.sets.merge(u[some], v[across[some].argmax(1)])


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: Shuffles go as soon as what was made of them is written; a scan's partition holds whole chunks.
_SETTINGS = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.files.maxPartitionBytes": "64m"}


def near_duplicates(vectors: DataFrame, least_cosine: float = LEAST_COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept of each row.

    n_links counts the other rows with a cosine of `least_cosine` or more, copies included. Vectors that are null,
    empty, zero or hold a null or non-finite component link with nothing, nor do vectors of different lengths. A null
    vec_id is linked, but names no component and is not kept. Rows that share a vec_id are told apart by their vectors,
    which two 64-bit hashes stand for. Only vec_id and embedding are read; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    at = f"{shared_dir(spark)}/embeddings-{uuid.uuid4()}"
    single = dict(vectors.dtypes)["embedding"] == "array<float>"
    kind = "array<float>" if single else "array<double>"
    rows = vectors.select("vec_id", F.col("embedding").cast(kind).alias("embedding"))
    sound = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("embedding", lambda v: v != 0)
    rows = rows.withColumn("embedding", F.when(F.coalesce(sound, F.lit(False)), F.col("embedding")))
    hashes = [F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(7), "embedding").alias("h2")]
    distinct = rows.where("embedding is not null").groupBy("embedding").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    distinct = distinct.select(F.monotonically_increasing_id().alias("node"), F.size("embedding").alias("dims"), "copies", "least", *hashes, "embedding")

    @giving_back
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("dims").to_numpy()
            for dims in np.unique(lengths).tolist():
                part = batch.filter(pa.array(lengths == dims))
                rows = pa.array([c.tobytes() for c in rounded(matrix(part.column("embedding"), dims))], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], rows], names=[*part.schema.names[:-1], "code"])

    with _settings(spark, _SETTINGS):
        distinct = stored(distinct.mapInArrow(encode, "node long, dims int, copies long, least long, h1 long, h2 long, code binary"), f"{at}/distinct")
        found = _found(distinct, f"{at}/blocks", least_cosine)
        found = found.unionByName(_settled(rows.select(*hashes, "embedding"), distinct, found.where("links is null"), f"{at}/unsure", least_cosine))
        found = found.where("links is not null")
        linked = found.groupBy("node").agg(F.sum("links").alias("links"))
        roots = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
        named = distinct.select("node", "h1", "h2", "copies", "least").join(linked, "node", "left").join(roots, "node", "left")
        named = named.withColumn("root", F.coalesce("root", "node"))
        least = named.groupBy("root").agg(F.min("least").alias("component_id"))
        named = named.join(least, "root").select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
        named = stored(named, f"{at}/named")
    none = F.col("embedding").isNull()  # matches nothing, and is spread by its id
    keys = [F.when(none, F.xxhash64("vec_id")).otherwise(hashes[0]).alias("h1"), F.when(~none, hashes[1]).alias("h2")]
    out = rows.select("vec_id", none.alias("none"), *keys).join(named, ["h1", "h2"], "left")
    component = F.when(F.col("none"), F.col("vec_id")).otherwise(F.col("component_id"))
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _found(distinct: DataFrame, at: str, least_cosine: float) -> DataFrame:
    """node, links, root: per block and chunks how many rows a node links with, and a node it hangs on. Pairs still open are node and root without links."""
    total, longest = distinct.agg(F.count("*"), F.coalesce(F.max("dims"), F.lit(1))).first()
    home = max(1, min(max(CELL, total // 16), PART_VALUES // longest))
    bits = max(0, int(np.ceil(np.log2(max(total, 1) / home))))
    taken = distinct.where(F.pmod(F.xxhash64("node"), F.lit(1 << 20)) < (1 << 20) * min(1.0, SAMPLE / max(total, 1))).select("dims", "code").toArrow()
    taken_dims = taken.column("dims").to_numpy()
    borders = {n: np.median(codes(taken.column("code").filter(pa.array(taken_dims == n)), n), 0) for n in np.unique(taken_dims).tolist()}
    out = distinct.sparkSession.createDataFrame([], "node long, links long, root long")
    for b in range(len(blocks(longest)) if total else 0):
        chunks = f"{at}/{b}/chunks"
        _chunks(distinct, b, bits, borders, least_cosine).write.option("maxRecordsPerFile", 1).parquet(chunks)
        out = out.unionByName(stored(_compared(distinct.sparkSession.read.parquet(chunks), b, least_cosine), f"{at}/{b}/links"))
    return out


def _chunks(distinct: DataFrame, b: int, bits: int, borders: dict[int, np.ndarray], least_cosine: float) -> DataFrame:
    """The rounded vectors in chunks of a cell of block b: nodes, copies and codes one after another, and the box around them."""

    @giving_back
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("dims").to_numpy()
            for dims in np.unique(lengths).tolist():
                if b < len(blocks(dims)):
                    part, s = batch.filter(pa.array(lengths == dims)), blocks(dims)[b]
                    used = min(bits, s.stop - s.start)
                    above = codes(part.column("code"), dims)[:, s][:, :used] > borders.get(dims, np.zeros(dims))[s][:used]
                    cell = (above << np.arange(used, dtype=np.int64)).sum(1)
                    yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int64()), *part.columns], names=["cell", *part.schema.names])

    @giving_back
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n, of = 0, None
        for batch in batches:
            dims, cell = batch.column("dims").to_numpy(), batch.column("cell").to_numpy()
            cuts = np.flatnonzero(np.concatenate([[True], (dims[1:] != dims[:-1]) | (cell[1:] != cell[:-1]), [True]])).tolist()
            for low, high in zip(cuts, cuts[1:]):
                now = int(dims[low]), int(cell[low])
                while low < high:
                    if held and (now != of or n >= max(1, PART_VALUES // now[0])):
                        yield _chunk(held, of[0], b, least_cosine)
                        held, n = [], 0
                    some = min(high - low, max(1, PART_VALUES // now[0]) - n)
                    held.append(batch.slice(low, some))
                    low, n, of = low + some, n + some, now
        if held:
            yield _chunk(held, of[0], b, least_cosine)

    placed = distinct.select("dims", "node", "copies", "code").mapInArrow(place, "cell long, dims int, node long, copies long, code binary")
    placed = placed.repartition("dims", "cell").sortWithinPartitions("dims", "cell")
    return placed.mapInArrow(pack, "chunk long, dims int, n int, most double, low array<short>, high array<short>, nodes binary, copies binary, codes binary")


def _chunk(held: list[pa.RecordBatch], dims: int, b: int, least_cosine: float) -> pa.RecordBatch:
    table = pa.Table.from_batches(held)
    x, node, copies = codes(table.column("code"), dims), table.column("node").to_numpy(), table.column("copies").to_numpy()
    part = x[:, blocks(dims)[b]]
    order = halved(part.astype(np.float32))
    row = {"chunk": int(node.min()), "dims": dims, "n": len(x), "most": float(budgets(dims, least_cosine)[b]), "low": part.min(0), "high": part.max(0)}
    row |= {"nodes": node[order].tobytes(), "copies": copies[order].tobytes(), "codes": x[order].tobytes()}
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.list_(pa.int16()), pa.list_(pa.int16()), *[pa.binary()] * 3]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row.values(), kinds)], names=list(row))


def _compared(chunks: DataFrame, b: int, least_cosine: float) -> DataFrame:
    """Every two chunks whose boxes are within reach, and each with itself. Tasks read them from where they are written: nothing is shuffled."""

    @giving_back
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one, two, dims = (batch.column(c)[i] for c in ("one", "two", "dims"))
                both = [{k: c[k].as_buffer() if k in ("nodes", "copies", "codes") else c[k].as_py() for k in ("chunk", "n", "nodes", "copies", "codes")} for c in (one, two)]
                pair = _Pair(both[: 1 + (both[0]["chunk"] != both[1]["chunk"])], dims.as_py(), b, least_cosine)
                some = np.flatnonzero(pair.links)
                sure = [pa.array(pair.node[some]), pa.array(pair.links[some]), pa.array(pair.node[pair.sets.parent[some]])]
                yield pa.RecordBatch.from_arrays(sure, names=["node", "links", "root"])
                for u, v in pair.unsure:
                    yield pa.RecordBatch.from_arrays([pa.array(u), pa.nulls(len(u), pa.int64()), pa.array(v)], names=["node", "links", "root"])

    content = F.struct("chunk", "n", "nodes", "copies", "codes")
    one = chunks.select(F.col("dims"), F.col("chunk").alias("from"), F.col("low").alias("l1"), F.col("high").alias("h1"), "most", content.alias("one"))
    two = chunks.select(F.col("dims").alias("as"), F.col("chunk").alias("to"), F.col("low").alias("l2"), F.col("high").alias("h2"), content.alias("two"))
    apart = lambda low, high: F.zip_with(low, high, lambda x, y: x.cast("double") - y)
    gaps = F.zip_with(apart("l1", "h2"), apart("l2", "h1"), lambda x, y: F.greatest(x, y, F.lit(0.0)))
    within = F.aggregate(gaps, F.lit(0.0), lambda s, x: s + x * x) <= F.col("most")
    pairs = one.join(two.hint("shuffle_replicate_nl"), (F.col("dims") == F.col("as")) & (F.col("from") <= F.col("to")) & within)
    return pairs.select("dims", "one", "two").mapInArrow(compare, "node long, links long, root long")


def _settled(vectors: DataFrame, distinct: DataFrame, unsure: DataFrame, at: str, least_cosine: float) -> DataFrame:
    """As _found, for the pairs that rounding left open: those whose exact cosine links them."""
    ends = unsure.select("node").unionByName(unsure.select(F.col("root").alias("node"))).distinct()
    ends = stored(distinct.join(ends, "node").select("node", "copies", "h1", "h2"), f"{at}/ends")
    whole = stored(vectors.join(ends, ["h1", "h2"]).dropDuplicates(["node"]).select("node", "copies", "embedding"), f"{at}/vectors")
    both = unsure.select("node", "root").join(whole, "node").join(whole.select(F.col("node").alias("root"), F.col("copies").alias("others"), F.col("embedding").alias("other")), "root")

    @giving_back
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.array(batch.column("embedding").value_lengths())
            for dims in np.unique(lengths).tolist():
                part = batch.filter(pa.array(lengths == dims))
                x, y = (level(matrix(part.column(c), dims)) for c in ("embedding", "other"))
                size = np.sqrt(np.einsum("ij,ij->i", x, x) * np.einsum("ij,ij->i", y, y))
                part = part.filter(pa.array(np.einsum("ij,ij->i", x, y) / size >= least_cosine))
                u, v, n, m = (part.column(c) for c in ("node", "root", "copies", "others"))
                yield pa.RecordBatch.from_arrays([pa.concat_arrays([u, v]), pa.concat_arrays([m, n]), pa.concat_arrays([v, u])], names=["node", "links", "root"])

    return stored(both.mapInArrow(measure, "node long, links long, root long"), f"{at}/links")
