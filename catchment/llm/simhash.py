"""SimHash near-duplicates: fingerprints over word shingles, linked through deletion-variant signatures.

A fingerprint is cut into just so many segments that, within the allowed number of differing bits, one segment differs
in at most one bit. Every segment is indexed once for each of its bits, with that bit left out: two segments that
differ in one bit share the variant without it, equal ones share all. An equality join on variants brings the
candidates together, and all 64 bits decide.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from catchment.llm.buffers import flat, giving_back
from catchment.llm.components import components, stored
from catchment.llm.groups import whole_groups
from catchment.session import shared_dir

#: Words of a shingle, the seed of its hash, and the most bits in which linked fingerprints differ.
SHINGLE_WORDS = 4
SEED = 42
MOST_BITS = 4
#: Shingles hashed at once, which bounds the memory of a very long text.
BLOCK = 1 << 16

_LANES = np.uint64(0x0101010101010101)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits set; byte lanes add up 255 hashes at a time."""
    padded = np.concatenate([hashes, np.zeros(-len(hashes) % 255, np.uint64)])
    counts = np.zeros(64, np.int64)
    for bit in range(8):
        lanes = ((padded >> np.uint64(bit)) & _LANES).reshape(-1, 255).sum(1)
        counts[bit::8] = lanes.view(np.uint8).reshape(-1, 8).sum(0, dtype=np.int64)
    return counts


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """Fingerprint of a text as an unsigned integer; zero without words."""
    split = text.lower().split()  # both touch ASCII only
    if not split:
        return 0
    joined = b" ".join(split)
    ends = np.cumsum(np.fromiter(map(len, split), np.int64, len(split)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    ends = ends[words - 1 :] if len(split) >= words else ends[-1:]
    starts = starts[: len(ends)]
    counts, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for i in range(0, len(ends), BLOCK):
        cuts = zip(starts[i : i + BLOCK].tolist(), ends[i : i + BLOCK].tolist())
        counts += bit_counts(np.array([digest(joined[a:b], SEED) for a, b in cuts], np.uint64))
    return int(np.packbits(2 * counts > len(ends), bitorder="little").view("<u8")[0])


def fingerprints(text: Column | str, words: int = SHINGLE_WORDS) -> Column:
    """Fingerprints of a text column as signed longs. A null text has no words."""

    @arrow_udf("long")
    @giving_back
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            data, offsets = flat(texts)
            raw, cuts = data.tobytes(), offsets.tolist()
            found = [fingerprint(raw[a:b], words) for a, b in zip(cuts, cuts[1:])]
            yield pa.array(np.array(found, np.uint64).view(np.int64))

    return run(text)


def variants(fp: str, most_bits: int = MOST_BITS) -> Column:
    """All deletion-variant signatures of a fingerprint: one long for each bit, 64 in all."""
    segments = most_bits // 2 + 1
    bounds = [round(64 * i / segments) for i in range(segments + 1)]
    keys = []
    for s, (low, high) in enumerate(zip(bounds, bounds[1:])):
        width = high - low
        value = F.shiftrightunsigned(F.col(fp), low).bitwiseAND(F.lit((1 << width) - 1))
        for p in range(width):
            rest = F.shiftleft(F.shiftrightunsigned(value, p + 1), p).bitwiseOR(value.bitwiseAND(F.lit((1 << p) - 1)))
            keys.append(rest.bitwiseOR(F.lit(((s << 6) | p) << 48)))
    return F.array(*keys)


#: Groups of up to this many fingerprints are compared pair by pair; in larger ones a found member is not compared again.
PAIRWISE = 32


def link_groups(key: np.ndarray, fp: np.ndarray, most_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is joined within each group of equal keys: no more of them than members in a large group."""
    edges = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
    sizes = np.diff(edges)
    size_of = np.repeat(sizes, sizes)
    us, vs = [], []
    unsigned = fp.view(np.uint64)
    small = np.flatnonzero((size_of > 1) & (size_of <= PAIRWISE))
    for step in range(1, PAIRWISE):
        small = small[small + step < len(key)]
        small = small[key[small] == key[small + step]]
        if not len(small):
            break
        near = small[np.bitwise_count(unsigned[small] ^ unsigned[small + step]) <= most_bits]
        us.append(fp[near + step])
        vs.append(fp[near])
    for g in np.flatnonzero(sizes > PAIRWISE):
        rest = fp[edges[g] : edges[g + 1]]
        while len(rest):
            root, todo, rest = rest[0], [rest[0]], rest[1:]
            while todo and len(rest):
                near = np.bitwise_count((rest ^ todo.pop()).view(np.uint64)) <= most_bits
                if near.any():
                    us.append(rest[near])
                    vs.append(np.full(near.sum(), root))
                    todo.extend(rest[near])
                    rest = rest[~near]
    empty = np.empty(0, np.int64)
    return np.concatenate([empty, *us]), np.concatenate([empty, *vs])


def links(distinct: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """u, v: links that connect the same fingerprints as all pairs within `most_bits` do; `distinct` has a column fp."""
    keyed = distinct.select(F.explode(variants("fp", most_bits)).alias("key"), "fp")
    dealt = keyed.repartition("key").sortWithinPartitions("key", "fp")

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "key"):
            u, v = link_groups(table.column("key").to_numpy(), table.column("fp").to_numpy(), most_bits)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    return dealt.mapInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, most_bits: int = MOST_BITS) -> DataFrame:
    """doc_id, fp and component_id of each row: the least doc_id among all that its fingerprint reaches.

    Copies share a fingerprint and are linked once. Null texts and texts without words have fingerprint zero and are
    linked like any other. A null doc_id is never a component's id unless no row of the component has one. Only doc_id
    and text are read; repeated rows come out as often as they went in; an empty table gives no rows.
    """
    return grouped(docs, words, most_bits).select("doc_id", "fp", "component_id")


def grouped(docs: DataFrame, words: int = SHINGLE_WORDS, most_bits: int = MOST_BITS, also: Sequence[Column] = ()) -> DataFrame:
    """As near_duplicates, with the root and the columns `also` of docs: only the root tells components apart that rows of one doc_id name."""
    at = f"{shared_dir(docs.sparkSession)}/simhash-{uuid.uuid4()}"
    prints = stored(docs.select("doc_id", fingerprints(F.col("text"), words).alias("fp"), *also), f"{at}/prints")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    rooted = components(links(distinct.select("fp"), most_bits))
    labelled = distinct.join(rooted.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    labelled = stored(labelled, f"{at}/labelled")
    least = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    of_print = labelled.join(least, "root").select("fp", "root", "component_id")
    return prints.join(of_print, "fp")
