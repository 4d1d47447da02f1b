"""Filters, paging, slices and summaries that a reader of bank data asks for."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



# ---------------------------------------------------------------- filters


def by_ids(df: DataFrame, column: str, ids: list) -> DataFrame:
    return df.filter(F.col(column).isin(*ids))


by_states = by_ids


def by_year_range(df: DataFrame, column: str, years: list[int]) -> DataFrame:
    """Inclusive range; with fewer than two bounds nothing is filtered."""
    return df.filter(F.col(column).between(years[0], years[1])) if len(years) >= 2 else df


def all_of(df: DataFrame, equalities: dict[str, object]) -> DataFrame:
    terms = [F.col(name) == value for name, value in equalities.items()]
    return df.filter(reduce(Column.__and__, terms)) if terms else df


def not_in_class(df: DataFrame, column: str, *values: str) -> DataFrame:
    """Rows of any other class; rows without a class are kept."""
    return df.filter(F.coalesce(~F.col(column).isin(*values), F.lit(True)))


# ---------------------------------------------------------------- slices


def _midnight(day: dt.date) -> Column:
    return F.lit(day).cast("timestamp_ntz")


def read_years(df: DataFrame, column: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """Years ``first`` to ``last``, by default the ten up to now. Prunes partitions when split by year."""
    last = dt.date.today().year if last is None else last
    first = last - 9 if first is None else first
    return df.filter(F.col(column).between(first, last))


def slice_by_year(df: DataFrame, date: str, years: list[int], flag: str | None = None, value: object = None) -> DataFrame:
    """Rows of the wanted years with their ``year``.

    Neighbouring years become one half-open range on the date itself, so the filter reaches the scan.
    """
    ends = sorted(set(years))
    starts = [y for y in ends if y - 1 not in ends]
    stops = [y + 1 for y in ends if y + 1 not in ends]
    wanted = reduce(
        Column.__or__,
        [(F.col(date) >= _midnight(dt.date(a, 1, 1))) & (F.col(date) < _midnight(dt.date(b, 1, 1))) for a, b in zip(starts, stops)],
        F.lit(False),
    )
    rows = df.filter(wanted)
    if flag is not None:
        rows = rows.filter(F.col(flag) == value)
    return rows.withColumn("year", F.year(date))


def write_year_slices(df: DataFrame, path: str, date: str, key: str) -> None:
    """One folder per year, each file in date order. Rows of a year are spread over tasks, not sent to one."""
    (
        df.repartitionByRange("year", date, key)
        .sortWithinPartitions("year", date, key)
        .write.mode("overwrite")
        .partitionBy("year")
        .parquet(path)
    )


def slice_by_day(df: DataFrame, stamp: str, days: int, today: dt.date) -> DataFrame:
    """The last ``days`` days and today, each closed at the start of the next day."""
    first, last = today - dt.timedelta(days=days), today + dt.timedelta(days=1)
    return df.filter((F.col(stamp) >= _midnight(first)) & (F.col(stamp) < _midnight(last)))


def landed_pages(rows: DataFrame, page: str, page_size: int) -> DataFrame:
    """Rows of every page up to and including the first short one."""
    counts = rows.groupBy(page).agg(F.count(F.lit(1)).alias("_n"))
    first_short = counts.filter(F.col("_n") < page_size).agg(F.min(page)).scalar()
    return rows.filter(F.coalesce(F.col(page) <= first_short, F.lit(True)))


def completeness(rows: DataFrame, total: int) -> DataFrame:
    """Rows landed against the total the source reported."""
    return rows.agg(F.count(F.lit(1)).alias("landed")).select(
        "landed", F.lit(total).cast("bigint").alias("total"), (F.col("landed") == total).alias("complete")
    )


# ---------------------------------------------------------------- order and paging


def order(df: DataFrame, sort_by: str, sort_order: str = "ASC", key: str | None = None) -> DataFrame:
    """Sorted by one field with nulls last, ties by key.

    Without a key, ties follow a hash of the row, so that one value held by much of all rows still
    spreads over the sorted partitions.
    """
    first = F.col(sort_by).asc_nulls_last() if sort_order.upper() == "ASC" else F.col(sort_by).desc_nulls_last()
    return df.orderBy(first, F.col(key).asc_nulls_last() if key else row_hash(df))


def row_hash(df: DataFrame) -> Column:
    """A repeatable number per row, over the columns that can be hashed."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema if "map<" not in f.dataType.simpleString()])


def page(
    df: DataFrame,
    sort_by: str,
    sort_order: str = "ASC",
    limit: int = 10,
    offset: int = 0,
    key: str | None = None,
    ranges: int = 64,
    settle_rows: int = 200_000,
    seed: int = 7,
) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` of the sorted frame, in its order, without sorting or writing the frame.

    The order is that of :func:`order`: the sort field with nulls last, then ``key`` (if given), then a hash of the
    row, so that rows only tie when they are equal in every hashable column. A bounded sample of sort keys (about
    ``8 * ranges`` rows) gives up to ``ranges - 1`` bounds; every bound is a range of its own beside the open ranges
    between bounds, and one aggregation counts the rows of each exactly. Only the ranges that overlap the page are
    followed: a range of at most ``settle_rows`` rows gives its slice by a bounded top-k (offset plus limit rows per task), a range of one sort key (rows equal in all
    hashable columns, such as a third of the table holding one value) gives any ``limit`` of its rows, and a larger
    range is split again in the same way. A page that ends within the first ``settle_rows`` rows is taken by that top-k
    at once, without counting. Each pass is one scan whose first sort field is filtered by a predicate
    Parquet can take. An offset past the end gives no rows.
    """
    if limit <= 0 or offset < 0:
        return df.limit(0)
    descending = sort_order.upper() != "ASC"
    keyed = df.withColumn("_tie", row_hash(df))
    terms = [(sort_by, descending)] + ([(key, False)] if key else []) + [("_tie", False)]
    names = [name for name, _ in terms]
    types = {name: keyed.schema[name].dataType for name in names}

    def literal(name, value):
        return F.lit(value).cast(types[name])

    def after(name, down, value):
        column = F.col(name)
        if value is None:
            return F.lit(False)
        return column.isNull() | (column < literal(name, value) if down else column > literal(name, value))

    def same(name, value):
        return F.col(name).eqNullSafe(literal(name, value))

    def beyond(bound, inclusive):
        """Rows whose sort key is after ``bound`` (or equal to it, if inclusive)."""
        term = F.lit(inclusive)
        for (name, down), value in reversed(list(zip(terms, bound))):
            term = F.coalesce(after(name, down, value) | (same(name, value) & term), F.lit(False))
        return term

    def coarse(low, high):
        """The same range on the first field alone, in a form the Parquet scan takes."""
        column, parts = F.col(sort_by), []
        if low is not None:
            value = low[0][0]
            parts.append(column.isNull() if value is None else column.isNull() | (column <= value if descending else column >= value))
        if high is not None and high[0][0] is not None:
            value = high[0][0]
            parts.append(column >= value if descending else column <= value)
        return reduce(lambda a, b: a & b, parts, F.lit(True))

    def within(low, high):
        """Rows in the range ``low`` .. ``high``; each end is ``(key, inclusive)`` or None for no end."""
        term = coarse(low, high)
        if low is not None:
            term = term & beyond(low[0], low[1])
        if high is not None:
            term = term & ~beyond(high[0], not high[1])
        return term

    sort = [F.col(n).desc_nulls_last() if d else F.col(n).asc_nulls_last() for n, d in terms]

    pieces: list[DataFrame] = []

    def follow(low, high, rows_in: int, skip: int, take: int, fraction: float) -> None:
        rows = keyed.where(within(low, high))
        if rows_in <= settle_rows:
            pieces.append(rows.orderBy(*sort).offset(skip).limit(take))
            return
        sampled = rows.select(*names).sample(False, min(1.0, fraction * 8 * ranges / rows_in), seed).distinct()
        drawn = [tuple(r) for r in sampled.orderBy(*sort).limit(32 * ranges).collect()]
        if not drawn:
            follow(low, high, rows_in, skip, take, fraction * 4)
            return
        step = max(1, len(drawn) // ranges)
        bounds = drawn[step // 2 :: step][: ranges - 1] or drawn[:1]
        at_least = reduce(lambda a, b: a + b, [beyond(b, True).cast("int") for b in bounds])
        equal = reduce(lambda a, b: a | b, [reduce(lambda x, y: x & y, [same(n, v) for n, v in zip(names, b)]) for b in bounds])
        counts = dict(rows.groupBy((at_least * 2 - equal.cast("int")).alias("_range")).count().collect())
        start = 0
        for number in range(2 * len(bounds) + 1):
            n = counts.get(number, 0)
            if n and start < skip + take and start + n > skip:
                here = max(skip - start, 0)
                count = min(skip + take, start + n) - start - here
                if number % 2:
                    bound = bounds[number // 2]
                    same_key = reduce(lambda x, y: x & y, [same(nm, v) for nm, v in zip(names, bound)])
                    pieces.append(keyed.where(coarse((bound, True), (bound, True)) & same_key).limit(count))
                else:
                    lower = low if number == 0 else (bounds[number // 2 - 1], False)
                    upper = high if number // 2 == len(bounds) else (bounds[number // 2], False)
                    follow(lower, upper, n, here, count, 1.0)
            start += n

    if offset + limit <= settle_rows:
        return keyed.orderBy(*sort).offset(offset).limit(limit).drop("_tie")
    total = df.count()
    if offset < total:
        follow(None, None, total, offset, limit, 1.0)
    if not pieces:
        return df.limit(0)
    numbered = [p.withColumn("_piece", F.lit(i)) for i, p in enumerate(pieces)]
    together = reduce(lambda a, b: a.unionByName(b), numbered)
    return together.orderBy("_piece", *sort).drop("_piece", "_tie")


def sample(df: DataFrame, rows: int = 10) -> DataFrame:
    """The first rows by the first column."""
    return df.orderBy(F.col(df.columns[0]).asc_nulls_last()).limit(rows)


# ---------------------------------------------------------------- summaries


def year_summary(df: DataFrame, year: str = "YEAR", key: str = "CERT", measures: tuple[str, ...] = ("DEPSUM", "DEPSUMBR")) -> DataFrame:
    """Count of ids, and sum and mean of each measure, to two decimals."""
    aggregates = [F.count(key).alias(f"{key}_count")]
    for name in measures:
        value = F.col(name)
        aggregates += [F.round(F.sum(value), 2).alias(f"{name}_sum"), F.round(F.avg(value), 2).alias(f"{name}_mean")]
    return df.groupBy(year).agg(*aggregates)


def aggregate_by(df: DataFrame, key: str, terms: list[str] = (), sums: list[str] = (), limit: int = 1) -> DataFrame:
    """Rows and sums per key and term fields; the ``limit`` largest groups, ties by key."""
    groups = [key, *terms]
    grouped = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("count"), *[F.sum(c).alias(f"sum_{c}") for c in sums])
    return grouped.orderBy(F.desc("count"), *[F.col(c).asc_nulls_last() for c in groups]).limit(limit)


def record_total(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total"))
