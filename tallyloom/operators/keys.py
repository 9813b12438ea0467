"""Code lists: missing, restricted, sliced. First rows by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def missing_symbols(requested: DataFrame, landed: DataFrame, key: str = "symbol") -> DataFrame:
    """Requested codes with no landed row: the set to run again.

    The landed side is reduced to its keys before the join, on the map side first, so a code with
    very many rows crosses the network as one row per task.
    """
    return requested.join(landed.select(key).distinct(), key, "left_anti")


def restrict_symbols(df: DataFrame, codes: DataFrame, key: str = "symbol") -> DataFrame:
    """Rows of an entity whose code is listed."""
    return df.join(codes.select(key).distinct(), key, "left_semi")


def first_rows(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """The first rows by key.

    The last key that belongs to them is found over the keys alone, in hashed parts (as many as shuffle partitions) of
    which each keeps its first rows; one row of it reaches the driver. The table is then scanned for
    rows up to that key, so the final sort reads little more than it returns.
    """
    narrow = df.select(F.struct(*keys).alias("at"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = Window.partitionBy(F.pmod(F.xxhash64("at"), F.lit(parts))).orderBy("at")
    firsts = narrow.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= rows)
    last = firsts.orderBy("at").limit(rows).agg(F.max("at").alias("at")).first()["at"]
    if last is None:
        return df.limit(0)
    bound = F.struct(*[F.lit(value).cast(df.schema[key].dataType) for key, value in zip(keys, last)])
    lead = F.col(keys[0])
    if last[0] is not None:
        df = df.filter(lead.isNull() | (lead <= F.lit(last[0])))
    return df.filter(F.struct(*keys) <= bound).orderBy(*keys).limit(rows)


#: A slice that ends here or before is the head of the sorted codes; deeper ones are found by ranges.
HEAD = 4096
#: Ranges of so many keys at most are searched by their sorted head.
_LAST = 1 << 14
_BOUNDS = 63


def _sides(key: Column, bounds: Sequence, first: int = 0) -> Column:
    """Place among sorted bounds: 2 i below bound i (and above the one before), 2 i + 1 at it. A tree of comparisons."""
    if not bounds:
        return F.lit(2 * first)
    middle = len(bounds) // 2
    above = _sides(key, bounds[middle + 1 :], first + middle + 1)
    return (
        F.when(key < F.lit(bounds[middle]), _sides(key, bounds[:middle], first))
        .when(key == F.lit(bounds[middle]), 2 * (first + middle) + 1)
        .otherwise(above)
    )


def _ranges(codes: DataFrame) -> tuple[list, list[tuple[int, int]]]:
    """A sample of keys, sorted, and the exact numbers of rows below, at and between them."""
    key = F.col(codes.columns[0])
    drawn = F.xxhash64(key, F.monotonically_increasing_id())
    bounds = sorted({row[0] for row in codes.orderBy(drawn).limit(_BOUNDS).collect()})
    counts = codes.groupBy(_sides(key, bounds).alias("side")).agg(F.count("*").alias("n")).collect()
    return bounds, sorted((row["side"], row["n"]) for row in counts)


def _key_at(codes: DataFrame, position: int, ranges: tuple[list, list[tuple[int, int]]]):
    """The key at a position of the sorted keys (none null), and the number of keys below it.

    The keys are cut into ranges and single keys, whose rows are counted exactly in one pass; the search goes on in the
    range that holds the position, and ends at a single key or in a short range.
    """
    key = F.col(codes.columns[0])
    below, inside = 0, codes
    while True:
        bounds, counts = ranges
        for side, n in counts:
            if below + n > position:
                break
            below += n
        if side % 2:
            return bounds[side // 2], below
        if side > 0:
            inside = inside.filter(key > F.lit(bounds[side // 2 - 1]))
        if side // 2 < len(bounds):
            inside = inside.filter(key < F.lit(bounds[side // 2]))
        if n <= _LAST:
            head = [row[0] for row in inside.orderBy(key).limit(position - below + 1).collect()]
            return head[-1], below + head.index(head[-1])
        ranges = _ranges(inside)


def slice_symbols(
    codes: DataFrame, start: int, stop: int | None = None, key: str = "symbol", head: int = HEAD
) -> DataFrame:
    """Codes at positions [start, stop) in code order, null first. Codes that repeat have a position each.

    A slice within the first ``head`` codes is the head of each task's codes, merged. For a deeper one the
    keys at its ends are found by counting ranges (a few passes over the codes; some dozen numbers each reach the
    driver); the codes between them are one filtered scan, and the ends are repeated as often as they
    belong to the slice. Nothing is written and nothing is numbered.
    """
    codes = codes.select(key)
    if stop is not None and stop <= head:
        return codes.orderBy(key).limit(stop).offset(start)
    spark, kind = codes.sparkSession, codes.schema[0].dataType

    def repeated(value: object, times: int) -> DataFrame:
        return spark.range(max(times, 0)).select(F.lit(value).cast(kind).alias(key))

    rows, nulls = codes.agg(F.count("*"), F.count_if(F.col(key).isNull())).first()
    stop = rows if stop is None else min(stop, rows)
    if start >= stop:
        return codes.limit(0)
    missing = repeated(None, min(stop, nulls) - start)
    if stop <= nulls:
        return missing
    known = codes.filter(F.col(key).isNotNull())
    first, last = max(start - nulls, 0), stop - nulls
    ranges = _ranges(known)
    low, below_low = _key_at(known, first, ranges)
    high, below_high = _key_at(known, last - 1, ranges)
    if low == high:
        return missing.union(repeated(low, last - first))
    middle = known.filter((F.col(key) > F.lit(low)) & (F.col(key) < F.lit(high)))
    of_low = known.filter(F.col(key) == F.lit(low)).count() - (first - below_low)
    return missing.union(repeated(low, of_low)).union(middle).union(repeated(high, last - below_high))


def lookup(df: DataFrame, code: str, key: str = "symbol") -> DataFrame:
    """The rows of one code."""
    return df.filter(F.col(key) == F.lit(code))
