"""A backward as-of join that a hot key cannot collect: each left row gets the latest right row of its key that isn't later.

A window over a key would put a key that holds a third of all rows into one task.  Here the axis of time is cut into slices at
borders taken from a bounded sample, and the window runs over (key, slice).  What a slice begins with, the last right
row of earlier slices, comes from one row a key and slice, so the part that must see a key whole sees at most as many rows as there are slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a slice, slices at most, and rows of the sample a slice.
SLICE_ROWS, MOST_SLICES, SAMPLED = 1 << 20, 512, 64


def borders(rows: DataFrame, on: str, slices: int, total: int) -> list:
    """Values of on that cut rows evenly; the driver sees SAMPLED values a slice, twice that at most."""
    if slices < 2:
        return []
    share = int((1 << 20) * min(1.0, 1.2 * slices * SAMPLED / max(total, 1))) + 1
    some = rows.where(F.col(on).isNotNull() & (F.pmod(F.xxhash64(on, F.monotonically_increasing_id()), F.lit(1 << 20)) < share)).select(on).limit(2 * slices * SAMPLED)
    found = sorted(r[0] for r in some.collect())
    return sorted({found[len(found) * i // slices] for i in range(1, slices)}) if found else []


def slice_of(on: Column, cuts: list, kind: str) -> Column:
    """The number of borders at or before a value, by halving; null is before all."""

    def among(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(on >= F.lit(cuts[mid]).cast(kind), among(mid + 1, high)).otherwise(among(low, mid))

    return among(0, len(cuts))


def asof(left: DataFrame, right: DataFrame, by: list[str], on: str, match: str = "match", slices: int | None = None) -> DataFrame:
    """left with match, the struct of the right columns besides by, of the latest right row of equal by and of on at or before left's.

    Of right rows with equal by and on the greatest by its other columns counts.  A null key or a null on matches nothing; every left
    row stays, once.
    """
    kind = left.schema[on].dataType.simpleString()
    told_columns = [on, *(c for c in right.columns if c not in by and c != on)]
    if slices is None:
        total = left.count()
        slices = min(MOST_SLICES, -(-total // SLICE_ROWS))
    else:
        total = left.count() if slices > 1 else 0
    cut = slice_of(F.col("_on"), borders(left, on, slices, total), kind)
    rows = left.select(*(F.col(c).alias(f"_{i}") for i, c in enumerate(by)), F.col(on).alias("_on"), F.lit(1).alias("_side"), *(F.col(c).alias(f"_l_{c}") for c in left.columns))
    keys = [f"_{i}" for i in range(len(by))]
    told = right.select(*(F.col(c).alias(f"_{i}") for i, c in enumerate(by)), F.col(on).cast(kind).alias("_on"), F.lit(0).alias("_side"), *(F.col(c).alias(f"_r_{c}") for c in told_columns))
    whole = F.col("_on").isNotNull()
    for k in keys:
        whole &= F.col(k).isNotNull()
    # right rows that can match nothing go; a test before the union trips Catalyst's constraints over the packed columns
    both = rows.unionByName(told, allowMissingColumns=True).where((F.col("_side") == 1) | whole).withColumn("_slice", cut)
    value = F.struct(*(F.col(f"_r_{c}").alias(c) for c in told_columns))
    both = both.withColumn("_right", F.when(F.col("_side") == 0, value))
    upto = Window.partitionBy(*keys, "_slice").orderBy("_on", "_side", "_right").rowsBetween(Window.unboundedPreceding, 0)
    near = both.withColumn("_near", F.last("_right", ignorenulls=True).over(upto)).where("_side = 1")
    own = [F.col(f"_l_{c}").alias(c) for c in left.columns]
    if slices < 2:
        return near.select(*own, F.col("_near").alias(match))
    # a row a key and slice: the last right row there, then the last of the slices before
    ends = both.groupBy(*keys, "_slice").agg(F.max(F.when(F.col("_side") == 0, F.col("_right"))).alias("_end"))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("_carried", F.last("_end", ignorenulls=True).over(before)).where("_carried is not null").select(*keys, "_slice", "_carried")
    return near.join(carried, [*keys, "_slice"], "left").select(*own, F.coalesce("_near", "_carried").alias(match))
