"""Running numbers and exact percentiles over any order, without one task that holds a group.

Rows are dealt to ranges of (group, order); counts of the ranges, added up from the first, tell
each range where its rows begin. Only the counts (one row for each group and range) are summed in
order, so that a group of any size is spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestack.sources.tables import stored


def ranged(rows: DataFrame, groups: list[str], order: list[str], parts: int | None = None) -> DataFrame:
    """`rows` with _part, the number of the range of (groups, order) that holds them; written, so that the ranges stay as they are."""
    n = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stored(rows.repartitionByRange(n, *groups, *order).withColumn("_part", F.spark_partition_id()))


def offsets(dealt: DataFrame, groups: list[str], amount: Column) -> DataFrame:
    """(groups, _part, _before, _here): the sum of `amount` in each range and in those of the group before it."""
    here = dealt.groupBy(*groups, "_part").agg(F.sum(amount).alias("_here"))
    before = F.sum("_here").over(Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    return here.withColumn("_before", F.coalesce(before, F.lit(0)))


def running_number(rows: DataFrame, groups: list[str], order: list[str], out: str = "number", parts: int | None = None) -> DataFrame:
    """`rows` with a number from 1 within their group in the given order; `order` must tell rows apart."""
    dealt = ranged(rows, groups, order, parts)
    within = F.row_number().over(Window.partitionBy(*groups, "_part").orderBy(*order))
    return dealt.withColumn(out, within).join(offsets(dealt, groups, F.lit(1)), [*groups, "_part"]).withColumn(out, (F.col(out) + F.col("_before")).cast("long")).drop("_part", "_before", "_here")


def percentiles(rows: DataFrame, groups: list[str], value: str, wanted: dict[str, tuple[float, bool]], parts: int | None = None) -> DataFrame:
    """(groups, one column for each wanted name): exact percentiles of the values that are not null.

    wanted: name to (share, linear). A nearest-rank percentile is the smallest value with at least
    the share of rows up to it; a linear one lies between its two neighbours. Equal values are counted
    before anything is sorted; then only the ranges that hold a wanted rank are looked into.
    Rows with a null value or group key are left out.
    """
    keys = [f"_g{i}" for i in range(len(groups))]
    named = rows.select(*[F.col(g).alias(k) for g, k in zip(groups, keys, strict=True)], F.col(value).alias("_v")).na.drop()
    dealt = ranged(named.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n")), keys, ["_v"], parts)
    ranges = stored(offsets(dealt, keys, F.col("_n")))
    total = ranges.groupBy(*keys).agg(F.sum("_here").alias("_total"))
    asked = []
    for name, (share, linear) in wanted.items():
        place = F.lit(float(share)) * (F.col("_total") - 1)
        low, high = (F.floor(place) + 1, F.ceil(place) + 1) if linear else (F.greatest(F.ceil(F.lit(float(share)) * F.col("_total")), F.lit(1)),) * 2
        weight = place - F.floor(place) if linear else F.lit(0.0)
        asked += [F.struct(F.lit(name).alias("name"), low.cast("long").alias("rank"), (1 - weight).alias("share")), F.struct(F.lit(name).alias("name"), high.cast("long").alias("rank"), weight.alias("share"))]
    ranks = total.select(*keys, F.explode(F.array(*asked)).alias("a")).select(*keys, "a.*")
    inside = ranges.join(ranks, keys).where("_before < rank AND rank <= _before + _here").select(*keys, "_part", "_before", "name", "rank", "share")
    upto = F.sum("_n").over(Window.partitionBy(*keys, "_part").orderBy("_v"))
    looked = dealt.join(inside.select(*keys, "_part").distinct(), [*keys, "_part"], "left_semi").withColumn("_upto", upto)
    hit = looked.join(inside, [*keys, "_part"]).where("_before + _upto - _n < rank AND rank <= _before + _upto")
    found = hit.groupBy(*keys, "name").agg(F.sum(F.when(F.col("share") > 0, F.col("_v") * F.col("share")).otherwise(0.0)).alias("_p"))
    out = found.groupBy(*keys).agg(*[F.max(F.when(F.col("name") == n, F.col("_p"))).alias(n) for n in wanted])
    return out.select(*[F.col(k).alias(g) for g, k in zip(groups, keys, strict=True)], *wanted)
