"""Order statistics of any number of rows: percentiles, deviations and ranks without one task that holds all values.

Rows become value counts, combined before the shuffle; the counts are sorted by range, which is written, and each partition's counts get the
sum of those before it. A percentile then picks the one or two values that hold its ranks; a rank is a value's place, ties by its count.
Only a table with a row for each partition and group is summed in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .scratch import materialise

#: A value that more than one in FEW of all rows share is broadcast to its rows; there are FEW of them at most.
FEW = 10_000


def ranked_values(df: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """(by, value, copies, below, rows, nulls) of each distinct value: its rows, those below it, those of the group, and the group's nulls.

    Nulls are a value, lowest of all; below counts them.
    """
    by = by or []
    counts = df.groupBy(*by, F.col(value).alias("value")).agg(F.count("*").alias("copies"))
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    placed = counts.repartitionByRange(parts, *by, "value").sortWithinPartitions(*by, "value").withColumn("_at", F.monotonically_increasing_id())
    placed = materialise(placed, "values").withColumn("_part", F.shiftright("_at", 33)).withColumn("_group", F.struct(*by) if by else F.struct(F.lit(0)))
    group = W.partitionBy("_group")
    before = F.coalesce(F.sum("_sum").over(group.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sums = placed.groupBy("_group", "_part").agg(F.sum("copies").alias("_sum"), F.sum(F.when(F.col("value").isNull(), F.col("copies"))).alias("_nulls"))
    sums = sums.select("_group", "_part", before.alias("_skip"), F.sum("_sum").over(group).alias("rows"), F.coalesce(F.sum("_nulls").over(group), F.lit(0)).alias("nulls"))
    inside = F.coalesce(F.sum("copies").over(W.partitionBy("_group", "_part").orderBy("_at").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    own = placed.withColumn("_in", inside).withColumnRenamed("_group", "_g").withColumnRenamed("_part", "_p")
    joined = own.join(sums, F.col("_g").eqNullSafe(F.col("_group")) & (F.col("_p") == F.col("_part")))
    return joined.select(*by, "value", "copies", (F.col("_in") + F.col("_skip")).alias("below"), "rows", "nulls")


def _picked(ranked: DataFrame, names: dict[str, float], by: list[str]) -> DataFrame:
    """(by, names): percentiles from ranked_values, with linear interpolation between neighbouring ranks. Nulls don't count."""
    picks, ends = [], {}
    for i, (name, p) in enumerate(names.items()):
        place = (F.col("rows") - F.col("nulls") - 1) * F.lit(float(p))
        for end, rank in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            at = rank + F.col("nulls")
            held = F.col("value").isNotNull() & (F.col("below") <= at) & (at < F.col("below") + F.col("copies"))
            picks.append(F.max(F.when(held, F.col("value").cast("double"))).alias(f"_{end}{i}"))
            ends.setdefault(end, []).append(held)
        picks.append(F.max(place - F.floor(place)).alias(f"_part{i}"))
    hit = None
    for held in ends["lo"] + ends["hi"]:
        hit = held if hit is None else hit | held
    few = ranked.where(hit).groupBy(*by).agg(*picks)  # two values for each percentile and group at most
    value = lambda i: F.when(F.col(f"_lo{i}") == F.col(f"_hi{i}"), F.col(f"_lo{i}")).otherwise((1 - F.col(f"_part{i}")) * F.col(f"_lo{i}") + F.col(f"_part{i}") * F.col(f"_hi{i}"))
    return few.select(*by, *[value(i).alias(name) for i, name in enumerate(names)])


def percentiles(df: DataFrame, value: str, names: dict[str, float], by: list[str] | None = None) -> DataFrame:
    """(by, names): exact percentiles of value for each group; without `by` one row. Groups that hold nothing but nulls have no row, without `by` a row of nulls."""
    by = by or []
    found = _picked(ranked_values(df, value, by), names, by)
    return found if by else found.agg(*[F.max(n).alias(n) for n in names])


def deviation(df: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """(by, med, mad): median and median absolute deviation; a deviation of 0 becomes 1e-9. One row without `by`.

    The second pass runs over the counts of absolute deviations.
    """
    by = by or []
    med = percentiles(df, value, {"med": 0.5}, by)
    both = df.select(*by, value).join(med, by) if by else df.select(value).crossJoin(F.broadcast(med))  # one row
    mad = percentiles(both.withColumn("_off", F.abs(F.col(value) - F.col("med"))), "_off", {"mad": 0.5}, by)
    found = med.join(mad, by) if by else med.crossJoin(F.broadcast(mad))
    return found.withColumn("mad", F.when(F.coalesce(F.col("mad"), F.lit(0.0)) == 0, F.lit(1e-9)).otherwise(F.col("mad")))


def _with_values(df: DataFrame, value: str, by: list[str], into: Column, name: str) -> DataFrame:
    """df with a column made from its value's row of ranked_values. Values that very many rows share go by broadcast, so that no task gets all of them."""
    ranked = materialise(ranked_values(df, value, by).select(*by, "value", "copies", into.alias(name)), "ranks")
    most = ranked.agg(F.sum("copies")).first()[0] or 0
    names = [*by, "value"]
    told = ranked.select(*[F.col(c).alias(f"_r_{c}") for c in names], "copies", name)
    same = None
    for c in names:
        one = F.col(value if c == "value" else c).eqNullSafe(F.col(f"_r_{c}"))
        same = one if same is None else same & one
    common = df.join(F.broadcast(told.where(F.col("copies") > most // FEW + 1)), same, "left")
    held = common.where("copies is not null").select(*df.columns, name)
    return held.unionByName(common.where("copies is null").select(df.columns).join(told.where(F.col("copies") <= most // FEW + 1), same).select(*df.columns, name))


def with_average_rank(df: DataFrame, value: str, by: list[str], into: str) -> DataFrame:
    """df with the rank from 0 to 1 of value in its group, ties at their average; nulls are left out and get null."""
    known = F.col("rows") - F.col("nulls")
    rank = F.col("below") - F.col("nulls") + (F.col("copies") + 1) / F.lit(2.0)
    return _with_values(df, value, by, F.when(F.col("value").isNotNull(), F.try_divide(rank, known)), into)


def with_percent_rank(df: DataFrame, value: str, by: list[str], into: str) -> DataFrame:
    """df with the share of the group's other rows that lie strictly below, times 100; nulls are lowest and a lone row has 0."""
    return _with_values(df, value, by, F.coalesce(F.try_divide(F.col("below").cast("double"), F.col("rows") - 1), F.lit(0.0)) * 100, into)
