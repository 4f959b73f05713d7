"""Exact quantiles, the monthly distribution and the histogram."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.functions.numeric import round_half_up
from tripmart.functions.time import month_label, month_start
from tripmart.session import materialize

# a coarse sketch is enough to place cuts and costs half the time of the default accuracy
CUT_ACCURACY = 1_000
SPLITS = 31
VALUES_PER_TASK = 1_000_000


def _rank(p: float, n: Column) -> Column:
    return F.lit(p) * (n - 1)


def _sketch(value: str, probs: list[float]) -> Column:
    return F.percentile_approx(value, probs, CUT_ACCURACY)


def _same_cell(df: DataFrame) -> tuple[DataFrame, Column]:
    """The other side of a join on (grp, cell), and the join condition; grp may be NULL."""
    other = df.withColumnsRenamed({"grp": "o_grp", "cell": "o_cell"})
    return other, F.col("grp").eqNullSafe(F.col("o_grp")) & (F.col("cell") == F.col("o_cell"))


def _ranks_inside() -> Column:
    return F.filter("ranks", lambda r: (r >= F.col("below")) & (r < F.col("below") + F.col("n")))


def _cells(rows: DataFrame, targets: DataFrame, n_splitters: int) -> DataFrame:
    """Count the values of each cell between its splitters and keep the parts that hold a wanted rank.

    rows: grp, cell, value, n.  targets: grp, cell, total, below, ranks, splitters.
    Returns the smaller cells with their own below and ranks, and their least and greatest value.
    """
    cuts, same = _same_cell(targets.select("grp", "cell", "splitters"))
    bucket = reduce(add, [(F.col("value") >= F.col("splitters")[i]).cast("int") for i in range(n_splitters)])
    counts = (
        rows.join(cuts, same)
        .groupBy("grp", "cell", bucket.alias("bucket"))
        .agg(F.sum("n").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    )
    earlier = Window.partitionBy("grp", "cell").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    wanted, same = _same_cell(targets.select("grp", "cell", "total", "below", "ranks"))
    return (
        counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        .join(wanted, same)
        .withColumn("below", F.col("below") + F.col("before"))
        .withColumn("ranks", _ranks_inside())
        .filter(F.size("ranks") > 0)
        .select(
            "grp", F.concat_ws("/", "cell", F.col("bucket").cast("string")).alias("cell"),
            "total", "below", "ranks", "low", "high",
        )
    )


def _inside(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """The distinct values in the cells with their counts: grp, cell, value, n."""
    c = cells.select(F.col("grp").alias("c_grp"), F.col("cell").alias("c_cell"), "low", "high")
    inside = F.col("grp").eqNullSafe(F.col("c_grp")) & F.col("value").between(F.col("low"), F.col("high"))
    return rows.join(c, inside).groupBy("grp", F.col("c_cell").alias("cell"), "value").agg(F.sum("n").alias("n"))


def _at_ranks(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """The values at the wanted ranks, by sorting the distinct values of each cell."""
    earlier = Window.partitionBy("grp", "cell").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    wanted, same = _same_cell(targets.select("grp", "cell", "total", "below", "ranks"))
    return (
        rows.groupBy("grp", "cell", "value")
        .agg(F.sum("n").alias("n"))
        .withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        .join(wanted, same)
        .withColumn("below", F.col("below") + F.col("before"))
        .select("grp", "total", F.explode(_ranks_inside()).alias("rank"), "value")
    )


def _of_groups(rows: DataFrame, groups: DataFrame) -> DataFrame:
    own, same = _same_cell(groups.select("grp", "cell"))
    return rows.join(own, same, "left_semi")


def _cut(rows: DataFrame, groups: DataFrame, probs: list[float], values_per_task: int) -> list[DataFrame]:
    """The values at the wanted ranks of groups that are too large for one task."""
    margin = 4 / CUT_ACCURACY
    cuts = sorted({min(max(p + d, 0.0), 1.0) for p in probs for d in (-margin, margin)})
    head, same = _same_cell(rows.groupBy("grp", "cell").agg(_sketch("value", cuts).alias("splitters")))
    targets = groups.withColumn("size", F.col("total")).join(head, same).drop("o_grp", "o_cell")
    targets, found = materialize(targets, "quantile-cuts"), []
    while (targets.agg(F.max("size")).first()[0] or 0) > values_per_task:
        cells = materialize(_cells(rows, targets, len(cuts)), "quantile-cells")
        one_value = F.col("low") == F.col("high")
        found.append(
            cells.filter(one_value).select("grp", "total", F.explode("ranks").alias("rank"), F.col("low").alias("value"))
        )
        cells = cells.filter(~one_value)
        rows = materialize(_inside(rows, cells), "quantile-values")
        cuts = [(i + 1) / (SPLITS + 1) for i in range(SPLITS)]
        sketches = rows.groupBy("grp", "cell").agg(F.count("*").alias("size"), _sketch("value", cuts).alias("splitters"))
        wanted, same = _same_cell(cells)
        targets = materialize(sketches.join(wanted, same).drop("o_grp", "o_cell"), "quantile-cuts")
    return [*found, _at_ranks(rows, targets)]


def quantiles(
    df: DataFrame, group: str, value: str, probs: list[float], values_per_task: int = VALUES_PER_TASK
) -> DataFrame:
    """Exact interpolated quantiles per group: the group, n and the array ``q``; NULLs are ignored.

    ``percentile`` keeps every distinct value of a group in one task's memory. Here the groups are
    counted first; a group that fits a task is sorted, and one too large for that is cut before: a mergeable sketch proposes where, and the exact counts between
    the cuts tell which part holds a wanted rank, however well or badly the sketch did. What is left
    is a narrow part around each rank, counted per distinct value, and cut again while it is too
    large.
    """
    rows = df.select(F.col(group).alias("grp"), F.col(value).cast("double").alias("value")).filter("value IS NOT NULL")
    rows = rows.withColumn("cell", F.lit("")).withColumn("n", F.lit(1).cast("bigint"))

    ranks = F.array(*[f(_rank(p, F.col("total"))).cast("bigint") for p in probs for f in (F.floor, F.ceil)])
    sizes = materialize(
        rows.groupBy("grp", "cell").agg(F.count("*").alias("total")).select(
            "*", F.lit(0).cast("bigint").alias("below"), F.array_distinct(ranks).alias("ranks")
        ),
        "quantile-sizes",
    )
    is_large = F.col("total") > values_per_task
    n_large, n_groups = sizes.agg(F.count_if(is_large), F.count("*")).first()
    found = []
    if n_large < n_groups or not n_groups:
        found.append(_at_ranks(_of_groups(rows, sizes.filter(~is_large)) if n_large else rows, sizes.filter(~is_large)))
    if n_large:
        large = sizes.filter(is_large)
        found += _cut(rows if n_large == n_groups else _of_groups(rows, large), large, probs, values_per_task)

    values = reduce(DataFrame.unionByName, found)
    at = F.map_from_entries(F.collect_list(F.struct("rank", "value")))  # two ranks per quantile
    by_rank = values.groupBy("grp", "total").agg(at.alias("at"))

    def interpolated(p: float) -> Column:
        position = _rank(p, F.col("total"))
        low, high = F.col("at")[F.floor(position)], F.col("at")[F.ceil(position)]
        return low + (high - low) * (position - F.floor(position))

    return by_rank.select(
        F.col("grp").alias(group), F.col("total").alias("n"), F.array(*[interpolated(p) for p in probs]).alias("q")
    )


def approximate_quantiles(df: DataFrame, group: str, value: str, probs: list[float], accuracy: int = 10_000) -> DataFrame:
    """Quantiles from the sketch alone, in one pass; the rank is off by at most n / accuracy."""
    return df.groupBy(group).agg(
        F.count(value).alias("n"), F.percentile_approx(F.col(value).cast("double"), probs, accuracy).alias("q")
    )


def monthly_distribution(trips: DataFrame, pickup: str, value: str, approximate: bool = False) -> DataFrame:
    """Count, extremes, mean and quartiles of a value per month, rounded."""
    rows = trips.select(month_start(trips, pickup).alias("first_day"), F.col(value).alias("value"))
    quartiles = (approximate_quantiles if approximate else quantiles)(rows, "first_day", "value", [0.25, 0.5, 0.75])
    quartiles = quartiles.select(F.col("first_day").alias("q_day"), "q")
    plain = rows.groupBy("first_day").agg(
        F.count("value").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"), F.avg("value").alias("mean")
    )
    return (
        plain.join(quartiles, F.col("first_day").eqNullSafe(F.col("q_day")), "left")
        .select(
            month_label(F.col("first_day")).alias("month"),
            "n",
            round_half_up(F.col("low")).alias("min_amount"),
            round_half_up(F.col("q")[0]).alias("q1_amount"),
            round_half_up(F.col("q")[1]).alias("median_amount"),
            round_half_up(F.col("q")[2]).alias("q3_amount"),
            round_half_up(F.col("high")).alias("max_amount"),
            round_half_up(F.col("mean")).alias("avg_amount"),
        )
        .orderBy("month")
    )


def monthly_histogram(trips: DataFrame, pickup: str, value: str, width: float) -> DataFrame:
    """Trips per month and fixed-width class of a value, each class named by its lower bound."""
    return (
        trips.filter(F.col(value).isNotNull())
        .groupBy(month_start(trips, pickup).alias("first_day"), F.floor(F.col(value) / width).alias("class"))
        .agg(F.count("*").alias("n_trips"))
        .select(month_label(F.col("first_day")).alias("month"), (F.col("class") * width).alias("class_from"), "n_trips")
        .orderBy("month", "class_from")
    )
