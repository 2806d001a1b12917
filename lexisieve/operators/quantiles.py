"""Exact statistics of grouped numbers, from a histogram of distinct values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexisieve.session import materialize


def numeric_summary(df: DataFrame, groups: list[str], value_col: str) -> DataFrame:
    """Count, mean, min, median, 90th percentile and max per group.

    Null, NaN and infinite values are ignored; a group without any other value
    has count 0 and nulls. Quantiles interpolate linearly between the two
    neighbouring ranks.

    Values are counted before the shuffle. The histogram is written once, range-partitioned
    by group and value, whatever the values' distribution: a partition holds a bounded run of
    distinct values. Ranks are located by the partitions' totals, and only the runs that hold
    a wanted rank are sorted, so no task ever holds a whole group.
    """
    clean = F.when(~F.isnan(value_col) & (F.abs(value_col) != float("inf")), F.col(value_col))
    counted = df.groupBy(*groups, clean.alias("_value")).agg(F.count("*").alias("_n"))
    histogram = materialize(
        counted.repartitionByRange(*groups, "_value").withColumn("_bucket", F.spark_partition_id())
    )
    value, n = F.col("_value"), F.when(F.col("_value").isNotNull(), F.col("_n"))
    totals = histogram.groupBy(*groups).agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("count"),
        (F.sum(value * n) / F.sum(n)).alias("mean"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    bucketed = histogram.withColumn("_n", F.coalesce(n, F.lit(0)))
    upto = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    ranks = F.array(
        *[
            F.struct(F.lit(name).alias("name"), (F.lit(q) * (F.col("count") - 1)).alias("at"))
            for name, q in [("median", 0.5), ("p90", 0.9)]
        ]
    )
    wanted = (
        bucketed.groupBy(*groups, "_bucket")
        .agg(F.sum("_n").alias("_rows"))
        .withColumn("count", F.sum("_rows").over(Window.partitionBy(*groups)))
        .withColumn("_end", F.sum("_rows").over(upto))
        .withColumn("_start", F.col("_end") - F.col("_rows"))
        .withColumn("rank", F.explode(ranks))
        .filter((F.ceil("rank.at") >= F.col("_start")) & (F.floor("rank.at") < F.col("_end")))
        .select(*groups, "_bucket", "_start", "rank")
    )
    same_bucket = [F.col(f"b.{g}").eqNullSafe(F.col(f"w.{g}")) for g in groups]
    inside = Window.partitionBy(*groups, "name", "_bucket").orderBy("_value").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    found = (
        bucketed.alias("b")
        .join(wanted.alias("w"), [*same_bucket, F.col("b._bucket") == F.col("w._bucket")])
        .select(
            *[F.col(f"b.{g}").alias(g) for g in groups],
            F.col("b._bucket").alias("_bucket"),
            "_value",
            "_n",
            "_start",
            F.col("rank.name").alias("name"),
            F.col("rank.at").alias("at"),
        )
        .withColumn("_end", F.col("_start") + F.sum("_n").over(inside))
        .withColumn("_begin", F.col("_end") - F.col("_n"))
    )

    def at_rank(name: str, edge):
        here = (edge("at") >= F.col("_begin")) & (edge("at") < F.col("_end"))
        return F.max(F.when((F.col("name") == name) & here, F.col("_value")))

    def interpolated(name: str):
        low, high = at_rank(name, F.floor), at_rank(name, F.ceil)
        part = F.max(F.when(F.col("name") == name, F.col("at") - F.floor("at")))
        return (low + (high - low) * part).alias(name)

    quantiles = found.groupBy(*groups).agg(interpolated("median"), interpolated("p90"))
    matching = [F.col(f"t.{g}").eqNullSafe(F.col(f"q.{g}")) for g in groups]
    return (
        totals.alias("t")
        .join(quantiles.alias("q"), matching, "left")
        .select(
            *[F.col(f"t.{g}").alias(g) for g in groups],
            "count", "mean", "min", "median", "p90", "max",
        )
    )
