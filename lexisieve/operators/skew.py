"""Joins and numbering that stay even when one key holds much of the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexisieve.session import materialize

SLICES = 1000


def join_by_weight(
    facts: DataFrame,
    dim: DataFrame,
    keys: list[str],
    weight: str,
    spread: Column,
    how: str = "inner",
    keep: str | None = None,
) -> DataFrame:
    """Join many ``facts`` rows to one ``dim`` row per key, hot keys split.

    ``dim`` lists every key of ``facts``, and ``dim[weight]`` says how many fact rows the
    key has. Keys that hold at least 1/1000 of all rows, and there are at most 1000 of
    those, are copied once per slice of their rows, and their fact rows spread over the
    copies by ``spread``. No task then gets more than about 1/1000 of the rows from one
    key. The list of hot keys is therefore safe to broadcast; for the join itself Spark
    chooses the strategy from the sizes it sees.

    ``keep`` names a boolean column of ``dim``: keys without it do not join (inner joins
    only), and the rows of hot ones are dropped before the shuffle.
    """
    total = dim.agg(F.sum(weight)).scalar()
    copies = F.ceil(F.col(weight) * SLICES / total).cast("int")
    kept = F.col(keep) if keep else F.lit(True)
    hot = dim.filter(F.col(weight) * SLICES >= total).select(
        *keys, copies.alias("_copies"), kept.alias("_kept")
    )
    sliced_dim = dim.filter(kept).withColumn(
        "_slice",
        F.explode(
            F.when(
                F.col(weight) * SLICES >= total, F.sequence(F.lit(0), copies - F.lit(1))
            ).otherwise(F.array(F.lit(0)))
        ),
    )
    sliced_facts = (
        facts.join(F.broadcast(hot), keys, "left")
        .filter(F.coalesce("_kept", F.lit(True)))
        .withColumn(
            "_slice",
            F.coalesce(F.pmod(F.xxhash64(spread), F.col("_copies")).cast("int"), F.lit(0)),
        )
    )
    joined = sliced_facts.join(sliced_dim, [*keys, "_slice"], how)
    return joined.drop("_slice", "_copies", "_kept", *([keep] if keep else []))


def join_listed(facts: DataFrame, dim: DataFrame, keys: list[str], weights: DataFrame, weight: str) -> DataFrame:
    """Inner join of ``facts`` with one ``dim`` row per key, where ``dim`` lists few of their keys.

    ``weights`` is a written table with each key's number of fact rows. Keys that hold at
    least 1/1000 of all rows are hot, and there are at most 1000 of those: their ``dim`` rows
    are broadcast, so hot facts are not shuffled at all. The others meet ``dim`` as it is, so
    a table that is stored bucketed by ``keys`` is not shuffled either.
    """
    total = weights.agg(F.sum(weight)).scalar()
    hot = materialize(weights.filter(F.col(weight) * SLICES >= total).select(*keys))
    hot_dim = dim.join(F.broadcast(hot), keys)
    cold = facts.join(F.broadcast(hot), keys, "left_anti").join(dim, keys)
    return cold.unionByName(facts.join(F.broadcast(hot_dim), keys))


def with_dense_index(df: DataFrame, keys: list[str], out: str, buckets: int = 4096) -> DataFrame:
    """Number unique ``keys`` 0..n-1 without a global sort.

    Rows are numbered inside hash buckets; a running total over the bucket sizes
    (at most ``buckets`` rows) gives each bucket its first number. The result
    depends on the keys only, not on partitions or retries.
    """
    bucketed = df.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy("_bucket")
        .count()
        .select("_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("_bucket").orderBy(*keys)
    return (
        bucketed.withColumn("_rank", F.row_number().over(inside) - 1)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(out, F.col("_offset") + F.col("_rank"))
        .drop("_bucket", "_rank", "_offset")
    )
