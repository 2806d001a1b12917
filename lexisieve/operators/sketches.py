"""Mergeable summaries with a stated error, where exact ones cost a shuffle of the values.

A sketch is one binary value for each group, built while rows are read and merged by
aggregation, so partial tables can be kept and added to. The exact counterparts are
`lexisieve.operators.quantiles` and plain distinct counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUANTILE_SIZE, DISTINCT_BITS = 1000, 14


def rank_error(size: int = QUANTILE_SIZE) -> float:
    """How far, as a share of all values, the rank of a sketched quantile may be off (99 percent)."""
    return 2.296 / size**0.9723


def distinct_error(bits: int = DISTINCT_BITS) -> float:
    """Three standard errors of a distinct count, as a share of it."""
    return 3 * 1.04 / 2 ** (bits / 2)


def _finite(value: Column) -> Column:
    value = value.cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def quantile_sketches(df: DataFrame, groups: list[str], value_col: str, size: int = QUANTILE_SIZE) -> DataFrame:
    """``(groups, sketch)``; null, NaN and infinite values are ignored."""
    return df.groupBy(*groups).agg(F.kll_sketch_agg_double(_finite(F.col(value_col)), F.lit(size)).alias("sketch"))


def merge_quantiles(sketches: DataFrame, groups: list[str]) -> DataFrame:
    """Sketches of parts as those of ``groups``."""
    return sketches.groupBy(*groups).agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def sketched_quantiles(sketches: DataFrame, shares: dict[str, float]) -> DataFrame:
    """The sketch column replaced by ``count`` and a quantile for each name; nulls for no values."""
    n = F.kll_sketch_get_n_double("sketch")
    quantiles = [
        F.when(n > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(float(share)))).alias(name)
        for name, share in shares.items()
    ]
    return sketches.select(*[c for c in sketches.columns if c != "sketch"], n.alias("count"), *quantiles)


def distinct_sketches(df: DataFrame, groups: list[str], value_col: str, bits: int = DISTINCT_BITS) -> DataFrame:
    """``(groups, sketch)`` of the distinct values, null not counted."""
    return df.groupBy(*groups).agg(F.hll_sketch_agg(F.col(value_col).cast("string"), F.lit(bits)).alias("sketch"))


def merge_distinct(sketches: DataFrame, groups: list[str]) -> DataFrame:
    return sketches.groupBy(*groups).agg(F.hll_union_agg("sketch").alias("sketch"))


def sketched_distinct(sketches: DataFrame) -> DataFrame:
    """The sketch column replaced by ``distinct_values``, about as many as there are."""
    return sketches.select(
        *[c for c in sketches.columns if c != "sketch"], F.hll_sketch_estimate("sketch").alias("distinct_values")
    )
