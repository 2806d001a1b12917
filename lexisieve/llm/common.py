"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it.

    A lambda variable keeps the optimizer from copying ``value`` into nested lambdas.
    """
    return F.transform(F.array(value), body)[0]


def free_memory() -> None:
    """Give back what Arrow keeps of freed batches; a worker that waits for other work then holds little."""
    pa.default_memory_pool().release_unused()


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def split_words(text: Column, separators: str = SPACES) -> Column:
    """Words between runs of ``separators``; null and empty text have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")
