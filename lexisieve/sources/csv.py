"""CSV tables with quoted multi-line text, landed once with their source order."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.window import Window

from lexisieve.operators.contracts import ContractError
from lexisieve.operators.skew import join_by_weight
from lexisieve.plans.workflow import checked_inputs
from lexisieve.session import materialize

# --- fixed values: cell texts that mean a missing value --------------------------

NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

RAW_RECORD = "_raw_record"
INPUT_FILES = {"train": "train.csv", "test": "test.csv", "sample_submission": "sample_submission.csv"}


def read_csv(
    spark: SparkSession, path: str, null_tokens: list[str] = NULL_TOKENS, order_col: str = "row_idx"
) -> DataFrame:
    """String columns as the header names them, plus ``order_col`` = 0, 1, 2, ...

    Quoted line breaks make a CSV file unsplittable, so it is read once and kept
    as parquet. Several files count in the order of their paths: a file's rows
    are consecutive, so one number per file turns positions into source order.

    All files must have the same header, and a row with more cells than the header is an
    error; a row with fewer ends in nulls.
    """
    reader = (
        spark.read.option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
    )
    try:
        names = reader.csv(path).columns
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from error
        raise
    schema = StructType([StructField(name, StringType()) for name in [*names, RAW_RECORD]])
    raw = (
        reader.option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", RAW_RECORD)
        .schema(schema)
        .csv(path)
    )

    def cell(name: str) -> Column:
        value = F.col(f"`{name}`")
        return F.when(~value.isin(null_tokens), value).alias(name)

    # the reader keeps the text of rows with too few or too many cells
    unquoted = F.regexp_replace(RAW_RECORD, '"(?:[^"]|"")*+"', "")
    commas = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(","), F.lit("")))
    try:
        landed = materialize(
            raw.select(
                *[cell(name) for name in names],
                F.coalesce(commas >= len(names), F.lit(False)).alias("_surplus"),
                F.col("_metadata.file_path").alias("_file"),
                F.monotonically_increasing_id().alias("_position"),
            )
        )
    except Exception as error:
        if "CSV header does not conform" in str(error) or "CSV header" in str(error):
            raise ContractError(f"files below {path} have different headers") from error
        raise
    surplus = landed.filter("_surplus").count()
    if surplus:
        raise ContractError(f"{surplus} rows of {path} have more cells than the header")
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = (
        landed.groupBy("_file")
        .agg(F.count("*").alias("_rows"), F.min("_position").alias("_first"))
        .withColumn("_shift", F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first"))
    )
    numbered = join_by_weight(landed, files, ["_file"], "_rows", F.col("_position"))
    return numbered.select(
        *[F.col(f"`{name}`") for name in names],
        (F.col("_position") + F.col("_shift")).alias(order_col),
    )


def read_inputs(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train, test and template below ``root``, with their contracts checked."""
    tables = [read_csv(spark, f"{root}/{name}") for name in INPUT_FILES.values()]
    return checked_inputs(*tables)
