"""The corpus views the checked queries run on, for Spark and for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LABEL_RULE = "CASE WHEN quality = 0 THEN 0 WHEN toxic = 0 THEN 1 ELSE 2 END"

SUFFIXES = [
    "",
    ", I don't like it!!! 2/10",
    " Sooooo good, 8 out of 10 ?!",
    " see www.x.io/a?b or http://y.org",
    " 4.2/10 and 3.5 stars... A+ overall",
    " three-star film, F- acting??",
    " never a good idea, without any real point at all. fine",
    "<br/>it's &amp; <b>bold</b> — ‘q’",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without their texts."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("ID"), F.col("doc_id").alias("row_idx")
    )


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with texts, dealt out by number.

    The given files hold one row group each, which one task reads; text work is dear, so its
    rows are spread before it, over as many partitions as any other shuffle has.
    """
    return _dealt(given_texts(spark, sf_dir), "row_idx")


def given_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with texts where they lie, for work that deals them out itself."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("ID"),
        F.col("doc_id").alias("row_idx"),
        F.col("text").alias("TEXT"),
    )


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dealt(table(spark, sf_dir, "pages").select("page_id", "html"), "page_id")


def _dealt(df: DataFrame, key: str) -> DataFrame:
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("row_idx"), F.expr(LABEL_RULE).alias("LABEL")
    )


def train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir).join(labels(spark, sf_dir), "row_idx")


def train_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).join(labels(spark, sf_dir), "row_idx")


def test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir).join(labels(spark, sf_dir), "row_idx", "left_anti")


def test_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).join(labels(spark, sf_dir), "row_idx", "left_anti")


def sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return test_ids(spark, sf_dir).select("ID", "row_idx", F.lit(0).alias("LABEL"))


def conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir).withColumn("LABEL", (F.col("row_idx") % 3).cast("int"))


def decor(spark: SparkSession, sf_dir: str) -> DataFrame:
    suffix = F.get(F.array(*[F.lit(s) for s in SUFFIXES]), (F.col("row_idx") % 8).cast("int"))
    return texts(spark, sf_dir).withColumn(
        "TEXT",
        F.when(F.col("row_idx") % 97 == 5, F.lit(None))
        .when(F.col("row_idx") % 89 == 7, F.lit("  "))
        .otherwise(F.concat("TEXT", suffix)),
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_SUFFIX_CASE = " ".join(f"WHEN {i} THEN {_quoted(s)}" for i, s in enumerate(SUFFIXES))

SQL_VIEWS = {
    "v_doc": "SELECT CAST(doc_id AS VARCHAR) AS ID, doc_id AS row_idx, text AS TEXT FROM documents",
    "v_train": f"""SELECT CAST(d.doc_id AS VARCHAR) AS ID, d.doc_id AS row_idx, d.text AS TEXT,
        {LABEL_RULE} AS LABEL FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
    "v_test": """SELECT CAST(d.doc_id AS VARCHAR) AS ID, d.doc_id AS row_idx, d.text AS TEXT
        FROM documents d ANTI JOIN labels l ON d.doc_id = l.doc_id""",
    "v_conflict": """SELECT CAST(doc_id AS VARCHAR) AS ID, doc_id AS row_idx, text AS TEXT,
        CAST(doc_id % 3 AS INT) AS LABEL FROM documents""",
    "v_decor": f"""SELECT CAST(doc_id AS VARCHAR) AS ID, doc_id AS row_idx,
        CASE WHEN doc_id % 97 = 5 THEN NULL WHEN doc_id % 89 = 7 THEN '  '
        ELSE concat(text, CASE doc_id % 8 {_SUFFIX_CASE} END) END AS TEXT FROM documents""",
}


def with_views(body: str, *names: str, **more: str) -> str:
    """``body`` after the named views and any further common table expressions."""
    parts = {name: SQL_VIEWS[name] for name in names} | more
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in parts.items()) + "\n" + body
