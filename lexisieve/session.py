"""Session defaults and lineage cuts."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def local_session(cores: str = "8", memory: str = "12g") -> SparkSession:
    """Session for tests and benchmarks; on a cluster bring your own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("lexisieve")
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.files.minPartitionNum", cores if cores.isdigit() else "8")
        .config("spark.driver.memory", memory)
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="lexisieve-"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_LOCAL_DIRS: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``.

    Only where nobody set it and everything runs in one local process does the
    session get a folder of its own; a cluster without it is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_DIRS:
        _LOCAL_DIRS[application] = tempfile.mkdtemp(prefix="lexisieve-")
    return _LOCAL_DIRS[application]


def materialize(df: DataFrame, schema: StructType | None = None) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back.

    Cuts lineage, survives lost executors and keeps column pruning for readers.
    ``schema`` may give the stored columns richer types on the way back.
    """
    path = f"{work_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema or df.schema).parquet(path)


def _bucket_name(path: str) -> str:
    return "lexisieve_" + hashlib.sha256(path.encode()).hexdigest()[:32]


def store_bucketed(
    df: DataFrame, keys: list[str], path: str | None = None, then: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Write ``df`` once, hashed and sorted by ``keys``, so joins on them do not shuffle it again.

    ``then`` is what is made of each row, ``keys`` kept, after it came to its bucket.

    The files lie in ``path`` (default: a new one in the shared folder); the session's catalog
    knows them as an external table.
    """
    spark = df.sparkSession
    path = path or f"{work_dir(spark)}/{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = _bucket_name(f"{path}-{uuid.uuid4().hex}")
    # one task for each bucket, so there is one file for each
    dealt = df.repartition(buckets, *keys)
    (
        (then(dealt) if then else dealt)
        .write.bucketBy(buckets, *keys)
        .sortBy(*keys)
        .option("path", path)
        .mode("overwrite")
        .saveAsTable(name)
    )
    return spark.table(name)


def attach_bucketed(spark: SparkSession, path: str, keys: list[str], buckets: int) -> DataFrame:
    """A table that `store_bucketed` wrote into ``buckets`` buckets, perhaps in another session."""
    name = _bucket_name(path)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    by = ", ".join(f"`{key}`" for key in keys)
    quoted = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by})"
        f" INTO {buckets} BUCKETS LOCATION '{quoted}'"
    )
    return spark.table(name)
