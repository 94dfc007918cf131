"""Session helpers: the shared folder, written stages, and broadcasts that are checked before they are made."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only if it has been counted and is no larger than this.
BROADCAST_MAX_ROWS = 200_000
#: Whether Spark deletes the shuffle files of a query as it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Paths of the tables that stage() has written and nobody has deleted.
_STAGED: list[str] = []


def local_session(cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """The session used by tests and the bench."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("voxlattice")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or in local mode a temporary one set here."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    made = tempfile.mkdtemp(prefix="voxlattice-")
    spark.conf.set("spark.checkpoint.dir", f"file://{made}")
    return f"file://{made}"


def stage(df: DataFrame, tidy: bool = False) -> DataFrame:
    """Write df as a table in the shared folder and read it again: lineage is cut and survives lost executors.

    With tidy, what was shuffled for it is deleted as soon as it is written, not when the driver next collects its garbage.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stage-{uuid.uuid4().hex}"
    was = spark.conf.get(_CLEANUP, "false")
    try:
        spark.conf.set(_CLEANUP, "true" if tidy else was)
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, was)
    read = spark.read.schema(df.schema).parquet(path)
    read._voxlattice_path = path
    _STAGED.append(path)
    return read


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    if path in _STAGED:
        _STAGED.remove(path)


def drop_stage(df: DataFrame) -> None:
    """Delete the table behind a DataFrame made by stage(); nothing may read it afterwards."""
    path = getattr(df, "_voxlattice_path", None)
    if path is not None:
        _delete(df.sparkSession, path)


def release(spark: SparkSession) -> None:
    """Delete all tables that stage() has written, once the results that read them have been written themselves."""
    for path in list(_STAGED):
        _delete(spark, path)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """df with a broadcast hint if a count shows at most max_rows rows, else df unchanged (a shuffle join follows)."""
    small = df.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(df) if small else df


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names for internal use that df doesn't have, in the order of the names asked for."""
    have = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in have:
            name = f"_{name}"
        have.add(name.lower())
        out.append(name)
    return out
