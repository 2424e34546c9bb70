"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and benches; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(master)
        .appName("tessella")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor can reach, from ``spark.checkpoint.dir``.

    Where the setting is absent and the master is local (tests on one machine), a temporary folder is set, which is
    deleted when Python ends. On a cluster the setting is required: a folder of one machine would lose data with it.
    """
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    current = context._jsc.sc().getCheckpointDir()
    if found or current.isDefined():
        return found or current.get()
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    found = tempfile.mkdtemp(prefix="tessella-")
    atexit.register(shutil.rmtree, found, ignore_errors=True)
    context.setCheckpointDir(found)
    return found


def scratch(spark: SparkSession, kind: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


@contextmanager
def _own_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that runs here are dropped when it ends, because nothing runs its plan again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def cut(df: DataFrame, by: str | None = None, packed: bool = False) -> DataFrame:
    """Materialise ``df`` as a table in the shared folder and cut its lineage.

    The table survives the loss of any executor. ``discard`` deletes it once it is no longer needed, ``discard_part`` what it holds
    for one value of the column ``by``. Columns that are ``packed`` already are not compressed again.
    """
    spark = df.sparkSession
    path = scratch(spark, "cut")
    with _own_shuffles(spark):
        df.write.options(**{"compression": "none", "parquet.enable.dictionary": "false"} if packed else {"compression": "zstd"}).partitionBy(*[by] if by else []).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tessella_path = path
    return out


def discard(*frames: DataFrame | None) -> None:
    """Deletes the tables behind frames that ``cut`` returned; other frames are left alone."""
    for df in frames:
        path = getattr(df, "_tessella_path", None)
        if path:
            remove(df.sparkSession, path)


def discard_part(df: DataFrame, by: str, value: int) -> None:
    remove(df.sparkSession, f"{df._tessella_path}/{by}={value}")


def remove(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
