"""Incremental runs: a stage takes up the slides that a manifest announces for it, each exactly once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.status import read_status, record_status

MANIFEST = "slide_id STRING, stage STRING, announced_at TIMESTAMP"


def announce(slides: DataFrame, stage: str, path: str) -> None:
    """Appends slides that are ready for ``stage`` to a manifest folder, after the output that it needs is there."""
    slides.select("slide_id", F.lit(stage).alias("stage"), F.current_timestamp().alias("announced_at")).write.mode("append").parquet(path)


def follow(spark: SparkSession, manifest: str, checkpoint: str, stage: str, work: Callable[[DataFrame, int], None], status: str, files_per_batch: int = 100) -> None:
    """Runs ``work`` on all slides announced for ``stage`` since the last call, in batches, then stops.

    The checkpoint remembers which manifest files were taken, the table ``status`` which slides the stage has done: a
    slide announced again, however late, is left out. A batch that is run again after a failure gets the
    same slides as before, because a batch does not count its own status rows; ``work`` has to replace its output.
    Announcements without a slide are left out.
    """

    def run(batch: DataFrame, number: int) -> None:
        done = read_status(spark, status).where((F.col("stage") == stage) & (F.col("batch") != number)).select("slide_id")
        slides = batch.where(F.col("stage") == stage).where("slide_id IS NOT NULL").select("slide_id").distinct().join(done, "slide_id", "left_anti")
        if slides.isEmpty():
            return
        work(slides, number)
        record_status(slides, stage, number, status)

    stream = spark.readStream.schema(MANIFEST).option("maxFilesPerTrigger", files_per_batch).parquet(manifest)
    q = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def to_table(path: str, work: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """A stage that writes what ``work`` makes of each batch; a repeated batch replaces its own output."""

    def run(batch: DataFrame, number: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return run
