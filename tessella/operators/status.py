"""Stage status: done markers, resuming, tallies, union of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

STATUS = "slide_id STRING, result STRING, finished_at TIMESTAMP, stage STRING, batch LONG"


def pending(work: DataFrame, done: DataFrame, on: str) -> DataFrame:
    """Work whose key has no done marker."""
    return work.join(done.select(on).distinct(), on, "left_anti")


def tally(work: DataFrame, done: DataFrame, on: str) -> DataFrame:
    """One row: keys of the work, those done and those pending."""
    keys = work.select(on).distinct().join(done.select(on).distinct().withColumn("__d", F.lit(1)), on, "left")
    hit = F.coalesce(F.sum("__d"), F.lit(0))
    return keys.agg(F.count(F.lit(1)).alias("total"), hit.alias("done"), (F.count(F.lit(1)) - hit).alias("pending"))


def parse_status(text: F.Column) -> F.Column:
    """``OK:detail`` as a struct ``status, detail``."""
    return F.struct(F.regexp_extract(text, r"^([A-Z]+)", 1).alias("status"), F.regexp_extract(text, r"^[A-Z]+:(.*)$", 1).alias("detail"))


def record_status(slides: DataFrame, stage: str, batch: int, path: str, result: str | F.Column = "OK") -> None:
    """Writes a done marker for each slide to the table ``path``; the markers of a repeated batch replace its earlier ones."""
    text = F.lit(result) if isinstance(result, str) else result
    rows = slides.select("slide_id", text.alias("result"), F.current_timestamp().alias("finished_at"))
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/stage={stage}/batch={batch}")


def read_status(spark: SparkSession, path: str) -> DataFrame:
    """The done markers of all stages; none if there is no table yet."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], STATUS)
    return spark.read.schema(STATUS).parquet(path)


def result_summary(markers: DataFrame) -> DataFrame:
    """``(stage, status, slides)``: how many slides ended in which way; the status is what stands before a colon."""
    return markers.groupBy("stage", parse_status(F.col("result"))["status"].alias("status")).agg(F.count_distinct("slide_id").alias("slides"))


def over_budget(markers: DataFrame, most_errors: int = 5) -> DataFrame:
    """``(stage, errors)`` of stages with more failed slides than a run may have."""
    failed = markers.where(parse_status(F.col("result"))["status"] == "ERROR")
    return failed.groupBy("stage").agg(F.count_distinct("slide_id").alias("errors")).where(F.col("errors") > most_errors)


def matched_share(wanted: DataFrame, found: DataFrame, on: str) -> DataFrame:
    """One row: distinct keys wanted and how many of them are found."""
    keys = wanted.select(on).distinct().join(found.select(on).distinct().withColumn("__f", F.lit(1)), on, "left")
    return keys.agg(F.count(F.lit(1)).alias("wanted"), F.coalesce(F.sum("__f"), F.lit(0)).alias("matched"))


def unique_names(files: DataFrame, name: str, path: str) -> DataFrame:
    """Adds ``unique_name``: repeats of a name get ``_1``, ``_2``, ... before the suffix, in order of path."""
    n = F.row_number().over(W.partitionBy(name).orderBy(path)) - 1
    stem, suffix = F.regexp_extract(name, r"^(.*?)(\.[^.]*)?$", 1), F.regexp_extract(name, r"^.*?(\.[^.]*)?$", 1)
    return files.withColumn("__n", n).withColumn("unique_name", F.when(F.col("__n") == 0, F.col(name)).otherwise(F.concat(stem, F.lit("_"), F.col("__n"), suffix))).drop("__n")


def union_runs(runs: dict[str, DataFrame]) -> DataFrame:
    """All rows of several runs with their ``run_id``; columns that a run lacks are null."""
    out = None
    for run, df in runs.items():
        df = df.withColumn("run_id", F.lit(run))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out
