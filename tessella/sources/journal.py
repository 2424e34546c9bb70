"""The on-disk side of compaction: an idempotent transaction journal over real files."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.compaction import FAN_IN, TARGET, compact, file_catalogue, file_node, file_nodes, lineage, plan
from ..session import cut, discard, remove

CONTAINER = "container STRING, bucket INT, bytes LONG, rows LONG, run STRING"


@dataclass(frozen=True)
class CompactedStore:
    """A folder ``root`` with a journal and the compacted boxes.

    ``journal/<run>`` lists the inputs and outputs of a run's transactions, ``placed/<run>`` its new files, ``data/<run>`` its
    containers (a few plain files, however many containers), ``containers/<run>`` one row for each of them. A run takes in new files and
    those containers of earlier runs that are below the target and find enough others of their size; ``commits/<number>`` makes it
    count. A run's name is a hash of what it takes in: a run that died before its commit is planned and written again to the same names. Two
    runs at a time cannot both commit: the second finds the number taken and fails, and can be called again.
    """

    spark: SparkSession
    root: str

    def _path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def _fs(self, path: str):
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop

    def _names(self, folder: str) -> list[str]:
        fs, path = self._fs(self._path(folder))
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def runs(self) -> list[str]:
        """Names of the committed runs, oldest first (the commit's file name is ``number-run``)."""
        return [n.split("-", 1)[1] for n in self._names("commits") if "-" in n]

    def _read(self, folder: str) -> DataFrame | None:
        runs = self.runs()
        return self.spark.read.parquet(*[self._path(folder, r) for r in runs]) if runs else None

    def journal(self) -> DataFrame | None:
        return self._read("journal")

    def containers(self) -> DataFrame:
        """Containers that no later transaction took in, with the run that wrote them."""
        made = self._read("containers")
        if made is None:
            return self.spark.createDataFrame([], CONTAINER)
        return made.join(self.journal().select(F.col("input").alias("container")).distinct(), "container", "left_anti")

    def ingest(self, boxes: DataFrame, buckets: int = 1, base: int = 1 << 10, fan_in: int = FAN_IN, target: int = TARGET, least: int | None = None) -> dict:
        """Takes in the files that no committed run holds. ``buckets`` must stay the same for one store; ``least`` as in ``plan``."""
        commits = self._names("commits")
        seen = self._read("placed")
        files = file_catalogue(boxes, buckets)
        files = cut(files if seen is None else files.join(seen.select("file_id"), "file_id", "left_anti"))
        n, mix = files.agg(F.count(F.lit(1)), F.sum(F.xxhash64("file_id") % F.lit(1 << 40))).first()
        if not n:
            return {"run": None, "files": 0}
        run = f"{len(commits):08d}_{n:x}_{mix & ((1 << 64) - 1):x}"
        earlier = self.containers().where(F.col("bytes") < target)
        nodes = file_nodes(files).unionByName(earlier.select(F.col("container").alias("node"), "bucket", "bytes", "rows"))
        journal, placement = plan(nodes, base, fan_in, target, fan_in if least is None else least)
        journal.write.mode("overwrite").parquet(self._path("journal", run))
        placement = cut(placement)
        placed = files.select("file_id", "tile", file_node(F.col("file_id")).alias("node")).join(placement, "node").drop("node")
        placed.write.mode("overwrite").parquet(self._path("placed", run))
        fresh = compact(lineage(boxes, placed))
        moved = earlier.select(F.col("container").alias("node"), "run").join(placement, "node").where("node <> container")
        parts = [fresh]
        runs = [r.run for r in moved.select("run").distinct().collect()]  # at most one row a run
        if runs:
            old = self.spark.read.parquet(*[self._path("data", r) for r in runs]).withColumnRenamed("container", "node")
            parts.append(old.join(moved.select("node", "container"), "node").select("tile", "label_id", "bbox", "container", "n_files"))
        both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        out = both.groupBy("tile", "label_id", "bbox", "container").agg(F.sum("n_files").alias("n_files"))
        out.repartition("container").sortWithinPartitions("container", "tile").write.mode("overwrite").parquet(self._path("data", run))
        made = nodes.join(placement, "node").join(earlier.select(F.col("container").alias("node"), F.lit(True).alias("was")), "node", "left")
        made = made.where("was IS NULL OR node <> container").groupBy("container", "bucket").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
        made.withColumn("run", F.lit(run)).write.mode("overwrite").parquet(self._path("containers", run))
        self._commit(len(commits), run, n)
        discard(files, placement)
        return {"run": run, "files": n}

    def _commit(self, number: int, run: str, files: int) -> None:
        fs, lock = self._fs(self._path("numbers", f"{number:08d}"))
        if fs.exists(lock) and run not in self._holder(lock):
            raise RuntimeError("another run committed meanwhile; call ingest again")
        stream = fs.create(lock, True)
        stream.write(bytearray(run.encode()))
        stream.close()
        fs, marker = self._fs(self._path("commits", f"{number:08d}-{run}"))
        stream = fs.create(marker, True)
        stream.write(bytearray(json.dumps({"run": run, "files": files}).encode()))
        stream.close()

    def _holder(self, lock) -> str:  # noqa: ANN001
        return "\n".join(r.value for r in self.spark.read.text(lock.toString()).collect())

    def boxes(self) -> DataFrame:
        """All boxes of the containers that count; a box that several of them hold stands once (a file belongs to one run only)."""
        data = self._read("data").join(self.containers().select("container"), "container", "left_semi")
        return data.groupBy("tile", "label_id", "bbox").agg(F.min("container").alias("container"), F.sum("n_files").alias("n_files"))

    def vacuum(self) -> list[str]:
        """Deletes the data of runs whose containers were all taken in by later ones, and of runs that never committed; returns their names."""
        alive = {r.run for r in self.containers().select("run").distinct().collect()}
        gone = [r for r in self._names("data") if r not in alive]
        keep = set(self.runs())
        for r in gone:
            remove(self.spark, self._path("data", r))
            if r in keep:  # an empty table in its place, so that reading all runs goes on
                self.spark.createDataFrame([], "tile STRING, label_id INT, bbox ARRAY<INT>, container STRING, n_files LONG").write.parquet(self._path("data", r))
        return gone
