"""Pulls of unconsumed logs that read open log files and open runs only.

Log files do not change once they are written; new logs come in new files, also late ones with old time stamps. A file
whose logs are all in the ledger is closed, a run whose logs all lie in closed files is settled. A pull lists the log
folder, reads the files that are not marked as closed, and anti-joins them with the ledger folders of unsettled runs:
its work follows what waits, not what was ever consumed. A file that was replaced (another length or time of change) is
open again, and with it every run is read. Log ids identify logs: one that was consumed from a closed file and comes again in a new file
is found only with ``all_runs=True``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promptmill import schemas
from promptmill.operators.ranks import first_rows
from promptmill.session import materialise
from promptmill.sources.segments import SegmentTable
from promptmill.sources.state import read_or_empty

_MARKS = "kind STRING, name STRING, length BIGINT, changed BIGINT"


class LogPulls:
    """Logs in a folder of parquet files, a ledger partitioned by run, and the marks of what is done."""

    def __init__(self, spark: SparkSession, logs: str, ledger: str, marks: str | None = None):
        self.spark, self.logs, self.ledger = spark, logs, ledger
        self.marks = SegmentTable(spark, marks or f"{ledger}_marks", _MARKS)

    def _listed(self) -> dict[str, tuple[int, int]]:
        """Path, length and time of change of every log file: the listing that any read begins with."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        where = hadoop.Path(self.logs)
        files = where.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = {}
        if files.exists(where):
            each = files.listFiles(where, True)
            while each.hasNext():
                status = each.next()
                path = status.getPath()
                if path.getName().endswith(".parquet") and not path.getName().startswith(("_", ".")):
                    found[path.toString()] = (status.getLen(), status.getModificationTime())
        return found

    def _marked(self) -> tuple[dict[str, tuple[int, int]], set[str]]:
        """Closed files and settled runs, one short row each."""
        base = self.marks.read_base()
        rows = self.marks.tail() if base is None else base.unionByName(self.marks.tail())
        files, runs = {}, set()
        for r in rows.distinct().collect():
            if r["kind"] == "file":
                files[r["name"]] = (r["length"], r["changed"])
            else:
                runs.add(r["name"])
        return files, runs

    def open_files(self) -> list[str]:
        closed, _ = self._marked()
        return sorted(path for path, state in self._listed().items() if closed.get(path) != state)

    def open_logs(self) -> DataFrame:
        """The logs of open files, with the ``file`` each comes from."""
        paths = self.open_files()
        if not paths:
            return self.spark.createDataFrame([], schemas.INFERENCE_LOGS + ", file STRING")
        rows = self.spark.read.schema(schemas.INFERENCE_LOGS).parquet(*paths)
        return rows.select("*", F.col("_metadata.file_path").alias("file"))

    def open_ledger(self, all_runs: bool = False) -> DataFrame:
        """Ledger rows of the runs that are not settled: a filter on the partition column."""
        rows = read_or_empty(self.spark, self.ledger, schemas.LEDGER)
        closed, settled = self._marked()
        listed = self._listed()
        replaced = any(listed[path] != state for path, state in closed.items() if path in listed)
        return rows if all_runs or replaced or not settled else rows.filter(~F.col("run_id").isin(*sorted(settled)))

    def unconsumed(self, limit: int | None = None, all_runs: bool = False) -> DataFrame:
        """Logs no run has consumed; ``limit`` takes the oldest by (timestamp, log_id)."""
        fresh = self.open_logs().drop("file").join(self.open_ledger(all_runs).select("log_id"), "log_id", "left_anti")
        return fresh if limit is None else first_rows(fresh, ["timestamp", "log_id"], limit)

    def count_unconsumed(self) -> DataFrame:
        return self.unconsumed().agg(F.count("*").alias("new_logs"))

    def settle(self) -> None:
        """Mark the files and runs that are done; call it after a run has stored its ledger rows.

        Marks follow from the stored ledger, so a settling that is lost is made up by the next one.
        """
        listed = self._listed()
        logs = self.open_logs().select("log_id", "file")
        ledger = self.open_ledger().select("log_id", "run_id")
        waiting = materialise(logs.join(ledger, "log_id", "left_anti").select("file").distinct())
        still = {r["file"] for r in waiting.collect()}  # open files, which were listed above
        paths = {self._plain(path): path for path in self.open_files()}
        left = {paths[self._plain(f)] for f in still}
        closed = [("file", path, *listed[path]) for path in paths.values() if path in listed and path not in left]
        in_open = logs.join(waiting, "file", "left_semi").select("log_id")
        busy = {r["run_id"] for r in ledger.join(in_open, "log_id", "left_semi").select("run_id").distinct().collect()}
        runs = {r["run_id"] for r in ledger.select("run_id").distinct().collect()}
        marks = closed + [("run", run, 0, 0) for run in sorted(runs - busy)]
        if marks:
            self.marks.append(self.spark.createDataFrame(marks, _MARKS))
            if len(self.marks.segments()) > 64:
                self.marks.fold(lambda base, new: (new if base is None else base.unionByName(new)).distinct())
                self.marks.vacuum()

    @staticmethod
    def _plain(path: str) -> str:
        """A path without the slashes that the listing and the scan write differently after the scheme."""
        scheme, _, rest = path.partition(":")
        return f"{scheme}:/{rest.lstrip('/')}"
