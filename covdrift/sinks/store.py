"""The tables a reminder run appends to."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from covdrift.operators.snapshot import EVENT_SCHEMA, fold_events
from covdrift.schemas import SCHEMAS, conform
from covdrift.sinks.commits import CommitLog

#: Column by which a table's rows are bucketed: the key its history is joined on.
BUCKETED_BY = {
    "todo": "forwhom_id",
    "tobe_done_detail": "todo_id",
    "coverage_event": "patient_id",
}
TABLES: dict[str, StructType] = {
    **{name: SCHEMAS[name] for name in ("todo", "tobe_done_detail")},
    "coverage_event": EVENT_SCHEMA,
}


@dataclass(frozen=True)
class ReminderStore:
    """Tables under ``root``, which all executors can reach, and the log of what is in them.

    * A run writes its rows of every table to folders of its own and then one commit entry, which
      names the tables. Readers see the runs that the log holds, so they see all rows of a run or
      none; a folder without an entry is never read.
    * Tables are bucketed by the key on which runs join them, so their growing history is joined
      where it lies; only a run's own few rows are shuffled. ``buckets`` is fixed by the first use.
    * Several runs may write at a time. Each takes its ids from a range that it reserved in a log
      of ranges, and commits on top of the version that it read; if another run was first, it
      looks again at what it may still add.
    * A run that died goes on when it is started again under its id: what it staged whole and the
      ranges it reserved are used as they are, and what it committed is not committed again.
    """

    spark: SparkSession
    root: str
    buckets: int = 64

    def _path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def _commits(self) -> CommitLog:
        return CommitLog(self.spark, self._path("commits"), "run_id string, tables array<string>")

    def _ranges(self, table: str) -> CommitLog:
        return CommitLog(self.spark, self._path(f"ranges/{table}"), "owner string, start bigint, size bigint")

    def _name(self, table: str) -> str:
        return f"covdrift_{hashlib.md5(self.root.encode()).hexdigest()}_{table}"

    def create(self) -> "ReminderStore":
        """Make the logs where there are none yet, and declare the tables in the session's catalog."""
        self._commits.create()
        for table, schema in TABLES.items():
            self._ranges(table).create()
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self._name(table)} ({columns}, run_id string) USING parquet "
                f"PARTITIONED BY (run_id) CLUSTERED BY ({BUCKETED_BY[table]}) INTO {self.buckets} BUCKETS "
                f"LOCATION '{self._path(table)}'"
            )
        return self

    def version(self) -> int:
        """Number of the newest commit; 0 for none."""
        return max((entry["number"] for entry in self._commits.entries()), default=0)

    def committed(self, run_id: str) -> bool:
        return any(entry["run_id"] == run_id for entry in self._commits.entries())

    def read(self, table: str, version: int | None = None, run_id: str | None = None) -> DataFrame:
        """Rows of the runs committed up to ``version``, or of one of them."""
        runs = [
            entry["run_id"]
            for entry in self._commits.entries()
            if table in entry["tables"]
            and (version is None or entry["number"] <= version)
            and run_id in (None, entry["run_id"])
        ]
        self.spark.catalog.refreshTable(self._name(table))
        return self.spark.table(self._name(table)).where(F.col("run_id").isin(runs)).drop("run_id")

    def todo(self, version: int | None = None) -> DataFrame:
        return self.read("todo", version)

    def details(self, version: int | None = None) -> DataFrame:
        return self.read("tobe_done_detail", version)

    def snapshots(self) -> DataFrame:
        """The latest state of every coverage snapshot."""
        return fold_events(self.read("coverage_event"))

    def commit(self, run_id: str, version: int, rows: Mapping[str, DataFrame]) -> bool:
        """Add a run's rows to all their tables at once; False if ``version`` is no longer the newest.

        ``rows`` must be staged: frames that do not read the tables themselves.
        """
        for table, frame in rows.items():
            view = f"new_{self._name(table)}"
            conform(frame, TABLES[table]).createOrReplaceTempView(view)
            literal = run_id.replace("\\", "\\\\").replace("'", "\\'")
            self.spark.sql(
                f"INSERT OVERWRITE TABLE {self._name(table)} PARTITION (run_id = '{literal}') SELECT * FROM {view}"
            )
            self.spark.catalog.dropTempView(view)
        return self._commits.append(version + 1, {"run_id": run_id, "tables": sorted(rows)})

    def reserve(self, table: str, owner: str, size: int) -> int:
        """First of ``size`` consecutive ids that no one else gets; the same again for the same owner.

        A range follows the last one and the highest id in the table.
        """
        log = self._ranges(table)
        while True:
            taken = log.entries()
            for entry in taken:
                if entry["owner"] == owner and entry["size"] == size:
                    return entry["start"]
            highest = self.read(table).agg(F.coalesce(F.max("tran_id"), F.lit(0))).first()[0]
            start = max([highest + 1, *(entry["start"] + entry["size"] for entry in taken)])
            if log.append(len(taken) + 1, {"owner": owner, "start": start, "size": size}):
                return start

    def _complete(self, path: str) -> bool:
        """Whether a write to ``path`` was committed."""
        mark = self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        files = mark.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return files.exists(mark)

    def stage(self, name: str, run_id: str, build: Callable[[], DataFrame]) -> DataFrame:
        """Write a run's rows once and hand them back as read from the folder.

        What an earlier start of the run has written whole stays, and is not built again; a part of
        it is written anew.
        """
        return self.stage_counted(name, run_id, build)[0]

    def stage_counted(self, name: str, run_id: str, build: Callable[[], DataFrame]) -> tuple[DataFrame, int]:
        """``stage``, with the number of rows: observed while they are written."""
        path = f"{self._path(name)}/run_id={run_id}"
        seen = None
        if not self._complete(path):
            seen = Observation()
            build().observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
        staged = self.spark.read.parquet(path)
        # An empty plan may be cut down to nothing, with what observes it.
        written = seen.get.get("n") if seen else None
        return staged, staged.count() if written is None else written
