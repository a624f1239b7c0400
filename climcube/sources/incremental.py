"""A yearly table that is kept up to date: new files cost the work of their own partitions only.

The state holds sums and counts, which can be merged; a mean is taken when it is read.  A ledger beside it
names the files that each partition is made of, with a stamp that changes with their contents.  An update
compares a listing with the ledger:

* a partition that only gained files reads those and adds them to its state;
* a partition that lost a file, or has one with another stamp, is computed anew from its files;
* a partition without files any more is emptied; all others are not touched.

Changed partitions replace their old ones (dynamic partition overwrite), the state before the ledger.  An
update notes the partitions it is about to change and marks the note when both are written; those of a note
without a mark, left by an update that stopped, are computed anew by the next one.  One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from climcube.schema import CELL, SERIES_KEYS

PARTITIONS = ("variable", "experiment", "year")
_KINDS = {"variable": "string", "experiment": "string", "year": "int"}


def list_stamped(spark: SparkSession, directory: str, glob: str = "*") -> DataFrame:
    """``path`` and ``stamp`` (time of change and length) of each file; contents are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    changed = F.col("modificationTime").cast("double").cast("string")
    return found.load(directory).select("path", F.concat_ws(":", changed, F.col("length").cast("string")).alias("stamp"))


class YearlyState:
    """Sums and counts per series, cell and year in ``root``, partitioned by variable, experiment and year."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str] = (*SERIES_KEYS, *CELL)):
        self.spark, self.root = spark, root.rstrip("/")
        self.keys = [k for k in keys if k not in PARTITIONS]

    def changes(self, files: DataFrame) -> DataFrame:
        """``path, action`` and the partition of every file that an update has to look at.

        ``files`` has the partition columns, none of them null, ``path`` and ``stamp``.  The action is ``add``,
        ``rebuild`` or ``empty``; a partition has one, and files that need not be read again are not listed.
        """
        now = files.select(*PARTITIONS, "path", "stamp").withColumn("_now", F.lit(True))
        ledger = self._table("ledger")
        known = now.filter(F.lit(False)) if ledger is None else ledger.filter("path IS NOT NULL")
        old = known.select(*PARTITIONS, "path", "stamp").withColumn("_old", F.lit(True))
        seen = now.unionByName(old, allowMissingColumns=True).groupBy(*PARTITIONS, "path", "stamp").agg(
            F.max("_now").alias("_now"), F.max("_old").alias("_old")
        )
        stopped = self._stopped()
        if stopped is not None:
            marked = stopped.select(*PARTITIONS).distinct().withColumn("_stopped", F.lit(True))
            seen = seen.join(marked, list(PARTITIONS), "full")
        else:
            seen = seen.withColumn("_stopped", F.lit(None).cast("boolean"))
        here = F.col("_now").isNotNull()
        new = here & F.col("_old").isNull()
        of = seen.groupBy(*PARTITIONS).agg(
            F.bool_or(F.col("_old").isNotNull() & ~here).alias("_lost"), F.bool_or(new).alias("_new"),
            F.bool_or(F.col("_old").isNotNull()).alias("_known"), F.bool_or(here).alias("_any"),
            F.bool_or(F.coalesce("_stopped", F.lit(False))).alias("_half"),
        )
        action = (
            F.when(~F.col("_any") & (F.col("_lost") | F.col("_half")), "empty")
            .when(F.col("_any") & (F.col("_lost") | F.col("_half") | ~F.col("_known")), "rebuild")
            .when(F.col("_new"), "add")
        )
        asked = of.select(*PARTITIONS, action.alias("action")).filter("action IS NOT NULL")
        found = seen.join(asked, list(PARTITIONS))
        wanted = (F.col("action") == "empty") | ((F.col("action") == "rebuild") & here) | new
        return found.filter(wanted).select(*PARTITIONS, "path", "action")

    def update(self, files: DataFrame, read: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Bring state and ledger up to ``files``; ``read`` gives the grid rows of a table of paths.

        Returns the actions that were taken with the number of files read, one row a partition.
        """
        if not files.filter(" OR ".join(f"{p} IS NULL" for p in PARTITIONS)).isEmpty():
            raise ValueError(f"a file lacks one of {', '.join(PARTITIONS)}")
        before, note = self._open_notes(), uuid.uuid4().hex
        # the note is written from the ledger as it is now and read again below
        self.changes(files).write.parquet(f"{self.root}/notes/{note}")
        changes = self.spark.read.parquet(f"{self.root}/notes/{note}")
        taken = changes.groupBy(*PARTITIONS, "action").agg(F.count("path").alias("n_files"))
        if not taken.isEmpty():
            self._replace(self._merged(changes, taken, read), "state")
            ledger = taken.select(*PARTITIONS).join(files.select(*PARTITIONS, "path", "stamp"), list(PARTITIONS), "left")
            self._replace(ledger, "ledger")
        for done in (*before, note):
            store, path = self._path(f"notes/{done}/_DONE")
            store.create(path, True).close()
        return taken

    def yearly(self) -> DataFrame:
        """The yearly means that the state stands for."""
        state = self._table("state")
        if state is None:
            raise ValueError(f"no state in {self.root}")
        mean = F.col("total") / F.nullif(F.col("n_steps"), F.lit(0))
        means = state.filter("n_steps IS NOT NULL").withColumn("value", mean)
        return means.select(*self.keys, *PARTITIONS, "value", "n_steps")

    def _merged(self, changes: DataFrame, taken: DataFrame, read: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """The new state of the changed partitions; one row marks each, so that an empty one replaces its past, too."""
        rows = read(changes.filter("action <> 'empty'").select("path"))
        fresh = rows.groupBy(*self.keys, *PARTITIONS).agg(F.sum("value").alias("total"), F.count("value").alias("n_steps"))
        columns = [*self.keys, *PARTITIONS, "total", "n_steps"]
        parts, old = fresh.select(*columns), self._table("state")
        if old is not None:
            grown = taken.filter("action = 'add'").select(*PARTITIONS)
            kept = old.filter("n_steps IS NOT NULL").join(grown, list(PARTITIONS), "left_semi")
            parts = parts.unionByName(kept.select(*columns))
        state = parts.groupBy(*self.keys, *PARTITIONS).agg(F.sum("total").alias("total"), F.sum("n_steps").alias("n_steps"))
        return state.unionByName(taken.select(*PARTITIONS), allowMissingColumns=True)

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _table(self, name: str) -> DataFrame | None:
        # a write of single partitions leaves no marker; partitions appear whole, and notes cover a stopped write
        store, parts = self._path(f"{name}/{PARTITIONS[0]}=*")
        if not store.globStatus(parts):
            return None
        rows = self.spark.read.parquet(f"{self.root}/{name}")
        return rows.withColumns({p: F.col(p).cast(kind) for p, kind in _KINDS.items()})

    def _open_notes(self) -> list[str]:
        """Notes that were written whole and not marked."""
        store, whole = self._path("notes/*/_SUCCESS")
        names = [s.getPath().getParent().getName() for s in store.globStatus(whole) or ()]
        return [n for n in names if not store.exists(self._path(f"notes/{n}/_DONE")[1])]

    def _stopped(self) -> DataFrame | None:
        notes = self._open_notes()
        return self.spark.read.parquet(*[f"{self.root}/notes/{n}" for n in notes]) if notes else None

    def _replace(self, rows: DataFrame, name: str) -> None:
        (
            rows.hint("rebalance", *PARTITIONS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(*PARTITIONS).parquet(f"{self.root}/{name}")
        )
