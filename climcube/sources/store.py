"""Idempotent stages: a result is computed once per set of parameters."""

from __future__ import annotations

import hashlib
import json
import tempfile
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, is_dataclass

from pyspark.sql import DataFrame, SparkSession

from climcube.sources.grids import save_bucketed

CHECKPOINT_SETTING = "spark.checkpoint.dir"


class Store:
    """Parquet results under a shared folder, named by stage and parameters.

    The folder is the cluster's ``spark.checkpoint.dir``, which all executors
    share; ``root`` counts only where that is unset, as in tests.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        shared = spark.conf.get(CHECKPOINT_SETTING, None) or root
        if not shared:
            raise ValueError(f"set {CHECKPOINT_SETTING} or pass a shared folder")
        self.root = shared.rstrip("/")

    def path(self, stage: str, params: object) -> str:
        return f"{self.root}/{stage}-{fingerprint(params)}"

    def is_done(self, stage: str, params: object) -> bool:
        """A stage is done once its commit marker exists."""
        marker = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(stage, params) + "/_SUCCESS")
        conf = self.spark._jsc.hadoopConfiguration()
        return marker.getFileSystem(conf).exists(marker)

    def materialize(
        self,
        stage: str,
        params: object,
        build: Callable[[], DataFrame],
        write: Callable[[DataFrame, str], None] | None = None,
    ) -> DataFrame:
        """Read the stage if it is done, else build, write and read it.

        Reading back what was written also cuts the lineage, so a lost executor
        costs a re-read and not a re-computation.
        """
        target = self.path(stage, params)
        if not self.is_done(stage, params):
            (write or _write)(build(), target)
        return self.spark.read.parquet(target)


    def materialize_bucketed(
        self, stage: str, params: object, build: Callable[[], DataFrame], buckets: int, keys: Sequence[str]
    ) -> DataFrame:
        """The same for a table bucketed by ``keys``, so that grouping by them needs no shuffle.

        The files lie in the folder like any stage; a session that does not
        know the table declares it from them.
        """
        params = {"params": params, "buckets": buckets, "keys": list(keys)}
        target, name = self.path(stage, params), f"{stage}_{fingerprint(params)}"
        if not self.is_done(stage, params):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            save_bucketed(build(), name, buckets, keys, path=target)
        elif not self.spark.catalog.tableExists(name):
            columns = self.spark.read.parquet(target).schema.toDDL()
            listed = ", ".join(keys)
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet "
                f"CLUSTERED BY ({listed}) SORTED BY ({listed}) INTO {buckets} BUCKETS LOCATION '{target}'"
            )
        return self.spark.table(name)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared one; a local one only in a local session without a shared folder."""
    shared = spark.conf.get(CHECKPOINT_SETTING, None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="climcube-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _write(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def fingerprint(params: object) -> str:
    """Digest over *all* parameters, so a changed setting never meets a stale file."""
    plain = asdict(params) if is_dataclass(params) and not isinstance(params, type) else params
    if isinstance(plain, Mapping):
        plain = {k: asdict(v) if is_dataclass(v) else v for k, v in plain.items()}
    text = json.dumps(plain, sort_keys=True, default=str)
    return hashlib.sha1(text.encode()).hexdigest()[:16]
