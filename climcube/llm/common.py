"""Small helpers shared by the text operators."""

from __future__ import annotations

import tempfile
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six characters that separate words, and the same as a regular expression.
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
FOLDS = 5
CHECKPOINT_SETTING = "spark.checkpoint.dir"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def fold(doc_id: Column) -> Column:
    """crc32 of the identifier as text, modulo five; null for a null identifier."""
    return (F.crc32(doc_id.cast("string").cast("binary")) % FOLDS).cast("int")


def doc_key(text: Column, doc_id: str = "doc_id") -> Column:
    """Identifier and text digest: a key that is never null and tells apart rows that share an identifier.

    Rows alike in both have equal results, so one result may serve all of them.
    """
    return F.struct(F.col(doc_id).alias("id"), F.xxhash64(text).alias("hash"), F.length(text).alias("size"))


def ascii_lower(text: Column) -> Column:
    """Lower-case A to Z and nothing else."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share; where none is set a temporary one in local mode, else an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get(CHECKPOINT_SETTING, None)
        if not named and sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="llm-checkpoint-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Write the rows to the shared folder and go on from there."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager)


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """A broadcast hint if a count finds at most ``max_rows`` rows; above, a hash join built from ``df``.

    The second way shuffles both sides but does not sort the other one, which may hold texts.
    """
    few = df.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(df) if few else df.hint("shuffle_hash")


def packed(docs: DataFrame, keep: Iterable[str]) -> DataFrame:
    """``row`` with every original column, and beside it the named columns (null if absent).

    Columns of the input can then not clash with those that an operator adds.
    """
    have = set(docs.columns)
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        *[(F.col(f"`{c}`") if c in have else F.lit(None).cast("string")).alias(c) for c in keep],
    )


def unpacked(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.select(*[F.col(f"row.`{c}`").alias(c) for c in columns])


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Bound what one Arrow batch of texts holds; a smaller setting of the session stands."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name, "10000"))
    if not 0 < now <= rows:
        spark.conf.set(name, str(rows))
