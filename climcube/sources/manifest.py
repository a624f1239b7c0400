"""Manifests, path lists and directory listings."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from climcube import schema
from climcube.functions import names

#: A row of the file reader holds at most 2 GB.
MOST_BYTES = 2**31 - 1024
BLOCK = 8 << 20
MOST_TASKS = 10_000


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Two-column CSV with a header: expected digest and URI.

    A row with another number of fields fails the read, whatever columns a
    caller uses: without column pruning the parser always sees whole rows.
    """
    raw = (
        spark.read.schema(schema.MANIFEST)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("columnPruning", False)
        .csv(path)
    )
    return strip_fields(raw)


def read_manifest_rows(spark: SparkSession, path: str) -> DataFrame:
    """The same file without failing: a row with another number of fields keeps its line in ``malformed``.

    No row is lost, so whatever is made of them can be counted against the file.
    """
    raw = (
        spark.read.schema(f"{schema.MANIFEST}, malformed STRING")
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "malformed")
        .option("columnPruning", False)
        .csv(path)
    )
    return strip_fields(raw)


def strip_fields(manifest: DataFrame) -> DataFrame:
    """Both fields without white space around them; other columns stay."""
    return manifest.withColumns(
        {"md5": names.strip_whitespace(F.col("md5")), "uri": names.strip_whitespace(F.col("uri"))}
    )


def read_path_list(spark: SparkSession, path: str) -> DataFrame:
    """One path per line, empty lines skipped, the last line kept with or without newline."""
    return skip_empty(spark.read.text(path), "value")


def skip_empty(lines: DataFrame, column: str) -> DataFrame:
    return lines.filter(F.length(column) > 0)


def list_files(spark: SparkSession, directory: str, glob: str = "*") -> DataFrame:
    """File catalogue of a directory; the contents are never read."""
    found = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .load(directory)
        .select("path", names.base_name(F.col("path")).alias("file_name"))
    )
    return parse_names(found)


def read_digests(
    spark: SparkSession, directory: str, glob: str = "*", most_bytes: int = MOST_BYTES, block: int = BLOCK
) -> DataFrame:
    """File name and MD5 of each file, whatever its size.

    Files up to ``most_bytes`` are digested inside the scan.  A row cannot hold a
    larger one: those are dealt to tasks by path and read in blocks, so a task
    holds one block.  A file is read once, by one of the two ways.  The scan has no row
    for an empty file, so a download of no bytes counts as missing.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(directory)
    small = files.filter(F.col("length") <= most_bytes).select("path", F.md5("content").alias("actual_md5"))
    large = files.filter(F.col("length") > most_bytes).select("path")
    n_large = large.count()
    found = small
    if n_large:
        dealt = large.repartition(min(n_large, MOST_TASKS), "path")
        found = small.union(dealt.mapInArrow(lambda b: _digest_files(b, block), "path string, actual_md5 string"))
    return found.select(names.base_name(F.col("path")).alias("file_name"), "actual_md5")


def _digest_files(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch["path"].to_pylist():
            yield pa.record_batch([pa.array([path]), pa.array([file_digest(path, block)])], names=["path", "actual_md5"])


def file_digest(path: str, block: int = BLOCK) -> str:
    """MD5 of a file of any store that Arrow's file systems reach, read block by block."""
    uri = path if "://" in path else "file://" + path.removeprefix("file:")
    store, inner = fs.FileSystem.from_uri(quote(uri, safe=":/"))
    digest = hashlib.md5(usedforsecurity=False)
    with store.open_input_stream(inner, buffer_size=0) as stream:
        while chunk := stream.read(block):
            digest.update(chunk)
    return digest.hexdigest()


def parse_names(files: DataFrame, column: str = "file_name") -> DataFrame:
    """Add the parsed naming tokens to a table of file names."""
    name: Column = F.col(column)
    tokens = {t: names.name_token(name, t) for t in names.TOKENS}
    return files.withColumns(
        {
            **tokens,
            "year": names.year_of_name(name),
            "version": names.version_of(name),
            "is_yearmean": names.is_yearmean(name),
        }
    )
