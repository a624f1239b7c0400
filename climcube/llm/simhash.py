"""Near duplicates by SimHash, with the anchors of a covering code.

The fingerprints' low 63 bits are points of a Hamming space whose anchors are the words of the
perfect Hamming code of length 63: every point lies within R = 1 of exactly one anchor.  Take two
fingerprints at most t = 2 bits apart and a point half-way between them, at most one bit from each.
The anchor of that point is within R + 1 of both.  So it is enough that each fingerprint is
replicated to every anchor within the covering radius plus half the threshold: 32 anchors (1 if the
fingerprint is itself an anchor).  Replication up to R + t would reach 652 anchors and only meet the
same pairs again.  Within an anchor fingerprints are compared by their full 64 bits.

An anchor holds at most 4,034 distinct fingerprints, as many as there are within two bits, so no
bucket can grow with the data: exact copies are folded into one fingerprint beforehand.  Of each
anchor only a spanning tree of its linked fingerprints is kept, never all pairs.  Buckets are
read as sorted runs of a partition, a batch at a time.

Defined cases: texts without words, null ones included, have fingerprint zero and are linked like
any other; rows alike in identifier and text are copies of each other; where all identifiers of a
component are null, its identifier is null; empty tables give empty results; other columns of
the input are neither read nor changed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, cut, doc_key, packed, small_batches, text_or_empty, unpacked
from .components import components

SEED = 42
POSITIONS = 63
#: Shingles whose bits are counted at a time.
BLOCK = 65_536


def fingerprint(text: bytes, size: int) -> int:
    """Bitwise majority of the hashes of the text's word shingles, as a signed 64-bit integer.

    ``bytes`` methods treat exactly A to Z as capitals and exactly the six ASCII spaces as spaces.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) < size:
        hashes = np.array([digest(joined, SEED)], "<u8")
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[: len(words) - size] + 1))
        spans = zip(starts.tolist(), ends[size - 1 :].tolist(), strict=True)
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), "<u8", len(starts))
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BLOCK):
        octets = hashes[at : at + BLOCK].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """doc (identifier and digest), fp of every document row."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_text").cast(pa.binary())
            found = pa.array([fingerprint(x.as_py(), shingle) for x in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc"), found], ["doc", "fp"])

    rows = docs.select(doc_key(text_or_empty()).alias("doc"), text_or_empty().alias("_text"))
    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc {kind}, fp bigint")


def syndrome(fp: Column) -> Column:
    """Position (1 to 63) of the bit that separates a fingerprint from its anchor, or 0."""
    total = F.lit(0)
    for k in range(6):
        mask = sum(1 << (i - 1) for i in range(1, POSITIONS + 1) if i >> k & 1)
        total = total + F.shiftleft((F.bit_count(fp.bitwiseAND(F.lit(mask))) % 2).cast("int"), k)
    return total


def anchors(fp: Column, at: Column) -> Column:
    """The anchors within two bits; ``at`` is the fingerprint's syndrome."""
    low = fp.bitwiseAND(F.lit((1 << POSITIONS) - 1))

    def bit(i: Column) -> Column:
        one = F.lit(1).cast("bigint")
        return F.when(i == 0, F.lit(0).cast("bigint")).otherwise(F.call_function("shiftleft", one, i - 1))

    pairs = F.filter(
        F.sequence(F.lit(0), F.lit(POSITIONS)), lambda i: (i < i.bitwiseXOR(at)) | ((at == 0) & (i == 0))
    )
    return F.transform(pairs, lambda i: low.bitwiseXOR(bit(i)).bitwiseXOR(bit(i.bitwiseXOR(at))))


def _tree(points: np.ndarray, most: int) -> np.ndarray:
    """Each point's smallest index that it is connected with inside one bucket."""
    near = np.bitwise_count(points[:, None] ^ points[None, :]) <= most
    label = np.arange(len(points))
    while True:
        least = np.where(near, label[None, :], len(points)).min(axis=1)
        least = least[least]
        if (least == label).all():
            return label
        label = least


def _links(most: int):
    def of_runs(keys: np.ndarray, fps: np.ndarray) -> tuple[list, list]:
        """Edges inside complete runs of equal keys."""
        u, v = [], []
        starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        sizes = np.diff(np.append(starts, len(keys)))
        two = starts[sizes == 2]
        close = two[np.bitwise_count(fps[two] ^ fps[two + 1]) <= most]
        u.append(fps[close + 1])
        v.append(fps[close])
        for at, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
            points = fps[at : at + n]
            root = _tree(points, most)
            moved = np.flatnonzero(root != np.arange(n))
            u.append(points[moved])
            v.append(points[root[moved]])
        return u, v

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.empty(0, np.int64), np.empty(0, np.uint64)

        def edges(upto: int) -> pa.RecordBatch:
            u, v = of_runs(keys[:upto], fps[:upto])
            both = [pa.array(np.concatenate(x).view(np.int64)) for x in (u, v)]
            return pa.RecordBatch.from_arrays(both, ["u", "v"])

        for batch in batches:
            keys = np.concatenate((keys, batch.column("key").to_numpy()))
            fps = np.concatenate((fps, batch.column("fp").to_numpy().view(np.uint64)))
            last = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0  # the last run may go on
            if last:
                yield edges(last)
                keys, fps = keys[last:], fps[last:]
        if len(keys):
            yield edges(len(keys))

    return run


def links(points: DataFrame, most_bits: int) -> DataFrame:
    """Edges u, v that connect all fingerprints of ``points`` (distinct fp) at most ``most_bits`` apart."""
    if not 0 <= most_bits <= 2:
        raise ValueError("the anchors cover distances up to 2")
    keyed = points.select("fp", syndrome(F.col("fp")).alias("_at")).select(
        "fp", F.explode(anchors(F.col("fp"), F.col("_at"))).alias("key")
    )
    return keyed.repartition("key").sortWithinPartitions("key").mapInArrow(_links(most_bits), "u bigint, v bigint")


def groups(docs: DataFrame, shingle: int = 3, most_bits: int = 2) -> DataFrame:
    """doc, fp, component_id, keeper (the doc that stands for the component) for every document row."""
    rows = cut(fingerprints(docs, shingle))
    points = rows.groupBy("fp").agg(
        F.min("doc.id").alias("_least"), F.min(F.struct(F.col("doc.id").isNull().alias("none"), "doc")).alias("_first")
    )
    roots = components(links(points, most_bits)).withColumnRenamed("node", "fp")
    points = points.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    of_root = points.groupBy("root").agg(F.min("_least").alias("component_id"), F.min("_first").alias("_first"))
    named = points.select("fp", "root").join(of_root, "root").select("fp", "component_id", F.col("_first.doc").alias("keeper"))
    return rows.join(named, "fp").select("doc", "fp", "component_id", "keeper")


def near_duplicates(docs: DataFrame, shingle: int = 3, most_bits: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id; a row for each document row."""
    return groups(docs, shingle, most_bits).select(
        F.col("doc.id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_first(docs: DataFrame, shingle: int = 3, most_bits: int = 2) -> DataFrame:
    """One document of each group: the one with the smallest identifier, with its own columns.

    The list of keepers has no text.  Rows that repeat a keeper exactly are the only ones that
    are compared as rows; they alone are shuffled for it.
    """
    kept = cut(
        groups(docs, shingle, most_bits)
        .where(F.col("doc") == F.col("keeper"))
        .groupBy("doc")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    rows = packed(docs, ["doc_id", "text"]).select("row", doc_key(text_or_empty()).alias("doc"))
    found = rows.join(broadcast_if_small(kept, 300_000), "doc")
    once = found.where("_n = 1").select("row")
    repeated = found.where("_n > 1").dropDuplicates(["doc"]).select("row")
    return unpacked(once.union(repeated), docs.columns)
