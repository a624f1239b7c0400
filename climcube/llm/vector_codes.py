"""Compress vectors to one byte a part by exact integer k-means per part.

Method: vectors are read once and written to the shared folder as flat blocks.  A chunk holds the integer
components of some thousand vectors; for each part position they are sorted along a Hilbert curve and cut into
blocks of ``BLOCK`` parts, each stored with the box of its components (min, max) and their sum.  A round
compares boxes with the codebook: an entry whose least distance to a box is more than the best greatest distance
cannot be nearest to any part of the block.  The few others are the block's shortlist.  If one is left, count
and sum of the block are added as they are; else a small kernel finds the nearest entry of each part.  The shortlist
keeps ties, and the kernel takes the lowest index.

* The kernel computes on doubles where all products and sums are integers below 2**53, which is checked
  against the largest component, so every result is exact; on Python integers otherwise.
* Rounds shuffle sums per entry, at most the size of the codebooks a task, and only the codebooks (256 entries a part)
  reach the driver.  Vectors are never shuffled; a lost executor re-reads its blocks.
* A chunk takes at most ``CHUNK`` components, whatever the length of the vectors.
* Errors per label are combined before the shuffle; the table of labels is broadcast only if counted small.

Defined results: rows whose vector is null or holds a null or non-finite component are dropped.  Shorter vectors, empty
ones included, count as filled up with zeros to the longest, and all to a multiple of four.  Components are held
within 10**18 in size.  Of rows that share an identifier the least vector may seed an entry, and every row gets its code; a null
identifier seeds none.  With fewer than 256 seeds the codebooks are shorter, and with none (an empty table, or no
identifier) there is no row.  An error beyond the range of a long is null.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import broadcast_if_small, cut

PARTS = 4
ENTRIES = 256
ROUNDS = 4
BLOCK = 128
CHUNK = 1 << 19
SCALE = 1024
_LARGEST = 10**18
_LABEL_ROWS = 100_000
_CURVE_BITS = 63


def integers(components: np.ndarray) -> np.ndarray:
    """floor(1024 x) of finite components, exact and within 10**18."""
    scaled = np.clip(components, -_LARGEST / SCALE, _LARGEST / SCALE) * SCALE
    return np.floor(scaled).astype(np.int64)


# --- blocks -------------------------------------------------------------------------


def hilbert_keys(points: np.ndarray) -> np.ndarray:
    """Place of each integer point on a Hilbert curve through the box of all of them.

    At most 21 leading components take part, each reduced to the bits that fit into one key.
    """
    points = points[:, :21].astype(np.float64)
    n, dims = points.shape
    bits = min(16, _CURVE_BITS // dims)
    low = points.min(axis=0)
    span = np.maximum(points.max(axis=0) - low, 1)
    x = np.minimum((points - low) / span * (1 << bits), (1 << bits) - 1).astype(np.int64)
    bit = 1 << (bits - 1)
    while bit > 1:  # undo the rotations and reflections of each level, coarse to fine
        for i in range(dims):
            swap = np.where(x[:, i] & bit, 0, (x[:, 0] ^ x[:, i]) & (bit - 1))
            x[:, 0] ^= np.where(x[:, i] & bit, bit - 1, swap)
            x[:, i] ^= swap if i else 0
        bit >>= 1
    for i in range(1, dims):
        x[:, i] ^= x[:, i - 1]
    turn, bit = np.zeros(n, np.int64), 1 << (bits - 1)
    while bit > 1:
        turn ^= np.where(x[:, -1] & bit, bit - 1, 0)
        bit >>= 1
    x ^= turn[:, None]
    key = np.zeros(n, np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << 1 | x[:, i] >> level & 1
    return key


def _matrix(vectors: pa.ListArray, dims: int) -> np.ndarray:
    lengths = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    if (lengths == dims).all():
        return integers(flat.reshape(-1, dims))
    filled = np.zeros((len(vectors), dims))
    filled[np.arange(dims) < lengths[:, None]] = flat
    return integers(filled)


def _chunk(ids: pa.Array, labels: pa.Array, vectors: np.ndarray) -> pa.RecordBatch:
    n, dims = vectors.shape
    width = dims // PARTS
    most = int(np.abs(vectors).max(initial=0))
    kind = next(k for k in ("<i2", "<i4", "<i8") if most <= np.iinfo(k).max)
    starts = np.arange(0, n, BLOCK)
    flat, orders, lows, highs, sums = [], [], [], [], []
    for part in range(PARTS):
        own = vectors[:, part * width : (part + 1) * width]
        order = np.argsort(hilbert_keys(own), kind="stable")
        own = own[order]
        flat.append(own.astype(kind).tobytes())
        orders.append(order.astype("<i4").tobytes())
        lows.append(np.minimum.reduceat(own, starts).tobytes())
        highs.append(np.maximum.reduceat(own, starts).tobytes())
        sums.append(b"".join(_total(own[s : s + BLOCK]) for s in starts))
    one = [n, kind, b"".join(flat), b"".join(orders), b"".join(lows), b"".join(highs), b"".join(sums)]
    lists = [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), x) for x in (ids, labels)]
    return pa.record_batch([*lists, *[pa.array([x]) for x in one]],
                           names=["ids", "labels", "n", "kind", "flat", "orders", "lows", "highs", "sums"])


def _total(rows: np.ndarray) -> bytes:
    """Sums of a block; 128 components of at most 10**18 need not fit, so two words each: multiples of 2**32, rest."""
    return np.stack([(rows >> 32).sum(axis=0), (rows & 0xFFFFFFFF).sum(axis=0)]).tobytes()


def _chunks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    most = max(BLOCK, CHUNK // dims)
    held: list[pa.RecordBatch] = []
    n = 0

    def emit() -> pa.RecordBatch:
        whole = pa.Table.from_batches(held).combine_chunks()
        columns = [whole[c].chunk(0) for c in ("vec_id", "label", "embedding")]
        return _chunk(columns[0], columns[1], _matrix(columns[2], dims))

    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, most - n)
            held.append(part)
            n += part.num_rows
            batch = batch.slice(part.num_rows)
            if n == most:
                yield emit()
                held, n = [], 0
    if n:
        yield emit()


class _Blocks:
    """One chunk as read back."""

    def __init__(self, row: dict):
        self.n = row["n"]
        self.flat = np.frombuffer(row["flat"], row["kind"]).reshape(PARTS, self.n, -1)
        width = self.flat.shape[2]
        self.orders = np.frombuffer(row["orders"], "<i4").reshape(PARTS, self.n)
        self.lows, self.highs = (np.frombuffer(row[x], np.int64).reshape(PARTS, -1, width) for x in ("lows", "highs"))
        self.sums = np.frombuffer(row["sums"], np.int64).reshape(PARTS, -1, 2, width)


# --- rounds -------------------------------------------------------------------------


def _numbers(width: int, *arrays: np.ndarray):
    """Doubles where all distances stay exact, Python integers otherwise."""
    most = max((max(abs(int(x.min())), abs(int(x.max()))) for x in arrays if x.size), default=0)
    return np.float64 if 4 * width * (most + 1) ** 2 < 2**53 else object


def shortlists(lows: np.ndarray, highs: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Per block which entries may be nearest to a part in its box, ties included."""
    below, above = lows[:, None] - book, book - highs[:, None]
    least = (np.maximum(np.maximum(below, above), 0) ** 2).sum(axis=2)
    greatest = (np.maximum(abs(below), abs(above)) ** 2).sum(axis=2)
    # the farthest corner of a box is at its low or high end in every component
    return least <= greatest.min(axis=1, keepdims=True)


def _nearest(points: np.ndarray, book: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry of each point, the lowest of equals, and its squared distance."""
    chosen = book[among]
    partial = (chosen * chosen).sum(axis=1) - 2 * points.dot(chosen.T)
    at = partial.argmin(axis=1)
    return among[at], (points * points).sum(axis=1) + partial[np.arange(len(points)), at]


def _tally(batches: Iterator[pa.RecordBatch], books: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Count (position -1) and component sums of every used entry over the blocks of a task."""
    _, entries, width = books.shape
    counts = np.zeros((PARTS, entries), np.int64)
    sums = np.zeros((PARTS, entries, width), object)
    for batch in batches:
        for row in batch.to_pylist():
            _tally_chunk(_Blocks(row), books, counts, sums)
    rows = [
        (part, entry, at, Decimal(int(total)))
        for part, entry in np.argwhere(counts).tolist()
        for at, total in enumerate([counts[part, entry], *sums[part, entry]], -1)
    ]
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.decimal128(38, 0))
    yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["part", "entry", "at", "total"])


def _tally_chunk(blocks: _Blocks, books: np.ndarray, counts: np.ndarray, sums: np.ndarray) -> None:
    for part in range(PARTS):
        own, book = blocks.flat[part], books[part]
        kind = _numbers(book.shape[1], own, book)
        book = book.astype(kind)
        listed = shortlists(blocks.lows[part].astype(kind), blocks.highs[part].astype(kind), book)
        added = np.zeros(book.shape, kind)
        for block, row in enumerate(listed):
            among, start = np.flatnonzero(row), block * BLOCK
            points = own[start : start + BLOCK]
            if len(among) == 1:
                high, rest = blocks.sums[part, block]
                counts[part, among[0]] += len(points)
                sums[part, among[0]] += high.astype(object) * 2**32 + rest
                continue
            points = points.astype(kind)
            chosen, _ = _nearest(points, book, among)
            counts[part] += np.bincount(chosen, minlength=len(book))
            np.add.at(added, chosen, points)
        sums[part] += added.astype(np.int64).astype(object) if kind is np.float64 else added


def _encode(batches: Iterator[pa.RecordBatch], books: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, labels = batch["ids"], batch["labels"]
        for i, row in enumerate(batch.drop_columns(["ids", "labels"]).to_pylist()):
            blocks = _Blocks(row)
            codes = np.empty((blocks.n, PARTS), np.uint8)
            errors = np.zeros(blocks.n, object)
            for part in range(PARTS):
                own, book = blocks.flat[part], books[part]
                kind = _numbers(book.shape[1], own, book)
                book = book.astype(kind)
                listed = shortlists(blocks.lows[part].astype(kind), blocks.highs[part].astype(kind), book)
                for block, among in enumerate(listed):
                    places = slice(block * BLOCK, (block + 1) * BLOCK)
                    chosen, distance = _nearest(own[places].astype(kind), book, np.flatnonzero(among))
                    rows = blocks.orders[part][places]
                    codes[rows, part] = chosen
                    errors[rows] += distance.astype(np.int64).astype(object) if kind is np.float64 else distance
            yield pa.record_batch(
                [ids[i].values, labels[i].values, pa.array([x.tobytes().hex() for x in codes], pa.string()),
                 pa.array([int(e) if e < 2**63 else None for e in errors], pa.int64())],
                names=["vec_id", "label", "code", "error"],
            )


# --- the whole ------------------------------------------------------------------------


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, embedding`` of rows with a vector of finite components, as doubles."""
    given = vectors.select(
        "vec_id", "label" if "label" in vectors.columns else F.lit(None).cast("int").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    fine = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(F.coalesce(x, F.lit(0.0))) < float("inf")))
    return given.filter(F.coalesce(fine, F.lit(False)))


def _seeds(kept: DataFrame, dims: int) -> np.ndarray:
    """The first codebooks, from the smallest identifiers; rows that repeat one are skipped over."""
    ids: list = []
    while len(ids) < ENTRIES:
        rest = kept.filter(F.col("vec_id").isNotNull() if not ids else F.col("vec_id") > F.lit(ids[-1]))
        found = rest.select("vec_id").orderBy("vec_id").limit(ENTRIES - len(ids)).collect()
        if not found:
            break
        ids += sorted({r[0] for r in found})
    rows = kept.filter(F.col("vec_id").isin(ids)).groupBy("vec_id").agg(F.min("embedding").alias("v")).collect()
    listed = [list(r["v"]) + [0.0] * (dims - len(r["v"])) for r in sorted(rows, key=lambda r: r["vec_id"])]
    whole = integers(np.array(listed, np.float64).reshape(len(rows), dims))
    return np.ascontiguousarray(whole.reshape(len(rows), PARTS, dims // PARTS).swapaxes(0, 1))


def _blocks_type(kept: DataFrame) -> T.StructType:
    kinds = {f.name: f.dataType for f in kept.schema}
    binary = [T.StructField(n, T.BinaryType()) for n in ("flat", "orders", "lows", "highs", "sums")]
    return T.StructType([
        T.StructField("ids", T.ArrayType(kinds["vec_id"])), T.StructField("labels", T.ArrayType(kinds["label"])),
        T.StructField("n", T.LongType()), T.StructField("kind", T.StringType()), *binary,
    ])


def _refined(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round; entries that no part chose stay."""
    tallied = blocks.drop("ids", "labels").mapInArrow(
        lambda b: _tally(b, books), "part int, entry int, at int, total decimal(38,0)"
    )
    whole = tallied.groupBy("part", "entry", "at").agg(F.sum("total").alias("total")).collect()
    counts = {(r["part"], r["entry"]): int(r["total"]) for r in whole if r["at"] < 0}
    new = books.copy()
    for r in whole:
        if r["at"] >= 0:
            new[r["part"], r["entry"], r["at"]] = int(r["total"]) // counts[r["part"], r["entry"]]
    return new


def compress(vectors: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every usable row."""
    kept = usable(vectors)
    longest = kept.agg(F.max(F.size("embedding"))).first()[0] or 0
    dims = max(PARTS, -(-longest // PARTS) * PARTS)
    books = _seeds(kept, dims)
    kinds = {f.name: f.dataType.simpleString() for f in kept.schema}
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"
    if books.shape[1]:
        blocks = cut(kept.mapInArrow(lambda b: _chunks(b, dims), _blocks_type(kept)))
        for _ in range(rounds):
            books = _refined(blocks, books)
        final = books
        rows = cut(blocks.mapInArrow(lambda b: _encode(b, final), schema))
    else:
        rows = vectors.sparkSession.createDataFrame([], schema)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    per_label = broadcast_if_small(
        rows.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")), _LABEL_ROWS
    )
    return rows.join(per_label, F.col("label").eqNullSafe(F.col("_label")), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
