"""Drop lines that many documents share; each stays in the last document that holds it.

Method: a sharded minimal perfect hash.  Every long line becomes a 128-bit hash of its key; Spark counts
the documents of each distinct hash and finds the last one.  Hashes of one shard (their top bits) are laid out
in bit levels: a hash that is alone on its bit of a level owns it, the others go on to the next level, and the
rank of its bit is its place in arrays of fingerprints, counts and last documents.  Documents probe the
arrays where they are: lines are neither shuffled nor joined.

* A hash of one document decides nothing and is left out of the arrays; as such lines are probed too, the
  fingerprint has 64 bits.  Two different lines are taken for one with a chance of 2**-64 a probe.
* What the first shuffle carries is 24 bytes a distinct line of a task; a line that every document holds
  is combined before it.  A shard holds about ``SHARD_KEYS`` hashes whatever the size of the input.
* The arrays go to the tasks if all of them take at most ``most_bytes``.  Beyond that, probes go to the
  shards: shards of frequent lines are copied as often as their known counts ask for, so that
  no copy meets more than about ``COPY_PROBES`` probes, and only the hits return to the documents.

Defined results: a null text is empty and an empty text is one empty line.  Every row counts as a document, also
when rows share an identifier; a line stays in all rows of its largest identifier, where null comes before
every number.  A line without a kept partner is never changed: what stays is joined as it was.  A key repeated
inside one document counts once, and goes or stays as a whole.  An empty table gives no row.  Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, cut

SHARD_KEYS = 8192
COPY_PROBES = 200_000
MOST_BYTES = 64 << 20
_SENT_SHARDS = 1_000_000
_GAMMA = 1.5
_BLANKS = b" \t\n\x0b\x0c\r"
_NO_ID = -(2**63)
_U = np.uint64
_ARRAYS = ("sizes", "bits", "prints", "counts", "lasts")
_SHARD = "shard int, load long, sizes binary, bits binary, prints binary, counts binary, lasts binary"


# --- lines ------------------------------------------------------------------------


def long_keys(lines: list[bytes], least: int) -> list[tuple[int, bytes]]:
    """Number and key of every line whose key has at least ``least`` code points."""
    found = []
    for i, line in enumerate(lines):
        if len(line) >= least:
            key = line.strip(_BLANKS).lower()
            if len(key) >= least and (key.isascii() or _code_points(key) >= least):
                found.append((i, key))
    return found


def _code_points(text: bytes) -> int:
    return len(text.decode("utf-8", "replace"))


def _hashes(keys: list[bytes]) -> np.ndarray:
    """Two unsigned words a key."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), "<u8").reshape(-1, 2)


def _signed(words: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(words).view(np.int64))


def _hash_rows(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, owners = [], []
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
            own = {key for _, key in long_keys(text.as_py().split(b"\n"), least)}
            keys += own
            owners += [doc_id] * len(own)
        words = _hashes(keys)
        yield pa.record_batch(
            [_signed(words[:, 0]), _signed(words[:, 1]), pa.array(owners, pa.int64())], names=["h1", "h2", "doc_id"]
        )


# --- the perfect hash ---------------------------------------------------------------


def _place(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    """Bit of each hash on a level, mixed from both of its words."""
    with np.errstate(over="ignore"):
        x = h1 ^ (h2 * _U(0x9E3779B97F4A7C15)) ^ _U((level * 0xD6E8FEB86659FD93) % 2**64)
        x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
        x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
        x ^= x >> _U(32)
    return (x % _U(size)).astype(np.int64)


class Shard:
    """Bit levels with ranks, and the arrays that they index."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, prints=None, counts=None, lasts=None):
        self.sizes, self.bits = sizes, bits
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)])
        self.prints, self.counts, self.lasts = prints, counts, lasts

    @classmethod
    def of(cls, h1: np.ndarray, h2: np.ndarray, counts: np.ndarray, lasts: np.ndarray) -> Shard:
        sizes, levels = [], []
        left1, left2 = h1, h2
        while len(left1):
            size = max(64, math.ceil(_GAMMA * len(left1) / 64) * 64)
            at = _place(left1, left2, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(np.packbits(alone, bitorder="little"))
            rest = ~alone[at]
            left1, left2 = left1[rest], left2[rest]
        shard = cls(np.array(sizes, np.int64), np.concatenate([np.empty(0, np.uint8), *levels]))
        order = np.argsort(shard.rank(h1, h2))
        shard.prints, shard.counts, shard.lasts = h2[order], counts[order], lasts[order]
        return shard

    def rank(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Place of each hash in the arrays, -1 where no level knows it."""
        found = np.full(len(h1), -1, np.int64)
        todo, start = np.arange(len(h1)), 0
        for level, size in enumerate(self.sizes.tolist()):
            at = start + _place(h1[todo], h2[todo], level, size)
            byte, bit = self.bits[at >> 3], (at & 7).astype(np.uint8)
            own = (byte >> bit) & 1 == 1
            below = np.bitwise_count(byte[own] & ((1 << bit[own].astype(np.int64)) - 1).astype(np.uint8))
            found[todo[own]] = self.before[at[own] >> 3] + below
            todo, start = todo[~own], start + size
            if not len(todo):
                break
        return found

    def probe(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count and last document of each hash; count 0 for one that is not in the arrays."""
        at = self.rank(h1, h2)
        known = at >= 0
        known[known] = self.prints[at[known]] == h2[known]
        at = np.where(known, at, 0)
        return np.where(known, self.counts[at], 0), np.where(known, self.lasts[at], _NO_ID)

    def row(self) -> list[bytes]:
        return [x.tobytes() for x in (self.sizes, self.bits, self.prints, self.counts, self.lasts)]

    @classmethod
    def read(cls, sizes, bits, prints, counts, lasts) -> Shard:
        kinds = (np.int64, np.uint8, _U, np.int64, np.int64)
        given = (sizes, bits, prints, counts, lasts)
        return cls(*[np.frombuffer(x, kind) for x, kind in zip(given, kinds, strict=True)])


def _words(table, *names: str) -> list[np.ndarray]:
    return [table[n].to_numpy().view(_U) for n in names]


def _build(table: pa.Table) -> pa.Table:
    h1, h2 = _words(table, "h1", "h2")
    lasts = table["last"].fill_null(_NO_ID).to_numpy()
    made = Shard.of(h1, h2, table["n"].to_numpy(), lasts)
    columns = [pa.array([table["shard"][0].as_py()], pa.int32()), pa.array([int(made.counts.sum())]),
               *[pa.array([x], pa.binary()) for x in made.row()]]
    return pa.table(columns, names=["shard", "load", *_ARRAYS])


def _shard_of(bits: int):
    return (F.shiftrightunsigned("h1", 64 - bits) if bits else F.lit(0)).cast("int")


def repeated_lines(docs: DataFrame, least: int) -> DataFrame:
    """``h1, h2, n, last`` of every long line found in two documents or more."""
    hashed = docs.mapInArrow(lambda b: _hash_rows(b, least), "h1 long, h2 long, doc_id long")
    counted = hashed.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("last"))
    return counted.filter("n > 1")


def index(lines: DataFrame) -> tuple[DataFrame, int]:
    """One row of arrays a shard, written to the shared folder, and the number of bits that name a shard."""
    lines = cut(lines)
    bits = max(0, math.ceil(math.log2(max(1, lines.count()) / SHARD_KEYS)))
    shards = lines.withColumn("shard", _shard_of(bits)).groupBy("shard").applyInArrow(_build, _SHARD)
    return cut(shards), bits


# --- documents ------------------------------------------------------------------------


class _Index:
    def __init__(self, rows: list, bits: int):
        self.shards, self.bits = {r[0]: Shard.read(*r[1:]) for r in rows}, bits

    def probe(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        counts, lasts = np.zeros(len(words), np.int64), np.full(len(words), _NO_ID)
        names = words[:, 0] >> _U(64 - self.bits) if self.bits else np.zeros(len(words), _U)
        order = np.argsort(names, kind="stable")
        for name, at in zip(*_runs(names[order], order), strict=True):
            if (shard := self.shards.get(name)) is not None:
                counts[at], lasts[at] = shard.probe(words[at, 0], words[at, 1])
        return counts, lasts


def _runs(names: np.ndarray, order: np.ndarray) -> tuple[list, list]:
    """Each value of the sorted ``names`` with its part of ``order``."""
    if not len(names):
        return [], []
    starts = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
    return names[starts].tolist(), np.split(order, starts[1:])


_KEPT = "doc_id long, text binary, n_lines long, n_dropped long"


def _emit(batch: pa.RecordBatch, dropped: list[set[int]], lines: list[list[bytes]]) -> pa.RecordBatch:
    texts = [
        b"\n".join(x for i, x in enumerate(own) if i not in gone) if gone else b"\n".join(own)
        for own, gone in zip(lines, dropped, strict=True)
    ]
    return pa.record_batch(
        [batch["doc_id"], pa.array(texts, pa.binary()), pa.array(map(len, lines), pa.int64()),
         pa.array(map(len, dropped), pa.int64())],
        names=["doc_id", "text", "n_lines", "n_dropped"],
    )


def _probing(batches: Iterator[pa.RecordBatch], sent, least: int, least_docs: int) -> Iterator[pa.RecordBatch]:
    known = _Index(*sent.value)
    for batch in batches:
        lines = [x.as_py().split(b"\n") for x in batch["text"]]
        found = [long_keys(own, least) for own in lines]
        owner = np.repeat(np.arange(len(lines)), list(map(len, found)))
        at = [i for own in found for i, _ in own]
        ids = batch["doc_id"].fill_null(_NO_ID).to_numpy()
        counts, lasts = known.probe(_hashes([key for own in found for _, key in own]))
        dropped: list[set[int]] = [set() for _ in lines]
        for hit in np.flatnonzero((counts >= least_docs) & (lasts != ids[owner])):
            dropped[owner[hit]].add(at[hit])
        yield _emit(batch, dropped, lines)


def _probe_here(docs: DataFrame, shards: DataFrame, bits: int, least: int, least_docs: int) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(([tuple(r) for r in shards.drop("load").collect()], bits))
    return docs.mapInArrow(lambda b: _probing(b, sent, least, least_docs), _KEPT)


# The way for arrays beyond the bound.


def _answer(probes: pa.Table, arrays: pa.Table, least_docs: int) -> pa.Table:
    h1, h2 = _words(probes, "h1", "h2")
    ids = probes["doc_id"].fill_null(_NO_ID).to_numpy()
    hit = np.zeros(len(h1), bool)
    if arrays.num_rows:
        shard = Shard.read(*[arrays[n][0].as_py() for n in _ARRAYS])
        counts, lasts = shard.probe(h1, h2)
        hit = (counts >= least_docs) & (lasts != ids)
    return probes.select(["doc_id", "h1", "h2"]).filter(pa.array(hit))


def _without(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lines = [x.as_py().split(b"\n") for x in batch["text"]]
        dropped: list[set[int]] = []
        for own, gone in zip(lines, batch["gone"].to_pylist(), strict=True):
            named = {(x["h1"], x["h2"]) for x in gone or ()}
            found = long_keys(own, least) if named else []
            words = _hashes([key for _, key in found]).view(np.int64)
            dropped.append({i for (i, _), word in zip(found, words.tolist(), strict=True) if tuple(word) in named})
        yield _emit(batch, dropped, lines)


def _probe_shards(docs: DataFrame, shards: DataFrame, bits: int, least: int, least_docs: int) -> DataFrame:
    n_copies = F.ceil(F.col("load") / COPY_PROBES)
    copies = broadcast_if_small(shards.select("shard", n_copies.alias("copies")), _SENT_SHARDS)
    hashed = docs.mapInArrow(lambda b: _hash_rows(b, least), "h1 long, h2 long, doc_id long").distinct()
    probes = (
        hashed.withColumn("shard", _shard_of(bits)).join(copies, "shard")
        .withColumn("copy", F.pmod(F.xxhash64("doc_id", "h2"), "copies"))
    )
    arrays = shards.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), n_copies - 1)))
    answered = probes.groupBy("shard", "copy").cogroup(arrays.groupBy("shard", "copy")).applyInArrow(
        lambda a, b: _answer(a, b, least_docs), "doc_id long, h1 long, h2 long"
    )
    gone = answered.groupBy(F.col("doc_id").alias("_of")).agg(F.collect_set(F.struct("h1", "h2")).alias("gone"))
    joined = docs.join(gone.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("_of")), "left").drop("_of")
    return joined.mapInArrow(lambda b: _without(b, least), _KEPT)


def drop_shared_lines(
    docs: DataFrame, least_chars: int = 40, least_docs: int = 5, most_bytes: int = MOST_BYTES
) -> DataFrame:
    """``doc_id, text, n_lines, n_dropped``: each document without its shared lines, lines counted before dropping."""
    if least_docs < 2 or least_chars < 1:
        raise ValueError("a shared line has a character and two documents at least")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    shards, bits = index(repeated_lines(texts, least_chars))
    size = reduce(add, [F.length(c) for c in _ARRAYS])
    small = (shards.agg(F.sum(size)).first()[0] or 0) <= most_bytes
    kept = (_probe_here if small else _probe_shards)(texts, shards, bits, least_chars, least_docs)
    return kept.withColumn("text", F.col("text").cast("string"))
