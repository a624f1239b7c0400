"""Packing documents into sequences of fixed capacity, first fit decreasing.

Documents are dealt to tasks by a hash and packed there in blocks of about ``BLOCK`` tokens, each
on its own: randomised groups, bounded whatever the data.  Every full capacity of a document is a
sequence of its own, which is where a decreasing order would put it.  The rests are placed in
order of decreasing length into the first sequence with room for them, which a tournament tree over the sequences' free
capacity finds in logarithmic time.  As documents may be cut, gaps that are left are then filled
with parts of the emptiest sequences, so that a block has at most one sequence that is not full.

Texts are shuffled once and encoded once.  A very long document is encoded slice by slice and
its full sequences leave memory at once; only its rest waits for the block.

Defined cases: a null or empty text is a document of its end mark alone; rows that share an identifier are
documents of their own; empty tables give no pieces; other columns of the input are not read.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, text_or_empty
from .words import Generations, loose_space, parts_of, slices_of, split

CAPACITY = 1024
BLOCK = 1 << 21
SLICE = 1 << 20
#: Bytes of the texts that go through one look-up.
JOINED_BYTES = 8 << 20
END = np.zeros(1, "<u4").tobytes()
#: Bits of a sequence number below the number of the task.
TASK_SHIFT = 40


class Encoder:
    """Identifiers of texts as little-endian unsigned 32-bit integers."""

    #: Unseen words encoded as one string.
    JOINED = 500

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        known = self.tokenizer.get_vocab()
        #: By identifier: does the token begin with a space?
        self.spaced = np.zeros(max(known.values()) + 1, bool)
        self.spaced[[i for token, i in known.items() if token.startswith("\u0120")]] = True
        self.first, self.later = Generations(self._encode, 100_000), Generations(self._later, 1_500_000)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4") for x in found]

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [x.tobytes() for x in self._ids(texts)]

    def _later(self, parts: list[str]) -> list[bytes]:
        """Parts after a space, encoded many at a time."""
        blocks = [parts[i : i + self.JOINED] for i in range(0, len(parts), self.JOINED)]
        joined = [" " + " ".join(b) for b in blocks]
        # A token that begins with a space begins the next part, if no part has other spaces or white space at an end.
        plain = [not loose_space(x) for x in joined]
        found = iter(self._ids([x for x, good in zip(joined, plain, strict=True) if good]))
        out: list[bytes] = []
        for block, good in zip(blocks, plain, strict=True):
            if good:
                ids = next(found)
                starts = np.flatnonzero(self.spaced[ids])
                if len(starts) == len(block) and starts[0] == 0:
                    raw, ends = ids.tobytes(), [*(4 * starts).tolist(), 4 * len(ids)]
                    out += [raw[a:b] for a, b in zip(ends, ends[1:], strict=False)]
                    continue
            out += self._encode([" " + x for x in block])
        return out

    def many(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Whole texts, through one look-up of their distinct parts."""
        parts = split(texts)
        at = parts.offsets.to_numpy()
        words = parts.values.dictionary_encode()
        codes, known = words.indices.to_numpy(), words.dictionary
        heads = self.first.of(known.take(pa.array(codes[at[:-1]])).to_pylist())
        codes = np.delete(codes, at[:-1])
        if not len(codes):
            return heads
        used = np.zeros(len(known), bool)
        used[codes] = True
        places = (np.cumsum(used) - 1)[codes]
        values = self.later.of(known.filter(pa.array(used)).to_pylist())
        found = pa.array(values, pa.large_binary()).take(pa.array(places))
        # Identifiers of all texts stand one after the other; a text's begin where its second part does.
        _, ends, raw = found.buffers()
        first = np.frombuffer(ends, np.int64, len(found) + 1)[at - np.arange(len(at))].tolist()
        return [head + raw[a:b].to_pybytes() for head, a, b in zip(heads, first, first[1:], strict=False)]

    def slices(self, text: str) -> Iterator[bytes]:
        """The same piece by piece, for a very long text."""
        for i, piece in enumerate(slices_of(text, SLICE)):
            yield self.many([piece])[0] if i == 0 else b"".join(self.later.of(parts_of(piece[1:])))

    def encode(self, text: str) -> bytes:
        return b"".join(self.slices(text))


@lru_cache(maxsize=1)
def encoder_of(path: str) -> Encoder:
    """One per process, so that the next task of a Python worker knows the words already."""
    return Encoder(path)


class Tournament:
    """Free capacity of up to ``n`` bins as a tree of maxima."""

    def __init__(self, n: int, capacity: int):
        self.leaves = 1 << max(0, (n - 1).bit_length())
        self.best = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> int:
        """Put an item into the first bin with room; its number."""
        best, i = self.best, 1
        while i < self.leaves:
            i *= 2
            if best[i] < size:
                i += 1
        found = i - self.leaves
        best[i] -= size
        while i > 1:
            i //= 2
            best[i] = max(best[2 * i], best[2 * i + 1])
        return found


def fill(sizes: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Bins of (item, start, length) for items of less than ``capacity``; all full but one."""
    tree = Tournament(len(sizes), capacity)
    bins: list[list[tuple[int, int, int]]] = []
    for item in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = tree.place(sizes[item])
        if at == len(bins):
            bins.append([])
        bins[at].append((item, 0, sizes[item]))
    free = [capacity - sum(x[2] for x in b) for b in bins]
    order = sorted(range(len(bins)), key=lambda i: free[i])
    low, high = 0, len(order) - 1
    while low < high:
        into, out = order[low], order[high]
        if not free[into]:
            low += 1
        elif not bins[out]:
            high -= 1
        else:
            item, start, length = bins[out].pop()
            part = min(length, free[into])
            # The tail goes, so that what is left of the item still begins where it did.
            bins[into].append((item, start + length - part, part))
            free[into] -= part
            free[out] += part
            if part < length:
                bins[out].append((item, start, length - part))
    return [b for b in bins if b]


def joined(batches: Iterable[pa.RecordBatch], most: int = JOINED_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes, so that the words they share are looked up once; larger ones stay."""
    held, size = [], 0
    for batch in batches:
        if held and size + batch.nbytes > most:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield pa.concat_batches(held)


SCHEMA = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """doc_id and SCHEMA, a row for each piece."""
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", text_or_empty().alias("_text"))
    kind = rows.schema["doc_id"].dataType
    rows = rows.repartition(F.xxhash64("doc_id", F.length("_text"), F.lit(7)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer_path)
        number = TaskContext.get().partitionId() << TASK_SHIFT
        out: list[tuple] = []  # document, start, length, crc, tokens, sequence, offset
        rests: list[tuple[object, int, bytes, int]] = []  # document, start, identifiers, tokens of the document
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal number, held
            for pieces in fill([len(r[2]) // 4 for r in rests], capacity):
                offset = 0
                for item, start, length in pieces:
                    doc, base, ids, tokens = rests[item]
                    crc = zlib.crc32(memoryview(ids)[4 * start : 4 * (start + length)])
                    out.append((doc, base + start, length, crc, tokens, number, offset))
                    offset += length
                number += 1
            columns = list(zip(*out, strict=True)) or [()] * 7
            arrays = [pa.array(columns[0], arrow_kind)] + [pa.array(c, pa.int64()) for c in columns[1:]]
            out.clear()
            rests.clear()
            held = 0
            return pa.RecordBatch.from_arrays(arrays, names)

        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        arrow_kind = pa.null()
        for batch in joined(batches):
            arrow_kind = batch.column("doc_id").type
            texts = batch.column("_text")
            whole = pc.less_equal(pc.utf8_length(texts), SLICE)
            short = iter(encoder.many(texts.filter(whole)))
            long = iter(texts.filter(pc.invert(whole)))
            for doc, at_once in zip(batch.column("doc_id").to_pylist(), whole.to_pylist(), strict=True):
                full, ids = [], b""
                for more in [next(short)] if at_once else encoder.slices(next(long).as_py()):
                    ids += more
                    n = len(ids) // 4 // capacity
                    for i in range(n):
                        full.append(zlib.crc32(memoryview(ids)[4 * capacity * i : 4 * capacity * (i + 1)]))
                    ids = ids[4 * capacity * n :]
                ids += END
                if len(ids) == 4 * capacity:
                    full.append(zlib.crc32(ids))
                    ids = b""
                tokens = len(full) * capacity + len(ids) // 4
                for i, crc in enumerate(full):
                    out.append((doc, i * capacity, capacity, crc, tokens, number, 0))
                    number += 1
                if ids:
                    rests.append((doc, len(full) * capacity, ids, tokens))
                    held += len(ids) // 4
                if held >= block or len(out) >= block // 64:
                    yield flush()
        if out or rests:
            yield flush()

    return rows.mapInArrow(run, f"doc_id {kind.simpleString()}, {SCHEMA}")
