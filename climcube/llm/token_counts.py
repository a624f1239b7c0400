"""Token counts of whole texts, with overlap resynchronisation for huge ones.

A huge text is encoded in overlapping chunks with offsets.  Two neighbouring chunks are spliced at a
position in their overlap at which both have a token boundary that is proven stable: no piece of the
vocabulary holds the two characters on its sides next to each other, so no merge can ever span it,
whatever stands further left or right.  The tokens on either side are then those of the whole
text.  If an overlap has no such position, it is widened, in the end up to whole texts.

Other texts are a single chunk, counted through the memory of ``words``, whose cuts are such
positions, too.

Nothing is shuffled.  Defined cases: null and empty texts have no bytes and no tokens; rows that
repeat are counted each; empty tables give no rows; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, text_or_empty
from .words import Memo, parts_of

CHUNK = 32_768
OVERLAP = 256
#: The vocabulary writes a space like this.
SPACE = "▁"


class Counter:
    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.chunk, self.overlap = chunk, overlap
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size()) if not self.model.is_byte(i)]
        self.inside = {p[i : i + 2] for p in pieces for i in range(len(p) - 1)}
        # A space must never follow another character inside a piece for words to be cut apart.
        self.by_words = not any(pair[1] == SPACE and pair[0] != SPACE for pair in self.inside)
        self.memo = Memo(lambda xs: [len(x) for x in self.model.encode(xs, num_threads=1)])

    def starts(self, text: str) -> list[int]:
        """Where the tokens of a chunk begin, in characters; a token of bytes begins with its character."""
        return [at for at, _ in self.model.encode(text, return_type="offset_mapping", return_bytes=False)["offsets"]]

    def stable(self, text: str, at: int) -> bool:
        return text[at - 1 : at + 1].replace(" ", SPACE) not in self.inside

    def spliced(self, text: str) -> int:
        """Tokens of a text of any length, from overlapping chunks."""
        total = begin = since = 0  # start of the chunk, and of what is not yet counted
        size = self.chunk
        here = self.starts(text[:size])
        while begin + size < len(text):
            end, overlap = begin + size, self.overlap
            while True:
                overlap = min(overlap, end - since)
                after = end - overlap
                there = self.starts(text[after : after + size])
                common = {begin + x for x in here} & {after + x for x in there}
                good = [x for x in common if max(since, after) < x < end and self.stable(text, x)]
                if good or overlap == end - since:
                    break
                overlap *= 2
            if not good:  # not even the whole chunk has a boundary: make it longer
                size *= 2
                here = self.starts(text[begin : begin + size])
                continue
            middle = after + overlap // 2
            splice = min(good, key=lambda x: (abs(x - middle), x))
            total += sum(since <= begin + x < splice for x in here)
            begin, since = after, splice
            if size > self.chunk:
                size = self.chunk
                there = self.starts(text[begin : begin + size])
            here = there
        return total + sum(begin + x >= since for x in here)

    def many(self, texts: list[str]) -> list[int]:
        """Counts of whole texts; those of a single chunk go through one look-up."""
        if not self.by_words:
            return [self.spliced(t) for t in texts]
        parts = [parts_of(t.replace(SPACE, " ")) if len(t) <= self.chunk else [] for t in texts]
        found, out, at = self.memo.of([x for p in parts for x in p]), [], 0
        for text, p in zip(texts, parts, strict=True):
            out.append(sum(found[at : at + len(p)]) if p else self.spliced(text))
            at += len(p)
        return out

    def count(self, text: str) -> int:
        return self.many([text])[0]


@lru_cache(maxsize=1)
def counter_of(path: str) -> Counter:
    """One per process, so that the next task of a Python worker knows the words already."""
    return Counter(path)


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit; a row for each document row."""
    small_batches(docs.sparkSession)
    rows = docs.select(
        "doc_id", F.octet_length(text_or_empty()).cast("long").alias("n_bytes"), text_or_empty().alias("_text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(model_path)
        for batch in batches:
            counts = pa.array(counter.many(batch.column("_text").to_pylist()), pa.int64())
            columns = [batch.column("doc_id"), batch.column("n_bytes"), counts]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    counted = rows.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
