"""Benchmark decontamination as a prefix-filtered set join.

A window is 13 consecutive words of an item; a shorter item is one window.  The set of a window
is its shingles of up to five words.  For containment of a whole set one shingle is a
sufficient prefix if it is the rarest, so every window is filed under the shingle that the
corpus holds least often.  A document position with that shingle is a candidate if the window
fits between the start and the end of the document (length and positional bounds), and it is an
occurrence if all shingles of the window stand at their places, that is all its words.

Texts are split twice: once to count the shingles, once to meet the windows under their rarest
shingles.  A document's words are cut into overlapping pieces of a bounded number of words, and a
position takes its own piece along, so a candidate is verified where it is found, and only
occurrences leave the scan.  Neither positions nor candidates are written or shuffled, however
many documents hold a passage.  Documents' arrays of words are never shuffled.
The shingles (windows) are broadcast if a count shows at most ``BROADCAST_ROWS`` of them;
otherwise positions are joined by their key, each with the words that it is compared by.

Defined cases: null and wordless texts are clean with no words; items without words have no
window; equal windows of several items count for each of them; items that share an identifier are
one item; a null identifier of an item is written as an empty string; rows alike in identifier
and text share one result, and each of them is returned; empty tables give clean documents or no
rows; other columns of the input are neither read nor changed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, broadcast_if_small, cut, doc_key, packed, text_or_empty, unpacked

WINDOW = 13
SHINGLE = 5
#: Positions of a piece; with the words around them for any window it has at most 20 more.
PIECE = 64
#: Words before a position that a window filed under its shingle may need; what follows it is less than a window.
BEFORE = WINDOW - SHINGLE
#: A row of the broadcast table takes about 200 bytes.
BROADCAST_ROWS = 200_000
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def with_words(df: DataFrame, text: str = "_text") -> DataFrame:
    """Adds the words of a non-null text, A to Z lower-cased."""
    df = df.withColumn("_parts", F.split(ascii_lower(F.col(text)), SEPARATORS))
    parts, size = F.col("_parts"), F.size("_parts")
    # Separators at either end leave an empty part there, and nowhere else.
    before = (F.get(parts, F.lit(0)) == "").cast("int")
    after = (F.get(parts, size - 1) == "").cast("int")
    words = F.slice(parts, before + 1, F.greatest(size - before - after, F.lit(0)))
    return df.withColumn("_words", words).drop("_parts")


def shingles_of(items: DataFrame) -> DataFrame:
    """Shingles of the distinct windows: window (an identifier), whole (its words), items, size, k, at, words."""
    df = with_words(items.select("item_id", text_or_empty().alias("_text"))).where(F.size("_words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("_words") - (WINDOW - 1), F.lit(1)))
    pieces = F.transform(starts, lambda at: F.slice("_words", at, WINDOW))
    name = F.coalesce(F.col("item_id").cast("string"), F.lit(""))
    windows = (
        df.select(name.alias("item"), F.explode(F.array_distinct(pieces)).alias("words"))
        .groupBy("words")
        .agg(F.collect_set("item").alias("items"))
    )
    size = F.size("words")
    windows = windows.select("words", "items", size.alias("size"), F.least(size, F.lit(SHINGLE)).alias("k"))
    each = F.transform(
        F.sequence(F.lit(0), F.col("size") - F.col("k")),
        lambda at: F.struct(at.alias("at"), F.slice("words", at + 1, F.col("k")).alias("words")),
    )
    return windows.select(
        F.sha2(F.concat_ws(" ", "words"), 256).alias("window"), F.concat_ws(" ", "words").alias("whole"),
        "items", "size", "k", F.explode(each).alias("s"),
    ).select("window", "whole", "items", "size", "k", "s.at", F.concat_ws(" ", "s.words").alias("words"))


def _key(words: Column, at: Column, k: int) -> Column:
    return F.xxhash64(*[F.get(words, at + i) for i in range(k)])


def _keyed(shingles: DataFrame) -> DataFrame:
    """Adds the key that documents compute for the same words."""
    parts = F.split("words", " ")
    key = F.lit(None).cast("long")
    for k in range(1, SHINGLE + 1):
        key = F.when(F.col("k") == k, _key(parts, F.lit(0), k)).otherwise(key)
    return shingles.withColumn("key", key)


def _sizes(shingles: DataFrame) -> list[int]:
    return sorted(r.k for r in shingles.select("k").distinct().collect())  # at most SHINGLE values


def _positions(docs: DataFrame, sizes: list[int]) -> DataFrame:
    """A row per position and size of shingle: doc, n_words, at, first, k, key, and the piece ``_words`` that starts at ``base``.

    A wordless document has one position.  The outer generators keep the optimiser from copying the
    tokenisation into a filter below them.  Rows that a generator makes are copies of their piece,
    so pieces keep the work in proportion to the words of a document, however many it has.
    """
    df = with_words(docs.select("doc_id", text_or_empty().alias("_text")))
    df = df.select(doc_key(F.col("_text")).alias("doc"), F.size("_words").alias("n_words"), "_words")
    pieces = F.transform(
        F.sequence(F.lit(0), F.greatest(F.col("n_words") - 1, F.lit(0)), F.lit(PIECE)),
        lambda at: F.struct(
            at.alias("low"),
            F.greatest(at - BEFORE, F.lit(0)).alias("base"),
            F.slice("_words", F.greatest(at - BEFORE, F.lit(0)) + 1, BEFORE + PIECE + WINDOW - 1).alias("_words"),
        ),
    )
    df = df.select("doc", "n_words", F.explode_outer(pieces).alias("p")).select("doc", "n_words", "p.*")
    last = F.greatest(F.least(F.col("low") + PIECE, F.col("n_words")) - 1, F.col("low"))
    df = df.select("doc", "n_words", "base", "_words", F.explode_outer(F.sequence("low", last)).alias("at"))
    place = F.col("at") - F.col("base")
    if len(sizes) == 1:
        df = df.withColumn("k", F.lit(sizes[0])).withColumn("key", _key(F.col("_words"), place, sizes[0]))
    else:
        keys = F.array(*[F.struct(F.lit(k).alias("k"), _key(F.col("_words"), place, k).alias("key")) for k in sizes])
        df = df.select("doc", "n_words", "base", "_words", "at", F.explode_outer(keys).alias("s"))
        df = df.select("doc", "n_words", "base", "_words", "at", "s.k", "s.key")
    return df.withColumn("first", (F.col("at") == 0) & (F.col("k") == sizes[0]))


def _meet(positions: DataFrame, known: DataFrame, start: Column, size: Column, how: str) -> tuple[DataFrame, Column]:
    """Positions joined with the rows of ``known`` (_k, _key) and, beside them, the ``size`` words from ``start`` on.

    These are compared by the caller: the words decide, not their hash.
    """
    same = (F.col("key") == F.col("_key")) & (F.col("k") == F.col("_k"))
    if known.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        joined, words, base = positions.join(F.broadcast(known), same, how), F.col("_words"), F.col("base")
    else:  # positions meet their keys by a shuffle, which takes the words around a position and no other
        base = F.greatest(F.col("at") - BEFORE, F.lit(0))
        here = F.slice("_words", base - F.col("base") + 1, F.col("at") - base + WINDOW)
        positions = positions.withColumn("_here", F.concat_ws(" ", here)).drop("_words", "base")
        joined, words = positions.join(known.hint("shuffle_hash"), same, how), F.split("_here", " ")
    return joined, F.concat_ws(" ", F.slice(words, F.greatest(start - base, F.lit(0)) + 1, size))


def _counts(docs: DataFrame, shingles: DataFrame) -> DataFrame:
    """words, count: how often each shingle that occurs does so, over all rows of documents."""
    sizes = _sizes(shingles)
    known = shingles.select(F.col("k").alias("_k"), F.col("key").alias("_key"), "words").distinct()
    if not sizes:
        return known.select("words", F.lit(0).cast("long").alias("count"))
    joined, here = _meet(_positions(docs, sizes), known, F.col("at"), F.col("k"), "inner")
    fits = F.col("at") + F.col("k") <= F.col("n_words")
    # As a case it is asked of positions that have met their key only; an equality would become a key of the join.
    return joined.where(F.when(fits, here == F.col("words")).otherwise(False)).groupBy("words").count()


def _matches(docs: DataFrame, shingles: DataFrame) -> DataFrame:
    """Rows of doc, n_words, start, size, items: one at least per document, one per window that stands in it.

    A window is looked for under the shingles that ``shingles`` has of it.  Without a window start, size and items are null.
    """
    sizes = _sizes(shingles)
    known = shingles.select(
        F.col("k").alias("_k"), F.col("key").alias("_key"), F.col("at").alias("_offset"),
        F.col("size").alias("_size"), F.col("whole").alias("_whole"), F.col("items").alias("_items"),
    )
    if not sizes:
        df = with_words(docs.select("doc_id", text_or_empty().alias("_text")))
        df = df.select(doc_key(F.col("_text")).alias("doc"), F.size("_words").alias("n_words"))
        none = shingles.schema["items"].dataType
        return df.select("doc", "n_words", F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("size"),
                         F.lit(None).cast(none).alias("items"))
    start = F.col("at") - F.col("_offset")
    joined, here = _meet(_positions(docs, sizes), known, start, F.col("_size"), "left")
    fits = F.col("_key").isNotNull() & (start >= 0) & (start + F.col("_size") <= F.col("n_words"))
    found = fits & (here == F.col("_whole"))
    return joined.select(
        "doc", "n_words", "first", F.when(found, start).alias("start"), F.when(found, F.col("_size")).alias("size"),
        F.when(found, F.col("_items")).alias("items"),
    ).where(F.col("first") | F.col("start").isNotNull()).drop("first")


def _covered(hits: Column) -> Column:
    """Number of positions in the union of (start, size) intervals."""
    return F.aggregate(
        F.sort_array(hits),
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda acc, x: F.struct(
            F.greatest(acc["end"], x["start"] + x["size"]).alias("end"),
            (
                acc["n"] + F.greatest(F.lit(0), x["start"] + x["size"] - F.greatest(acc["end"], x["start"]))
            ).alias("n"),
        ),
        lambda acc: acc["n"],
    )


def results(docs: DataFrame, items: DataFrame) -> DataFrame:
    """A row per distinct document: doc, n_words, n_hit, n_items, items_sha256."""
    shingles = _keyed(cut(shingles_of(items)))
    # A window with a shingle that occurs nowhere cannot occur.
    rarest = (
        shingles.join(_counts(docs, shingles), "words", "left")
        .groupBy("window", "whole", "items", "size", "k")
        .agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("count"), "words", "at", "key")).alias("p"))
        .where("p.count > 0")
    )
    prefix = cut(rarest.select("whole", "items", "size", "k", "p.words", "p.at", "p.key"))
    # Equal lists of items get a number, which stands for them until a document's windows are known.
    names = cut(prefix.select("items").distinct().select(F.monotonically_increasing_id().alias("set"), "items"))
    numbered = prefix.join(names, "items").drop("items").withColumnRenamed("set", "items")
    return (
        _matches(docs, numbered)
        .groupBy("doc")
        .agg(
            F.max("n_words").cast("long").alias("n_words"),
            F.collect_set(F.when(F.col("start").isNotNull(), F.struct("start", "size"))).alias("_hits"),
            F.collect_set("items").alias("_sets"),
        )
        .select("doc", "n_words", _covered(F.col("_hits")).cast("long").alias("n_hit"), F.explode_outer("_sets").alias("set"))
        .join(broadcast_if_small(names, BROADCAST_ROWS), "set", "left")
        .groupBy("doc", "n_words", "n_hit")
        .agg(F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("_names"))
        .select(
            "doc", "n_words", "n_hit", F.size("_names").cast("long").alias("n_items"),
            F.sha2(F.concat_ws(",", "_names"), 256).alias("items_sha256"),
        )
    )


def contaminated() -> Column:
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated; a row for each document row."""
    rows = docs.select(doc_key(text_or_empty()).alias("doc"))
    return rows.join(results(docs, items), "doc").select(
        F.col("doc.id").alias("doc_id"), "n_words", "n_hit", "n_items", "items_sha256",
        contaminated().alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The clean documents, with their own columns.

    The contaminated are removed by an anti join on identifier and text digest; where a count
    shows that they are few, the texts stay where they are.
    """
    bad = cut(results(docs, items).where(contaminated()).select("doc"))
    rows = packed(docs, ["doc_id", "text"]).select("row", doc_key(text_or_empty()).alias("doc"))
    return unpacked(rows.join(broadcast_if_small(bad, 300_000), "doc", "left_anti"), docs.columns)
