"""How far the word use of a source is from the other sources of its language, and by which words.

Method: a translate-table tokenizer.  ``bytes.translate`` lowers A-Z and blanks every separator in one pass,
``bytes.split`` cuts the terms, and a Counter per document gives occurrences and documents.  Tasks add up the
counters of a group before anything is shuffled; what follows is sparse: only terms that occur have a row.

* One exchange by (language, term) gives document frequency, language count and group counts together; it
  carries a row per term, group and task, so a very frequent term is as cheap as any.
* The distance of two sources is ``V * |a - b|`` of what an absent term weighs in each, corrected on the terms that
  occur.  Terms are dealt in blocks of about ``BLOCK_ROWS`` rows, sources in tiles of about ``TILE``; a block
  is a dense integer matrix in one task, so the pairs of sources are formed once a block and never once a term.
* All arithmetic is on integers; the shares are decimal divisions, exact at any count.

Defined results: null text, lang and source are empty strings, and the empty string is a language and a source
like others.  Every row counts as a document, also repeated ones.  A group without kept terms weighs every term alike; a
language without kept terms has pairs of value 0 and no ``term`` row; a language of one source has no pair.  An
empty table gives no row.  Very long texts are cut into terms slice by slice.  Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

LEAST_DOCS = 30
SMOOTHING = 5
SCALE = 1_000_000_000
TOP_TERMS = 50
BLOCK_ROWS = 100_000
LEAST_BLOCKS = 8
TILE = 256
_FLUSH = 300_000
_SLICE = 1 << 22
_WIDE = 512

#: Lowers A-Z, keeps a-z and every byte of characters beyond ASCII, blanks the rest.
TABLE = bytes(x if x > 0x7F else ord(chr(x).lower()) if chr(x).isalpha() else 0x20 for x in range(256))


def term_counts(text: bytes) -> Counter:
    """Occurrences of each term of a text, given in UTF-8."""
    plain = text.translate(TABLE)
    if len(plain) <= _SLICE:
        return Counter(plain.split())
    found, start = Counter(), 0
    while start < len(plain):
        stop = plain.find(b" ", start + _SLICE)
        stop = len(plain) if stop < 0 else stop
        found.update(plain[start:stop].split())
        start = stop
    return found


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0
    for batch in batches:
        langs, sources = batch["lang"].to_pylist(), batch["source"].to_pylist()
        for lang, source, text in zip(langs, sources, batch["text"], strict=True):
            n_docs, n = groups.setdefault((lang, source), (Counter(), Counter()))
            own, before = term_counts(text.as_py()), len(n)
            n.update(own)
            n_docs.update(own.keys())
            size += len(n) - before
            if size > _FLUSH:
                yield from _rows(groups)
                groups, size = {}, 0
    yield from _rows(groups)


def _rows(groups: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
    for (lang, source), (n_docs, n) in groups.items():
        yield pa.record_batch(
            [pa.array([lang] * len(n), pa.string()), pa.array([source] * len(n), pa.string()),
             pa.array(n.keys(), pa.binary()), pa.array([n_docs[t] for t in n], pa.int64()),
             pa.array(n.values(), pa.int64())],
            names=["lang", "source", "term", "n_docs", "n"],
        )


def kept_terms(docs: DataFrame, least_docs: int) -> DataFrame:
    """``lang, source, term, n, lang_n, first``: occurrences of the kept terms in each group that has them.

    ``first`` marks one row of each term of a language.
    """
    parts = docs.mapInArrow(_count, "lang string, source string, term binary, n_docs long, n long")
    whole = parts.repartition("lang", "term").groupBy("lang", "term", "source").agg(
        F.sum("n_docs").alias("n_docs"), F.sum("n").alias("n")
    )
    of_term = Window.partitionBy("lang", "term")
    return (
        whole.withColumns({
            "lang_docs": F.sum("n_docs").over(of_term),
            "lang_n": F.sum("n").over(of_term),
            "first": F.col("source") == F.min("source").over(of_term),
        })
        .filter(F.col("lang_docs") >= least_docs)
        .select("lang", "source", F.col("term").cast("string").alias("term"), "n", "lang_n", "first")
    )


def _share(count: str, total: str) -> Column:
    """1 plus the smoothed share of ``count`` in units of ``1 / SCALE``, rounded down."""
    return F.expr(
        f"1 + CAST({SCALE} AS DECIMAL(10, 0)) * CAST({count} + {SMOOTHING} AS DECIMAL(20, 0))"
        f" div CAST({total} + {SMOOTHING} * v AS DECIMAL(20, 0))"
    )


def _groups(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Every occurring group with its totals and those of its language."""
    groups = docs.select("lang", "source").distinct()
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    of_lang = kept.groupBy("lang").agg(
        F.sum("n").alias("lang_total"), F.count_if("first").alias("v"), F.count(F.lit(1)).alias("n_rows")
    )
    sources = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("n_sources"))
    joined = groups.join(own, ["lang", "source"], "left").join(of_lang.join(sources, "lang", "right"), "lang")
    filled = joined.fillna(0, ["total", "lang_total", "v", "n_rows"])
    return filled.withColumns({
        "absent": F.when(F.col("v") > 0, _share("0", "total")).otherwise(F.lit(0)),
        "n_blocks": F.greatest(F.lit(LEAST_BLOCKS), F.ceil(F.col("n_rows") / BLOCK_ROWS)).cast("int"),
        "n_tiles": F.ceil(F.col("n_sources") / TILE).cast("int"),
    })


def _dealt(rows: DataFrame) -> DataFrame:
    """Each row once for every pair of tiles that its source takes part in."""
    own = F.pmod(F.xxhash64("source"), "n_tiles").cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("n_tiles") - 1))
    return rows.withColumn("tile", own).withColumn("_other", other).withColumns({
        "low": F.least("tile", "_other"), "high": F.greatest("tile", "_other"),
    }).drop("_other")


def _distances(table: pa.Table) -> pa.Table:
    """Part of every pair's distance that the terms of one block make up."""
    lang, block = table["lang"][0].as_py(), table["block"][0].as_py()
    low, high = table["low"][0].as_py(), table["high"][0].as_py()
    heads = table.filter(pc.is_null(table["term"])).sort_by("source")
    names = heads["source"].to_pylist()
    tiles, absent = heads["tile"].to_numpy(), heads["absent"].to_numpy()
    v = heads["v"][0].as_py() if block == 0 else 0
    rows = table.filter(pc.is_valid(table["term"]))
    of_source = pc.index_in(rows["source"], heads["source"].combine_chunks()).to_numpy()
    of_term = rows["term"].combine_chunks().dictionary_encode().indices.to_numpy()
    shares = rows["share"].to_numpy()
    order = np.argsort(of_term, kind="stable")
    of_source, of_term, shares = of_source[order], of_term[order], shares[order]
    n_terms = int(of_term[-1]) + 1 if len(of_term) else 0
    sums = np.zeros((len(names), len(names)), np.int64)
    for start in range(0, n_terms, _WIDE):
        a, b = np.searchsorted(of_term, [start, start + _WIDE])
        wide = min(_WIDE, n_terms - start)
        matrix = np.repeat(absent[:, None], wide, axis=1)
        matrix[of_source[a:b], of_term[a:b] - start] = shares[a:b]
        for i in range(len(names) - 1):
            sums[i, i + 1 :] += np.abs(matrix[i] - matrix[i + 1 :]).sum(axis=1)
    left, right = np.triu_indices(len(names), 1)
    if low != high:
        across = tiles[left] != tiles[right]
        left, right = left[across], right[across]
    values = sums[left, right] + (v - n_terms) * np.abs(absent[left] - absent[right])
    names = pa.array(names, pa.string())
    return pa.table(
        [pa.array([lang] * len(left), pa.string()), names.take(pa.array(left)), names.take(pa.array(right)), pa.array(values)],
        names=["lang", "a", "b", "value"],
    )


def _pairs(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for every ordered pair of sources of a language."""
    columns = ("lang", "source", "n_tiles", "absent", "v", "block", "term", "share")
    of_block = F.pmod(F.xxhash64("term"), "n_blocks").cast("int")
    heads = groups.withColumns({
        "block": F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)),
        "term": F.lit(None).cast("string"), "share": F.lit(None).cast("long"),
    })
    dealt = _dealt(rows.withColumn("block", of_block).select(*columns).union(heads.select(*columns)))
    keys = ("lang", "block", "low", "high")
    parts = dealt.groupBy(*keys).applyInArrow(_distances, "lang string, a string, b string, value long")
    whole = parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                             F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    return whole.select("lang", both.alias("_p"), "value").select("lang", "_p.source", "_p.item", "value")


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank``: distances to the other sources, and the words a source overuses."""
    plain = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
    )
    kept = cut(kept_terms(plain, least_docs))
    groups = cut(_groups(plain, kept))
    rows = kept.join(groups, ["lang", "source"]).withColumns(
        {"share": _share("n", "total"), "lang_share": _share("lang_n", "lang_total")}
    )
    pairs = _pairs(rows, groups).withColumn("part", F.lit("pair"))
    over = rows.filter("share > lang_share").select(
        "lang", "source", F.col("term").alias("item"), (F.col("share") - F.col("lang_share")).alias("value"),
        F.lit("term").alias("part"),
    )
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    place = F.row_number().over(order)
    ranked = pairs.withColumn("rank", place).unionByName(over.withColumn("rank", place).filter(F.col("rank") <= top_terms))
    return ranked.select("lang", "source", "part", "item", "value", "rank")
