"""Secret scans over an incremental ledger of blobs.

Every historical version of a path is named by the SHA-256 of its text, its blob.  The ledger
has a row for each blob and rule version that were ever scanned, with the spans found (none, too).
A scan takes the versions at hand, keeps the pairs of blob and rule version that the ledger
lacks, reads one version of each such blob, and joins the spans back to all paths that have the
blob.  A rule that changes gets a new version and is then the only one scanned again.

A kind is a regular expression with a minimum length; its matches are leftmost and do not
overlap, and one that is too short is dropped after it has consumed its text.  Positions are in
code points and come from the lengths of the texts between the matches.

Only digests and identifiers are shuffled to find one version of each blob; the texts to scan
meet that list by hash join, built from the list, so that texts are not sorted.  Copies of a hot
blob are combined before the shuffle, and the join back to paths is an equi-join that AQE splits.

Defined cases: a null text is an empty one and has no spans; rows alike in path and text share
one scan, and each gets its findings; empty tables and an empty ledger are valid; other columns of
the input are neither read nor changed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, cut, packed, text_or_empty

LEDGER = "blob string, rule string, version int, spans array<struct<start:int,end:int>>"


@dataclass(frozen=True)
class Rule:
    """A match counts if ``group`` of ``pattern`` has at least ``least`` characters."""

    name: str
    pattern: str
    #: A cheap test that every text with a match that counts passes.
    hint: str
    group: int = 0
    least: int = 1
    version: int = 1


RULES = (
    # A short value consumes its text, so its length is tested after matching.
    Rule(
        "assign",
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        r"""[:=]\x20*["']?[A-Za-z0-9+/_.=-]{8}""",
        group=1,
        least=8,
    ),
    # Here a match that is too short holds no longer one, so the length may stand in the pattern.
    Rule("access", r"AKIA[A-Z0-9]{12,}", r"AKIA[A-Z0-9]{12}"),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{32,}", r"(?<![0-9a-f])[0-9a-f]{32}"),
)


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER)


def versions_of(docs: DataFrame, path: str = "doc_id", text: str = "text") -> DataFrame:
    """path, blob of every version, written once to the shared folder."""
    return cut(docs.select(F.col(path).alias("path"), F.sha2(text_or_empty(text), 256).alias("blob")))


def unseen(versions: DataFrame, ledger: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """blob, path of one version, todo: names of the rules whose version the ledger lacks for it."""
    wanted = F.array(*[F.lit(f"{r.name}/{r.version}") for r in rules])
    seen = ledger.groupBy("blob").agg(F.collect_set(F.concat_ws("/", "rule", "version")).alias("_seen"))
    return (
        versions.groupBy("blob")
        .agg(F.min("path").alias("path"))
        .join(seen, "blob", "left")
        .select("blob", "path", F.array_except(wanted, F.coalesce("_seen", F.array().cast("array<string>"))).alias("todo"))
        .where(F.size("todo") > 0)
    )


def _matches(text: Column, rule: Rule) -> Column:
    """Gap before each match, its size and the size of the group that is judged."""
    pattern = F.lit(rule.pattern)
    return F.zip_with(
        F.split(text, rule.pattern),
        F.arrays_zip(
            F.regexp_extract_all(text, pattern, F.lit(0)).alias("m"),
            F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("g"),
        ),
        lambda gap, x: F.struct(
            F.length(gap).alias("gap"), F.length(x["m"]).alias("size"), F.length(x["g"]).alias("judged")
        ),
    )


def scan_unseen(docs: DataFrame, todo: DataFrame, rules: Sequence[Rule], path: str = "doc_id", text: str = "text") -> DataFrame:
    """New ledger rows: a row for each pair in ``todo``."""
    texts = docs.select(
        F.col(path).alias("_path"), text_or_empty(text).alias("_text"),
    ).withColumn("_blob", F.sha2("_text", 256))
    same = (F.col("_blob") == F.col("blob")) & F.col("_path").eqNullSafe(F.col("path"))
    chosen = texts.join(todo.hint("shuffle_hash"), same).select("blob", "todo", "_text")
    tried = F.array(
        *[
            F.when(
                F.array_contains("todo", f"{r.name}/{r.version}") & F.col("_text").rlike(r.hint),
                F.struct(
                    F.lit(r.name).alias("rule"), F.lit(r.version).alias("version"), F.lit(r.least).alias("least"),
                    _matches(F.col("_text"), r).alias("matches"),
                ),
            )
            for r in rules
        ]
    )
    placed = Window.partitionBy("blob", "rule", "version").orderBy("i")
    spans = (
        chosen.select("blob", F.explode_outer(tried).alias("t"))
        .where(F.col("t").isNotNull())
        .select("blob", "t.rule", "t.version", "t.least", F.posexplode("t.matches").alias("i", "m"))
        .where(F.col("m.size").isNotNull())  # what follows the last match
        .repartition("blob", "rule", "version")
        # Rows alike in path and text were scanned twice.
        .groupBy("blob", "rule", "version", "i", "least")
        .agg(F.max("m").alias("m"))
        .withColumn("end", F.sum(F.col("m.gap") + F.col("m.size")).over(placed).cast("int"))
        .where(F.col("m.judged") >= F.col("least"))
        .groupBy("blob", "rule", "version")
        .agg(F.sort_array(F.collect_list(F.struct((F.col("end") - F.col("m.size")).alias("start"), "end"))).alias("spans"))
    )
    pairs = todo.select("blob", F.explode("todo").alias("_pair")).select(
        "blob", F.substring_index("_pair", "/", 1).alias("rule"),
        F.substring_index("_pair", "/", -1).cast("int").alias("version"),
    )
    none = F.array().cast("array<struct<start:int,end:int>>")
    return pairs.join(spans, ["blob", "rule", "version"], "left").withColumn("spans", F.coalesce("spans", none))


def found_in(ledger: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """blob, found: array of (start, rank of the rule, end, rule) in order, for blobs that have any."""
    current = F.lit(False)
    rank = F.lit(len(rules))
    for i, r in enumerate(rules):
        is_rule = (F.col("rule") == r.name) & (F.col("version") == r.version)
        current, rank = current | is_rule, F.when(is_rule, F.lit(i)).otherwise(rank)
    return (
        ledger.where(current & (F.size("spans") > 0))
        .select("blob", "rule", rank.alias("rank"), F.explode("spans").alias("s"))
        .groupBy("blob")
        .agg(F.sort_array(F.collect_set(F.struct("s.start", "rank", "s.end", "rule"))).alias("found"))
    )


def scan(
    docs: DataFrame, ledger: DataFrame | None = None, rules: Sequence[Rule] = RULES, path: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Findings of every version (path, blob, found) and the rows to add to the ledger."""
    versions = versions_of(docs, path, text)
    old = empty_ledger(docs.sparkSession) if ledger is None else ledger
    new = cut(scan_unseen(docs, cut(unseen(versions, old, rules)), rules, path, text))
    found = found_in(new if ledger is None else old.unionByName(new), rules)
    none = F.array().cast("array<struct<start:int,rank:int,end:int,rule:string>>")
    return versions.join(found, "blob", "left").select("path", "blob", F.coalesce("found", none).alias("found")), new


def redact(docs: DataFrame, mark: str = "<SECRET>", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The documents with every secret replaced; texts without one, null ones too, stay as they are.

    Overlapping spans of several rules are united first.  Only blobs that have secrets are joined;
    if a count shows that they are few, texts are not shuffled.
    """
    versions = versions_of(docs)
    old = empty_ledger(docs.sparkSession)
    new = cut(scan_unseen(docs, cut(unseen(versions, old, rules)), rules))
    by_start = Window.partitionBy("blob").orderBy("start", "end")
    united = (
        found_in(new, rules)
        .select("blob", F.explode("found").alias("s"))
        .select("blob", "s.start", "s.end")
        .withColumn("_open", F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("_new", F.when(F.col("start") < F.col("_open"), 0).otherwise(1))
        .withColumn("_group", F.sum("_new").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("blob", "_group")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .groupBy("blob")
        .agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("_spans"))
    )
    united = cut(united.withColumnRenamed("blob", "_blob"))
    rows = packed(docs, ["text"]).select("row", "text", F.sha2(text_or_empty(), 256).alias("_digest"))
    rows = rows.join(broadcast_if_small(united, 200_000), F.col("_digest") == F.col("_blob"), "left")
    spans, text = F.col("_spans"), F.col("text")
    kept = F.transform(
        F.sequence(F.lit(0), F.size(spans)),
        lambda i: F.substr(
            text,
            F.coalesce(F.get(spans, i - 1)["end"], F.lit(0)) + 1,
            F.coalesce(F.get(spans, i)["start"], F.length(text)) - F.coalesce(F.get(spans, i - 1)["end"], F.lit(0)),
        ),
    )
    rows = rows.withColumn("_clean", F.when(spans.isNull(), text).otherwise(F.array_join(kept, mark)))
    return rows.select(*[(F.col("_clean") if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
