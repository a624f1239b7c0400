"""Quality rules whose cutoffs carry a guarantee.

A rule rejects a document when one of its ratios is above a cutoff.  How strict the cutoff may
be is decided on labelled holdouts: a cutoff is certified for a stratum if the exact binomial
test shows that it rejects at most a share ``alpha / rules`` of the good documents there.  Each
stratum and rule gets an equal part of the error probability ``delta`` (Bonferroni), and the
cutoffs of one rule are tested from the loosest to the strictest until one fails (fixed
sequence), which needs no further correction.  Over all rules a stratum then loses at most
``alpha`` of its good documents, in every stratum at once, with probability ``1 - delta``.

Everything is a DataFrame expression; the only tables joined to documents have one row per
stratum, of which there are as many as length bands.

Defined cases: a null text has no words and fails the base rule; empty tables give empty
results; with too few labels nothing is certified and the base rule decides alone; labels that
repeat a document count once if they agree and not at all if they differ; repeated rows are
judged one by one; other columns of the input are neither read nor changed.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_RUN, SPACES, broadcast_if_small, cut, fold, packed, text_or_empty, unpacked

SYMBOLS = "#*$%&|<>"
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class RuleConfig:
    """alpha: share of good documents a stratum may lose; delta: chance that any bound is wrong."""

    alpha: float = 0.02
    delta: float = 0.05
    #: Lower ends of the strata, in words.
    bands: tuple[int, ...] = (0, 100, 200, 500, 2000)
    #: Cutoffs of each ratio, from the loosest to the strictest.
    cutoffs: dict[str, tuple[float, ...]] = field(
        default_factory=lambda: {
            "symbol_ratio": (0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.07, 0.05),
            "dup_line_ratio": (0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2),
            "repeat_ratio": (0.45, 0.4, 0.35, 0.3, 0.25, 0.2),
            "word_length": (40.0, 30.0, 25.0, 20.0, 16.0, 14.0, 12.0),
        }
    )


def _with_words(df: DataFrame, text: str) -> DataFrame:
    trimmed = F.btrim(F.col(text), F.lit(SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))
    return df.withColumn("_words", words)


def _windows(of) -> Column:
    """One value for each three-word window, from its words."""
    words = F.col("_words")
    return F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))),
        lambda first, i: of(first, F.get(words, i + 1), F.get(words, i + 2)),
    )


def add_features(df: DataFrame, text: str = "_text") -> DataFrame:
    """The five counts of FEATURES and ``_n_lines``, from a non-null text column."""
    whole = F.col(text)
    size = F.size("_words")
    lines = F.filter(F.split(whole, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    df = _with_words(df, text)
    df = df.select(
        "*",
        size.cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(whole, "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        lines.alias("_lines"),
        # Hashes that all differ prove that no window repeats; only other texts are sorted.
        _windows(lambda a, b, c: F.xxhash64(a, b, c)).alias("_hashes"),
    )
    df = df.select(
        "*",
        F.size("_lines").cast("long").alias("_n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        (F.size(F.array_distinct("_hashes")) < F.size("_hashes")).alias("_repeats"),
    )
    numbered = F.transform(F.col("_hashes"), lambda h, i: F.struct(h.alias("h"), i.alias("at")))
    df = df.withColumn("_sorted", F.when(F.col("_repeats"), F.sort_array(numbered)))
    words, ordered = F.col("_words"), F.col("_sorted")

    def same(x: Column, y: Column) -> Column:
        """Equal hashes are only a candidate; the words decide."""
        equal = x["h"] == y["h"]
        for k in range(3):
            equal = equal & (F.get(words, x["at"] + k) == F.get(words, y["at"] + k))
        return F.coalesce(equal, F.lit(False))

    found = F.filter(
        ordered, lambda x, i: same(x, F.get(ordered, i - 1)) | same(x, F.get(ordered, i + 1))
    )
    starts = F.sort_array(F.transform(found, lambda x: x["at"]))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda acc, at: F.struct(
            (at + 3).alias("end"), (acc["n"] + at + 3 - F.greatest(acc["end"], at)).alias("n")
        ),
        lambda acc: acc["n"],
    )
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop(
        "_words", "_lines", "_hashes", "_sorted", "_repeats"
    )


def ratios() -> dict[str, Column]:
    n = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "symbol_ratio": F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1)),
        "dup_line_ratio": F.col("n_dup_lines") / F.greatest(F.col("_n_lines"), F.lit(1)),
        "repeat_ratio": F.col("n_repeat_words") / n,
        "word_length": F.col("word_chars") / n,
    }


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def stratum(cfg: RuleConfig) -> Column:
    """Number of the length band, from 0."""
    return sum((F.col("n_words") >= F.lit(low)).cast("int") for low in cfg.bands[1:]) + F.lit(0)


def binomial_cdf(n: Column, k: Column, p: float) -> Column:
    """P(Binomial(n, p) <= k), summed term by term with logarithms so that large n do not underflow."""
    odds = F.lit(p / (1 - p))
    start = n * F.log1p(F.lit(-p))
    return F.aggregate(
        F.sequence(F.lit(0).cast("long"), k),
        F.struct(start.alias("term"), F.lit(float("-inf")).alias("sum")),
        lambda acc, i: F.struct(
            (acc["term"] + F.log((n - i) / (i + 1) * odds + F.lit(1e-300))).alias("term"),
            (
                F.greatest(acc["sum"], acc["term"])
                + F.log1p(F.exp(F.least(acc["sum"], acc["term"]) - F.greatest(acc["sum"], acc["term"])))
            ).alias("sum"),
        ),
        lambda acc: F.exp(acc["sum"]),
    )


def good_documents(labels: DataFrame) -> DataFrame:
    """Identifiers of the documents outside fold 0 that are labelled good, and never bad."""
    return (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 0))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("_low"), F.max("quality").alias("_high"))
        .where((F.col("_low") == 1) & (F.col("_high") == 1))
        .select("doc_id")
    )


def certify(features: DataFrame, labels: DataFrame, cfg: RuleConfig = RuleConfig()) -> DataFrame:
    """One row per stratum and rule with a certified cutoff: stratum, rule, cutoff, n_good, n_rejected.

    ``features`` has doc_id, FEATURES and _n_lines.  Only good documents that pass the base rule
    and lie outside fold 0 are evidence.
    """
    good = good_documents(labels)
    values = ratios()
    counts = [F.count(F.lit(1)).alias("n")]
    for rule, cutoffs in cfg.cutoffs.items():
        counts += [F.count_if(values[rule] > F.lit(c)).alias(f"{rule}_{i}") for i, c in enumerate(cutoffs)]
    seen = features.where(~base_failed()).join(good, "doc_id").groupBy(stratum(cfg).alias("stratum")).agg(*counts)
    tests = F.array(
        *[
            F.struct(
                F.lit(rule).alias("rule"), F.lit(i).alias("step"), F.lit(float(c)).alias("cutoff"),
                F.col(f"{rule}_{i}").alias("k"),
            )
            for rule, cutoffs in cfg.cutoffs.items()
            for i, c in enumerate(cutoffs)
        ]
    )
    each_rule = cfg.alpha / len(cfg.cutoffs)
    each_test = cfg.delta / (len(cfg.cutoffs) * len(cfg.bands))
    tried = seen.select("stratum", "n", F.explode(tests).alias("t")).select("stratum", "n", "t.*")
    # A count above the allowed share cannot pass, so the sum is not needed there.
    passed = F.when(
        F.col("k") <= F.col("n") * each_rule, binomial_cdf(F.col("n"), F.col("k"), each_rule) <= each_test
    ).otherwise(F.lit(False))
    tried = tried.withColumn("passed", passed)
    last = tried.groupBy("stratum", "rule").agg(
        F.min(F.when(~F.col("passed"), F.col("step"))).alias("_failed"),
        F.collect_list(F.struct("step", "cutoff", "n", "k")).alias("_steps"),
    )
    before = F.col("_failed").isNull() | (F.col("s.step") < F.col("_failed"))
    return (
        last.select("stratum", "rule", "_failed", F.explode("_steps").alias("s"))
        .where(before)
        .groupBy("stratum", "rule")
        .agg(
            F.min("s.cutoff").alias("cutoff"),
            F.max("s.n").alias("n_good"),
            F.max_by("s.k", "s.step").alias("n_rejected"),
        )
    )


def verdicts(df: DataFrame, certified: DataFrame, cfg: RuleConfig = RuleConfig()) -> DataFrame:
    """Adds base_failed, rejected_by (names of the rules) and kept to a table with features."""
    rules = list(cfg.cutoffs)
    wide = certified.groupBy("stratum").agg(
        *[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"_cut_{r}") for r in rules]
    )
    values = ratios()
    df = df.withColumn("_stratum", stratum(cfg)).join(
        F.broadcast(wide.withColumnRenamed("stratum", "_stratum")), "_stratum", "left"  # a row per band
    )
    broken = F.filter(
        F.array(*[F.when(values[r] > F.col(f"_cut_{r}"), F.lit(r)) for r in rules]), lambda x: x.isNotNull()
    )
    # One test of both: a separate one on the base rule would be pushed below the join, and the
    # optimiser would copy every expression the counts are made of into that filter.
    reasons = F.concat(F.when(base_failed(), F.array(F.lit("base"))).otherwise(F.array().cast("array<string>")), F.col("rejected_by"))
    return (
        df.withColumn("base_failed", base_failed())
        .withColumn("rejected_by", broken)
        .withColumn("kept", F.size(reasons) == 0)
        .drop("_stratum", *[f"_cut_{r}" for r in rules])
    )


def judge(docs: DataFrame, labels: DataFrame, cfg: RuleConfig = RuleConfig()) -> DataFrame:
    """doc_id, FEATURES, base_failed, kept and rejected_by, a row for each document row.

    The counts of every document are written once to the shared folder, as both the
    certification and the verdicts read them; no text is shuffled.
    """
    features = cut(
        add_features(docs.select("doc_id", text_or_empty().alias("_text"))).select("doc_id", *FEATURES, "_n_lines")
    )
    return verdicts(features, certify(features, labels, cfg), cfg).select(
        "doc_id", *FEATURES, "base_failed", "kept", "rejected_by"
    )


def keep_good(docs: DataFrame, labels: DataFrame, cfg: RuleConfig = RuleConfig()) -> DataFrame:
    """The documents that are kept, with their own columns.

    Counts for the certification are computed on labelled documents only, and those for the
    verdicts where the text lies, so that no text is shuffled.
    """
    evidence = docs.select("doc_id", text_or_empty().alias("_text")).join(
        broadcast_if_small(good_documents(labels), 300_000), "doc_id", "left_semi"
    )
    certified = cut(certify(cut(add_features(evidence).select("doc_id", *FEATURES, "_n_lines")), labels, cfg))
    rows = packed(docs, ["text"]).select("row", text_or_empty().alias("_text"))
    judged = verdicts(add_features(rows), certified, cfg)
    return unpacked(judged.where("kept"), docs.columns)
