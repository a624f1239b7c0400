"""Toxicity by two class-conditional Kneser-Ney models with shared backoff.

A word's estimate in a class is interpolated Kneser-Ney with the class as its context,

    P_c(w) = (max(n_c(w) - D, 0) + D T_c P(w) b_c(w)) / N_c

where ``P(w)`` comes from continuation counts, that is in how many classes the word stands, so that a word
of one class keeps little of its frequency in the other one, and rare words, which both estimates mostly
owe to the shared part, weigh next to nothing.  ``b_t + b_o = 2`` deals that part out as character models of the
classes see the word: ``log(b_t / b_o)`` is their difference per position, so that inflected and unseen forms share what
their stems have in common.  The unit of these is the character n-gram inside a word; both classes have interpolated
Kneser-Ney estimates

    P_c(u | h) = (max(n_c(hu) - D, 0) + D T_c(h) P(u | h')) / n_c(h)

whose lower orders ``P(u | h')`` come from continuation counts over both classes together.  Counts
are documents that hold the word, so that one document's repetitions count once.

A position of a word is judged by the longest context that the labelled documents hold: by the log of
the ratio of both estimates, also where a character never followed the context, and without a least
count or a test of certainty.

Most words of a toxic text are ordinary.  So the toxic likelihood of a word is ``(1 - e) P_o + e P_t`` with a small
share ``e``.  A text's raw score is the difference of the two log-likelihoods per word, and a logistic curve fitted on labelled documents outside the counts turns it into a probability.

Counting, all probabilities and scoring are aggregations and joins; the tables of the model stay distributed.  They
are joined to the distinct windows of characters of the distinct words, and the scores of words to the
words of the texts.  In both joins the most frequent keys, at most ``MOST_SENT`` whatever the input, are sent to
every task; what they give is added up where the text is, and only the other keys are shuffled, once
a text with their count.  Only a bounded calibration sample reaches the driver, and the n-grams on which the classes differ
for certain if ``entries`` is asked for; scoring does not use them.

Defined cases: null, empty and wordless texts have raw score zero and get the curve's value there;
documents with contradicting labels teach nothing; without labels of both classes every text gets
the share of toxic labels; rows that repeat are scored each; a null identifier is not held out;
other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, cut, fold, text_or_empty

#: What stands between words, which are runs of letters and digits.
SEPARATOR = r"[^\p{L}\p{N}]+"
#: So many scores, those of the most frequent words or windows, are sent to every task; the others are shuffled.
MOST_SENT = 500_000


@dataclass(frozen=True)
class ToxicityConfig:
    order: int = 5
    discount: float = 0.75
    least_g2: float = 16.0
    least_log_ratio: float = 1.0
    #: Most n-grams listed to read; scoring uses all.
    max_entries: int = 200_000
    #: Most labelled documents in the calibration sample.
    calibration_rows: int = 20_000
    #: Share of a toxic text's words that come from the toxic model.
    toxic_share: float = 0.003
    #: Added to the number of words, so that single words do not decide.
    extra_words: float = 10.0
    #: Folds (crc32 of the identifier modulo 5) for counts and for the calibration; fold 0 is held out.
    count_folds: tuple[int, ...] = (1, 2, 3)
    calibration_fold: int = 4


@dataclass(frozen=True)
class ToxicityModel:
    #: gram, ratio, g2 of the n-grams on which the classes differ for certain.
    certain: DataFrame
    #: h, unseen, seen: log ratio after the context for characters that never follow it, and by character.
    contexts: DataFrame
    #: word, t, o: labelled documents of each class that hold it.
    words: DataFrame
    #: The classes' numbers of distinct words and sums of their counts, toxic first.
    kinds: tuple[float, float]
    sizes: tuple[float, float]
    discount: float
    toxic_share: float
    order: int
    extra_words: float
    slope: float = 1.0
    offset: float = 0.0
    max_entries: int = ToxicityConfig.max_entries

    @property
    def entries(self) -> dict[str, float]:
        """To read: the most certain n-grams with their log ratios, fetched when asked for."""
        best = self.certain.orderBy(F.desc("g2"), "gram").limit(self.max_entries)
        return {r.gram: r.ratio for r in best.collect()}


def agreed_labels(labels: DataFrame, column: str) -> DataFrame:
    """doc_id, label, fold of documents outside fold 0 whose labels agree."""
    return (
        labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min(column).alias("label"), F.max(column).alias("_high"))
        .where(F.col("label") == F.col("_high"))
        .select("doc_id", F.col("label").cast("double").alias("label"), fold(F.col("doc_id")).alias("fold"))
        .where("fold != 0")
    )


def labelled(docs: DataFrame, agreed: DataFrame) -> DataFrame:
    """doc_id, label, fold, _text of the labelled documents."""
    rows = docs.select("doc_id", text_or_empty().alias("_text"))
    return rows.join(broadcast_if_small(agreed, 300_000), "doc_id")


def bounded_sample(agreed: DataFrame, rows: int) -> DataFrame:
    """At most so many labels, by a hash of the identifier."""
    return agreed.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def _word_counts(train: DataFrame) -> DataFrame:
    """word, t, o: documents of the toxic and the ordinary class that hold it."""
    words = F.array_distinct(F.split(F.lower("_text"), SEPARATOR))
    return (
        train.select("label", F.explode_outer(words).alias("word"))
        .where("word != ''")
        .groupBy("word")
        .agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("o"))
    )


def _grams(train: DataFrame, order: int) -> DataFrame:
    """gram, t, o: documents' words of the toxic and the ordinary class that hold it; ^ and $ are word ends."""
    return _grams_of(_word_counts(train), order)


def _grams_of(words: DataFrame, order: int) -> DataFrame:
    words = words.select(F.concat(F.lit("^"), "word", F.lit("$")).alias("_s"), "t", "o")
    size = F.length("_s")
    each = F.flatten(
        F.transform(
            F.sequence(F.lit(1), size),
            lambda i: F.transform(
                F.sequence(F.lit(1), F.least(F.lit(order), size - i + 1)), lambda k: F.substr(F.col("_s"), i, k)
            ),
        )
    )
    return words.select("t", "o", F.explode(each).alias("gram")).groupBy("gram").agg(F.sum("t").alias("t"), F.sum("o").alias("o"))


def _context(gram: Column) -> Column:
    return F.substr(gram, F.lit(1), F.length(gram) - 1)


def _suffix(gram: Column) -> Column:
    return F.substr(gram, F.lit(2), F.length(gram))


def _shared(grams: DataFrame, cfg: ToxicityConfig) -> DataFrame:
    """low, p: Kneser-Ney probability of the n-gram's last character from continuation counts."""
    gram = F.col("gram")
    continued = grams.where(F.length(gram) > 1).groupBy(_suffix(gram).alias("low")).agg(F.count(F.lit(1)).alias("n"))
    low = F.col("low")
    contexts = continued.groupBy(_context(low).alias("h")).agg(F.sum("n").alias("z"), F.count(F.lit(1)).alias("kinds"))
    continued = continued.withColumn("h", _context(low)).join(contexts, "h")
    below = out = None
    for k in range(1, cfg.order):
        level = continued.where(F.length(low) == k)
        if below is None:
            level = level.withColumn("_p", 1 / F.greatest(F.col("kinds"), F.lit(1)))
        else:
            level = level.join(below.select(F.col("low").alias("_low"), F.col("p").alias("_p")), _suffix(low) == F.col("_low"))
        p = (F.greatest(F.col("n") - cfg.discount, F.lit(0.0)) + cfg.discount * F.col("kinds") * F.col("_p")) / F.col("z")
        below = cut(level.select("low", p.alias("p")))
        out = below if out is None else out.union(below)
    return out


def _ratios(grams: DataFrame, cfg: ToxicityConfig) -> DataFrame:
    """gram, h, ratio, unseen, g2: of every n-gram, the log ratio in its context, and that of what never follows the context."""
    gram = F.col("gram")
    longer = grams.where((F.length(gram) > 1)).withColumn("h", _context(gram))
    contexts = longer.groupBy("h").agg(
        F.sum("t").alias("zt"), F.sum("o").alias("zo"),
        F.count_if(F.col("t") > 0).alias("kt"), F.count_if(F.col("o") > 0).alias("ko"),
    )
    rows = longer.join(contexts, "h")
    share = (F.col("t") + F.col("o")) / (F.col("zt") + F.col("zo"))

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    g2 = 2 * (
        part(F.col("t"), F.col("zt") * share)
        + part(F.col("o"), F.col("zo") * share)
        + part(F.col("zt") - F.col("t"), F.col("zt") * (1 - share))
        + part(F.col("zo") - F.col("o"), F.col("zo") * (1 - share))
    )
    rows = rows.withColumn("g2", g2).join(_shared(grams, cfg), _suffix(gram) == F.col("low"))

    def left(z: str, kinds: str) -> Column:
        return F.when(F.col(z) > 0, cfg.discount * F.col(kinds) / F.col(z)).otherwise(1.0)

    def estimate(n: str, z: str, kinds: str) -> Column:
        own = (F.greatest(F.col(n) - cfg.discount, F.lit(0.0)) + cfg.discount * F.col(kinds) * F.col("p")) / F.col(z)
        return F.when(F.col(z) > 0, own).otherwise(F.col("p"))

    ratio = F.log(estimate("t", "zt", "kt")) - F.log(estimate("o", "zo", "ko"))
    unseen = F.log(left("zt", "kt")) - F.log(left("zo", "ko"))
    return rows.select("gram", "h", ratio.alias("ratio"), unseen.alias("unseen"), "g2")


def _certain(ratios: DataFrame, cfg: ToxicityConfig) -> DataFrame:
    few = (F.col("g2") >= cfg.least_g2) & (F.abs("ratio") >= cfg.least_log_ratio)
    return ratios.select("gram", "ratio", "g2").where(few)


def _entries(grams: DataFrame, cfg: ToxicityConfig) -> DataFrame:
    """gram, ratio, g2 of the n-grams on which the classes differ."""
    return _certain(_ratios(grams, cfg), cfg)


def _bucket() -> Column:
    """Size class of a count ``n``: eighths of a doubling."""
    return F.floor(F.log2(F.col("n").cast("double")) * 8).cast("int")


def _least_sent(scores: DataFrame, most: int) -> tuple[int, bool]:
    """The least size class such that it and all larger ones hold at most so many scores; are these all scores?"""
    sizes = {r.b: r.c for r in scores.groupBy(_bucket().alias("b")).agg(F.count(F.lit(1)).alias("c")).collect()}
    held, least = 0, max(sizes, default=0) + 1
    for size in sorted(sizes, reverse=True):
        held += sizes[size]
        if held > most:
            break
        least = size
    return least, held <= most


def added_up(
    rows: DataFrame, by: list[str], key: str, scores: DataFrame, most_sent: int = MOST_SENT, same: tuple[str, ...] = ()
) -> DataFrame:
    """``by``, total, size: sum of the scores of a group's keys, and how many keys it has; a null key is none.

    ``same`` names columns that are alike in all rows of a group and stay; the result is partitioned by ``by`` alone.

    ``scores`` has every key with its ``ratio`` and its frequency ``n``.  Frequent keys meet their scores in the task
    that holds the rows.  The others are counted per group and shuffled; the key of what is left of
    a group is salted, so that no task gets all of them.  Where no others are, groups are shuffled once.
    """
    scores = scores.withColumn("_b", _bucket())
    least, all_sent = _least_sent(scores, most_sent)
    sent = scores.where(F.col("_b") >= least).select(key, F.col("ratio").alias("_sent"))
    kept = [F.max(c).alias(c) for c in same]
    if all_sent:
        met = rows.join(F.broadcast(sent), key, "left").groupBy(*by)
        return met.agg(F.sum(F.coalesce("_sent", F.lit(0.0))).alias("total"), F.count(key).alias("size"), *kept)
    rest = scores.where(F.col("_b") < least).select(F.col(key).alias("_rare"), F.col("ratio").alias("_rest"))
    salt = F.concat(F.lit(" "), F.pmod(F.xxhash64(*by), F.lit(4096)).cast("string"))  # no word or window has a space
    rare = F.when(F.col("_sent").isNull(), F.col(key))
    parts = rows.join(F.broadcast(sent), key, "left").groupBy(*by, F.coalesce(rare, salt).alias("_rare")).agg(
        F.sum(F.coalesce("_sent", F.lit(0.0))).alias("_total"), F.count(key).alias("_n"), *kept
    )
    total = F.sum(F.col("_total") + F.coalesce(F.col("_rest") * F.col("_n"), F.lit(0.0)))
    joined = parts.join(rest.hint("shuffle_hash"), "_rare", "left")
    return joined.groupBy(*by).agg(total.alias("total"), F.sum("_n").alias("size"), *kept)


def word_scores(words: DataFrame, model: ToxicityModel, most_sent: int = MOST_SENT) -> DataFrame:
    """word, n, ratio: log ratio of the character models for each of the distinct words; ``n`` is 1 if not given."""
    s, order = F.concat(F.lit("^"), F.col("word"), F.lit("$")), model.order
    # What a position adds depends on its character and those of its longest context alone.
    windows = F.transform(
        F.sequence(F.lit(2), F.length(s)),
        lambda end: F.substr(s, F.greatest(F.lit(1), end - order + 1), F.least(end, F.lit(order))),
    )
    n = F.col("n") if "n" in words.columns else F.lit(1)
    rows = words.select("word", n.cast("long").alias("n"), F.explode(windows).alias("window"))
    window = F.col("window")
    last = F.substr(window, F.length(window), F.lit(1))
    sizes = F.sequence(F.lit(1), F.length(window) - 1)
    distinct = rows.groupBy("window").agg(F.count(F.lit(1)).alias("n"))
    tried = distinct.select("window", "n", last.alias("u"), F.explode(sizes).alias("k"))
    tried = tried.withColumn("h", F.substr(window, F.length(window) - F.col("k"), F.col("k")))
    found = tried.join(broadcast_if_small(model.contexts, 300_000), "h", "left")
    found = found.withColumn("r", F.coalesce(F.element_at("seen", F.col("u")), "unseen"))
    longest = F.max_by("r", F.when(F.col("r").isNotNull(), F.col("k")))
    ratios = found.groupBy("window").agg(F.coalesce(longest, F.lit(0.0)).alias("ratio"), F.max("n").alias("n"))
    scored = added_up(rows, ["word"], "window", cut(ratios), most_sent, ("n",))
    return scored.select("word", "n", F.col("total").alias("ratio"))


def word_values(words: DataFrame, model: ToxicityModel, most_sent: int = MOST_SENT) -> DataFrame:
    """word, n, ratio: what a word adds to the difference of a text's log-likelihoods."""
    scores = word_scores(words, model, most_sent)
    if not min(model.sizes):
        return scores.select("word", "n", F.lit(0.0).alias("ratio"))
    known = model.words.select(F.col("word").alias("_word"), "t", "o")
    t, o = (F.coalesce(c, F.lit(0.0)) for c in ("t", "o"))
    # A word of neither class has half of what stands in one.
    shared = F.greatest((t > 0).cast("int") + (o > 0).cast("int"), F.lit(0.5)) / sum(model.kinds)
    # The character models' ratio per position, so that long words do not pile up small differences.
    toxic = 1 / (1 + F.exp(-F.col("ratio") / (F.length("word") + 1)))

    def estimate(n: Column, c: int, part: Column) -> Column:
        return (F.greatest(n - model.discount, F.lit(0.0)) + model.discount * model.kinds[c] * shared * 2 * part) / model.sizes[c]

    e = model.toxic_share
    value = F.log(1 - e + e * estimate(t, 0, toxic) / estimate(o, 1, 1 - toxic))
    return scores.join(known.hint("shuffle_hash"), F.col("word") == F.col("_word"), "left").select("word", "n", value.alias("ratio"))


def raw_scores(rows: DataFrame, model: ToxicityModel, keep: str, most_sent: int = MOST_SENT) -> DataFrame:
    """``keep`` and raw (log-likelihood difference per word) of every row with a ``_text``."""
    split = F.split(F.lower("_text"), SEPARATOR)
    words = rows.select(F.explode(F.array_distinct(split)).alias("word")).where("word != ''")
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    scores = cut(word_values(cut(counted), model, most_sent))
    each = rows.select(keep, "_text").withColumn("_row", F.monotonically_increasing_id())
    each = each.select(keep, "_row", F.explode_outer(split).alias("_w")).select(keep, "_row", F.nullif("_w", F.lit("")).alias("word"))
    summed = added_up(each, [keep, "_row"], "word", scores, most_sent)
    return summed.select(keep, (F.col("total") / (F.col("size") + model.extra_words)).alias("raw"))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[float, float]:
    """Slope and offset of the ridge logistic regression of y on x."""
    if len(x) == 0 or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1)
        return 0.0, math.log(share / (1 - share))
    scale = x.std() or 1.0
    design = np.column_stack((x / scale, np.ones(len(x))))
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (y - p) - [ridge * 0.01 * w[0], 0.0]
        hessian = (design * (p * (1 - p))[:, None]).T @ design + np.diag([ridge * 0.01, 1e-9])
        step = np.linalg.solve(hessian, gradient)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0] / scale), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, cfg: ToxicityConfig = ToxicityConfig()) -> ToxicityModel:
    agreed = cut(agreed_labels(labels, "toxic"))
    counted = labelled(docs, agreed.where(F.col("fold").isin(*cfg.count_folds)))
    words = cut(_word_counts(counted))
    grams = cut(_grams_of(words, cfg.order))
    ratios = cut(_ratios(grams, cfg))
    follows = F.struct(F.substr(F.col("gram"), F.length("gram"), F.lit(1)), F.col("ratio"))
    contexts = ratios.groupBy("h").agg(F.first("unseen").alias("unseen"), F.map_from_entries(F.collect_list(follows)).alias("seen"))
    sums = words.agg(
        *[F.count_if(F.col(c) > 0).alias(f"kinds_{c}") for c in "to"], *[F.sum(c).alias(f"size_{c}") for c in "to"]
    ).first()
    model = ToxicityModel(
        _certain(ratios, cfg), cut(contexts), words, (sums.kinds_t, sums.kinds_o), (sums.size_t or 0.0, sums.size_o or 0.0),
        cfg.discount, cfg.toxic_share, cfg.order, cfg.extra_words, max_entries=cfg.max_entries,
    )
    sample = bounded_sample(agreed.where(F.col("fold") == cfg.calibration_fold), cfg.calibration_rows)
    few = raw_scores(labelled(docs, sample), model, "label").collect()
    slope, offset = logistic(np.array([r.raw for r in few]), np.array([r.label for r in few]))
    return replace(model, slope=slope, offset=offset)


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, held_out, score, predicted; a row for each document row."""
    raw = raw_scores(docs.select("doc_id", text_or_empty().alias("_text")), model, "doc_id")
    p = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), model.slope * F.col("raw") + model.offset))))
    return raw.select(
        "doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), p.alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
