"""URL filter: rules for hosts and paths, and boosted trees on lexical features for the rest.

A rule names a host and the start of a path.  It fits its host and all subdomains; of those that
fit, the longest decides.  URLs with a rule are the labelled ones: their verdicts train
gradient-boosted trees on length, depth, digit ratio, entropy, number of parameters and
statistics of two suffixes, the host's last label alone and with the path's first segment, and the trees
judge the URLs that no rule fits.

Suffix statistics count all labelled URLs outside fold 0; the trees are fitted on a bounded sample
of them by a hash of the identifier.  Suffixes meet the URLs by an equi-join, which a broadcast
replaces only if a count shows that they are few.  Only identifiers and URLs are read.

Defined cases: a null URL or one without :// has an empty host and path, and the trees judge it by
its text; without labels of both kinds the trees are empty and give the share of blocked labels; rows
that repeat are judged each; a null identifier is never in the sample; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, broadcast_if_small, cut, fold, small_batches


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    UrlRule("allow", "com", "/"),
    UrlRule("block", "example.com", "/en/"),
    UrlRule("allow", "www.example.com", "/en/"),
    UrlRule("block", "net", "/es/"),
    UrlRule("block", "net", "/fr/"),
)


@dataclass(frozen=True)
class TreeConfig:
    #: Most labelled URLs in the sample that the trees are fitted on.
    sample_rows: int = 20_000
    trees: int = 60
    depth: int = 3
    bins: int = 32
    rate: float = 0.2
    least_rows: int = 20
    ridge: float = 1.0
    #: Weight of the common share in a suffix's share.
    prior: float = 10.0


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return ascii_lower(found)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[UrlRule] = RULES) -> Column:
    """Name and verdict of the rule that decides, or null; of equally long rules a blocking one."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.name), r.verdict == "block")):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


FEATURES = (
    "length", "host_length", "path_length", "depth", "digit_ratio", "entropy", "host_entropy", "parameters",
    "query_length", "labels", "hyphens", "longest_word", "label_share", "label_weight", "segment_share", "segment_weight",
)
SPLIT = re.compile(r"^(?:.*?://)?([^/?#]*)([^?#]*)(\?[^#]*)?", re.S)
WORD = re.compile(r"[a-z]+", re.I)


def _entropy(text: str) -> float:
    if not text:
        return 0.0
    codes = np.fromiter(map(ord, text), np.int64, len(text))
    share = np.unique(codes, return_counts=True)[1] / len(text)
    return float(-(share * np.log2(share)).sum())


def features(url: str | None, suffixes: tuple[float, ...]) -> list[float]:
    url = url or ""
    host, path, query = SPLIT.match(url).groups()
    query = query or ""
    return [
        len(url), len(host), len(path), path.count("/"), sum(map(str.isdigit, url)) / max(1, len(url)), _entropy(url),
        _entropy(host), len([p for p in query[1:].split("&") if p]), len(query), host.count(".") + 1,
        url.count("-"), max(map(len, WORD.findall(url)), default=0), *suffixes,
    ]


@dataclass
class Trees:
    """Complete binary trees: per inner node a feature and a cut, per leaf a value."""

    base: float
    depth: int
    feature: list[np.ndarray] = field(default_factory=list)
    cut: list[np.ndarray] = field(default_factory=list)
    value: list[np.ndarray] = field(default_factory=list)

    def logit(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, c, v in zip(self.feature, self.cut, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, f[node]] > c[node])
            out += v[node - len(f)]
        return out


def train(x: np.ndarray, y: np.ndarray, cfg: TreeConfig = TreeConfig()) -> Trees:
    """Newton boosting of the logistic loss with histograms; both verdicts weigh the same in sum.

    Rules do not fit URLs at random, so their share of blocks says nothing about the other URLs.
    """
    if len(y) == 0 or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1)
        return Trees(float(np.log(share / (1 - share))), cfg.depth)
    model = Trees(0.0, cfg.depth)
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    inner, d = 2**cfg.depth - 1, x.shape[1]
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, cfg.bins + 1)[1:-1])) for j in range(d)]
    binned = np.column_stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)])
    z = np.full(len(y), model.base)
    for _ in range(cfg.trees):
        p = 1 / (1 + np.exp(-z))
        g, h = weight * (y - p), weight * p * (1 - p)
        node, feature, cut_at = np.zeros(len(y), np.int64), np.zeros(inner, np.int64), np.full(inner, np.inf)
        for k in range(inner):
            here = np.flatnonzero(node == k)
            if len(here) >= 2 * cfg.least_rows:
                best = 1e-6
                total_g, total_h = g[here].sum(), h[here].sum()
                for j in range(d):
                    size = len(cuts[j]) + 1
                    left_g = np.bincount(binned[here, j], g[here], size).cumsum()[:-1]
                    left_h = np.bincount(binned[here, j], h[here], size).cumsum()[:-1]
                    left_n = np.bincount(binned[here, j], minlength=size).cumsum()[:-1]
                    gain = (
                        left_g**2 / (left_h + cfg.ridge) + (total_g - left_g) ** 2 / (total_h - left_h + cfg.ridge)
                        - total_g**2 / (total_h + cfg.ridge)
                    )
                    gain[(left_n < cfg.least_rows) | (len(here) - left_n < cfg.least_rows)] = 0
                    if len(gain) and gain.max() > best:
                        best, feature[k], cut_at[k] = gain.max(), j, cuts[j][gain.argmax()]
            node[here] = 2 * k + 1 + (x[here, feature[k]] > cut_at[k])
        leaf = node - inner
        sums_g, sums_h = np.bincount(leaf, g, inner + 1), np.bincount(leaf, h, inner + 1)
        value = cfg.rate * sums_g / (sums_h + cfg.ridge)
        z += value[leaf]
        model.feature.append(feature)
        model.cut.append(cut_at)
        model.value.append(value)
    return model


def _suffixes(host: Column, path: Column) -> dict[str, Column]:
    label = F.substring_index(host, ".", -1)
    return {"label": label, "segment": F.concat_ws("/", label, F.get(F.split(path, "/"), F.lit(1)))}


def suffix_shares(ruled: DataFrame, suffix: str, cfg: TreeConfig) -> DataFrame:
    """Each suffix with the share of blocked labels, both verdicts weighing the same in sum, and the log of their number.

    Shares are drawn towards one half by ``cfg.prior`` labels; labels of fold 0 do not count.
    """
    known = ruled.where(F.col("found").isNotNull() & (fold(F.col("page_id")) != 0))
    blocked = F.sum((F.col("found.verdict") == "block").cast("int"))
    counts = cut(known.groupBy(suffix).agg(F.count(F.lit(1)).alias("n"), blocked.alias("bad")))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")).first()
    bad = F.col("bad") * (0.5 * total.n / max(1, total.bad))
    good = (F.col("n") - F.col("bad")) * (0.5 * total.n / max(1, total.n - total.bad))
    share = (bad + 0.5 * cfg.prior) / (bad + good + cfg.prior)
    return counts.select(suffix, share.alias(f"{suffix}_share"), F.log1p("n").alias(f"{suffix}_weight"))


def judge(pages: DataFrame, rules: Sequence[UrlRule] = RULES, cfg: TreeConfig = TreeConfig()) -> DataFrame:
    """page_id, host, path, rule, verdict, score (of the trees: probability to block); a row for each page row."""
    small_batches(pages.sparkSession, 4096)
    ruled = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    ruled = ruled.withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    suffixes = _suffixes(F.col("host"), F.col("path"))
    full = ruled = ruled.withColumns(suffixes)
    for suffix in suffixes:
        full = full.join(broadcast_if_small(suffix_shares(ruled, suffix, cfg), 100_000), suffix, "left")
    numbers = [F.coalesce(f"{s}_{x}", F.lit(default)) for s in suffixes for x, default in (("share", 0.5), ("weight", 0.0))]
    full = full.withColumn("numbers", F.array(*numbers))
    sample = full.where(F.col("found").isNotNull() & (fold(F.col("page_id")) != 0))
    sample = sample.orderBy(F.xxhash64("page_id"), "page_id").limit(cfg.sample_rows)
    few = sample.select("url", "numbers", (F.col("found.verdict") == "block").cast("int").alias("y")).collect()
    x = np.array([features(r.url, r.numbers) for r in few], float).reshape(len(few), len(FEATURES))
    trees = train(x, np.array([r.y for r in few], float), cfg)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            urls, numbers = (batch.column(c).to_pylist() for c in ("url", "numbers"))
            x = np.array([features(*r) for r in zip(urls, numbers, strict=True)], float).reshape(-1, len(FEATURES))
            score = 1 / (1 + np.exp(-trees.logit(x)))
            kept = ["page_id", "host", "path", "rule", "fixed"]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [pa.array(score)], [*kept, "score"])

    rows = full.select("page_id", "host", "path", "url", "numbers", F.col("found.rule").alias("rule"), F.col("found.verdict").alias("fixed"))
    kind = rows.schema["page_id"].dataType.simpleString()
    scored = rows.mapInArrow(run, f"page_id {kind}, host string, path string, rule string, fixed string, score double")
    verdict = F.coalesce("fixed", F.when(F.col("score") >= 0.5, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
