"""Source divergence, vector codes and line dedup against plain Python and SQL."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import llm_cases as cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from climcube.llm import divergence, line_dedup, oracle, queries, vector_codes
from compare import difference, duck

NEW = ("op11_source_divergence", "op12_vector_codes", "op13_line_dedup")


@pytest.mark.parametrize("name", NEW)
def test_given_tables_equal_sql(spark, name):
    con = duck(cases.SF_DIR)
    assert difference(queries.registry()[name](spark, cases.SF_DIR), con, oracle.statements()[name]) is None


# source divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain_audit(rows, least_docs, top):
    rows = [(a or "", b or "", TERM.findall((t or "").translate(cases.LOW))) for a, b, t in rows]
    out = []
    for lang in {r[0] for r in rows}:
        docs = Counter(t for a, _, words in rows if a == lang for t in set(words))
        kept = sorted((t for t, n in docs.items() if n >= least_docs), key=str.encode)
        groups = defaultdict(Counter)
        for a, b, words in rows:
            if a == lang:
                groups[b].update(t for t in words if docs[t] >= least_docs)
        whole = sum(groups.values(), Counter())

        def share(counts, t):
            return 1 + 10**9 * (counts[t] + 5) // (sum(counts.values()) + 5 * len(kept))

        shares = {s: {t: share(c, t) for t in kept} for s, c in groups.items()}
        for s in groups:
            pair = [(sum(abs(shares[s][t] - shares[o][t]) for t in kept), o) for o in groups if o != s]
            term = [(shares[s][t] - share(whole, t), t) for t in kept if groups[s][t] and shares[s][t] > share(whole, t)]
            for part, found, most in (("pair", pair, None), ("term", term, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, i) for i, (v, item) in enumerate(found[:most], 1)]
    return sorted(out)


def audit_rows(docs, **options):
    return sorted(tuple(r) for r in divergence.audit(docs, **options).collect())


@pytest.mark.parametrize(("least", "tile", "block_rows", "blocks"), [(2, 256, 100_000, 8), (2, 1, 3, 2), (3, 2, 5, 1), (99, 1, 5, 2)])
def test_divergence_equals_plain_python(spark, monkeypatch, least, tile, block_rows, blocks):
    monkeypatch.setattr(divergence, "TILE", tile)
    monkeypatch.setattr(divergence, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(divergence, "LEAST_BLOCKS", blocks)
    rng = random.Random(least)
    words = "Été été the The of x Zürich ÀB data日本 a-b c1d naïve gap".split(" ")
    rows = [(rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", "é", "", None, "s10"]),
             rng.choice([None, "", "!!", " ".join(rng.choices(words, k=rng.randint(1, 12)))])) for _ in range(80)]
    rows += [("xx", "alone", "the the"), ("yy", "p", None), ("yy", "q", "once"), ("en", "big", "the " * 3000)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, source string, text string, n long, term string")
    assert audit_rows(docs, least_docs=least, top_terms=4) == plain_audit(rows, least, 4)
    assert divergence.audit(cases.empty(docs)).count() == 0


def test_terms_of_any_text(monkeypatch):
    texts = ["", "A\x00b\x7fC", "ÀÉ ÿ Ⅷ  x\u0085y", "".join(map(chr, range(0x250))), "a b" * 999]
    for size in (1 << 22, 1, 7):
        monkeypatch.setattr(divergence, "_SLICE", size)
        for t in texts:
            want = Counter(x.encode() for x in TERM.findall(t.translate(cases.LOW)))
            assert divergence.term_counts(t.encode()) == want


def test_tasks_hand_on_counters_in_parts(spark, monkeypatch):
    docs = spark.createDataFrame([("en", f"s{i % 3}", f"a b{i % 5} c") for i in range(30)], "lang string, source string, text string")
    whole = audit_rows(docs, least_docs=2)
    monkeypatch.setattr(divergence, "_FLUSH", 2)
    assert audit_rows(docs, least_docs=2) == whole


# vector codes


def plain_codes(rows, rounds=4):
    """rows: (vec_id, vector, label), all usable; Python integers throughout."""
    dims = max(4, -(-max(len(v) for _, v, _ in rows) // 4) * 4)
    ints = [[math.floor(x * 1024) for x in v] + [0] * (dims - len(v)) for _, v, _ in rows]
    seeds = {}
    for (i, _, _), v in zip(rows, ints):
        if i is not None:
            seeds[i] = min(seeds.get(i, v), v)
    first = [seeds[i] for i in sorted(seeds)[:256]]
    width = dims // 4
    codes, books = [[0] * 4 for _ in rows], []
    errors = [0] * len(rows)
    for part in range(4):
        own = [v[part * width : (part + 1) * width] for v in ints]
        book = [v[part * width : (part + 1) * width] for v in first]
        for step in range(rounds + 1):
            near = [min((sum((a - b) ** 2 for a, b in zip(v, e)), k) for k, e in enumerate(book)) for v in own]
            if step < rounds:
                members = defaultdict(list)
                for (_, k), v in zip(near, own):
                    members[k].append(v)
                for k, vs in members.items():
                    book[k] = [sum(c) // len(vs) for c in zip(*vs)]
        for i, (d, k) in enumerate(near):
            codes[i][part], errors[i] = k, errors[i] + d
        books += [x for e in book for x in e]
    digest = hashlib.sha256(",".join(map(str, books)).encode()).hexdigest()
    of_label = Counter()
    for (_, _, label), e in zip(rows, errors):
        of_label[label] += e
    return sorted(((i, bytes(c).hex(), e, of_label[label], digest) for (i, _, label), c, e in zip(rows, codes, errors)), key=str)


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, label, "x") for i, v, label in rows],
                                 f"vec_id long, embedding array<{kind}>, label int, code string")


def coded(df):
    return sorted((tuple(r) for r in vector_codes.compress(df).collect()), key=str)


def vectors(n, dims, seed, scale=1.0):
    rng = np.random.default_rng(seed)
    return [(int(i), [float(x) for x in rng.normal(0, scale, dims).astype(np.float32)], int(i) % 3 if i % 5 else None) for i in range(n)]


@pytest.mark.parametrize(("n", "dims", "block", "chunk"), [(600, 8, 128, 1 << 19), (600, 8, 4, 64), (40, 12, 3, 1 << 19), (300, 4, 16, 256)])
def test_codes_equal_plain_python(spark, monkeypatch, n, dims, block, chunk):
    monkeypatch.setattr(vector_codes, "BLOCK", block)
    monkeypatch.setattr(vector_codes, "CHUNK", chunk)
    rows = vectors(n, dims, n)
    rows += [(1000 + i, rows[7][1], 9) for i in range(n // 2)]  # a third are copies of one vector
    assert coded(frame(spark, rows).repartition(3)) == plain_codes(rows)


def test_codes_of_awkward_rows(spark):
    good = vectors(20, 8, 1) + [(None, [0.5] * 8, 1), (3, [0.25] * 8, 1), (3, [0.25] * 8, 1), (90, [], None), (91, [1.0, -1.0], 2)]
    bad = [(50, None, 1), (51, [1.0, None], 1), (52, [float("nan")] * 8, 1), (53, [1.0, float("inf")], 1), (54, [-float("inf")], 2)]
    assert coded(frame(spark, good + bad)) == plain_codes(good)
    assert coded(frame(spark, bad)) == [] and coded(cases.empty(frame(spark, good))) == []
    assert coded(frame(spark, [(None, [1.0], 1)])) == []


def test_codes_of_large_components_are_exact(spark):
    rows = [(i, [x * (1 + i % 7) * 3e9 for x in v], label) for i, v, label in vectors(300, 8, 5)]
    want = [(a, b, e if e < 2**63 else None, t, d) for a, b, e, t, d in plain_codes(rows)]
    got = coded(frame(spark, rows, "double"))
    assert [(r[0], r[1], r[2], r[4]) for r in got] == [(r[0], r[1], r[2], r[4]) for r in want]
    edge = vector_codes.integers(np.array([1e300, -1e300, 0.99 / 1024, -0.01]))
    assert edge.tolist() == [10**18, -(10**18), 0, -11]


def test_shortlists_never_lose_the_nearest():
    rng = np.random.default_rng(3)
    for _ in range(50):
        points = rng.integers(-50, 50, (30, 3))
        book = rng.integers(-60, 60, (17, 3)).astype(float)
        book[5] = book[2]
        listed = vector_codes.shortlists(points.min(0)[None].astype(float), points.max(0)[None].astype(float), book)[0]
        distances = ((points[:, None] - book) ** 2).sum(2)
        assert listed[distances.argmin(1)].all()
        assert (distances[:, ~listed] > distances.min(1, keepdims=True)).all()


@pytest.mark.parametrize("dims", [1, 2, 3])
def test_the_curve_visits_neighbours(dims):
    side = 8
    grid = np.stack(np.meshgrid(*[np.arange(side)] * dims), -1).reshape(-1, dims)
    # stretch the grid to the curve's own resolution, so that each cell is one step of a coarser curve
    keys = vector_codes.hilbert_keys(grid)
    assert len(set(keys.tolist())) == len(grid)
    steps = np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(1)
    assert (steps == 1).all()


def test_a_block_with_one_candidate_is_added_whole(monkeypatch):
    import pyarrow as pa

    points = np.repeat([[5, 5, 5, 5], [900, 900, 900, 900]], 128, axis=0)
    batch = vector_codes._chunk(pa.array(range(256)), pa.array([0] * 256), points)
    books = np.array([[[0], [1000]]] * 4)
    monkeypatch.setattr(vector_codes, "_nearest", None)
    rows = next(vector_codes._tally(iter([batch.drop_columns(["ids", "labels"])]), books)).to_pylist()
    assert {(r["entry"], r["at"], int(r["total"])) for r in rows} == {(0, -1, 128), (0, 0, 640), (1, -1, 128), (1, 0, 115200)}


# line dedup

LONG = "this line has more than forty code points in it, surely"


def plain_lines(rows, least=40, docs=5):
    def key(line):
        return re.sub("^[\x20\x09-\x0d]+|[\x20\x09-\x0d]+$", "", line).translate(cases.LOW)

    lines = [(i, (t or "").split("\n")) for i, t in rows]
    held = defaultdict(list)
    for i, own in lines:
        for k in {key(x) for x in own}:
            held[k].append(i)
    gone = {k: max((i for i in v if i is not None), default=None) for k, v in held.items() if len(k) >= least and len(v) >= docs}
    out = []
    for i, own in lines:
        kept = [x for x in own if key(x) not in gone or gone[key(x)] == i]
        out.append((i, "\n".join(kept), len(own), len(own) - len(kept)))
    return sorted(out, key=str)


def deduped(df, **options):
    return sorted((tuple(r) for r in line_dedup.drop_shared_lines(df, **options).collect()), key=str)


def many_lines(seed):
    rng = random.Random(seed)
    pool = [LONG, LONG.upper(), f" \t{LONG}\r", "é" * 40, "é" * 39, "É" * 40, "short", "", " ", "x" * 40, "x" * 39]
    pool += [f"{LONG} number {i}" for i in range(40)]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randint(0, 9)))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, "\n\n"), (7, LONG), (7, LONG), (None, f"{LONG}\nalone\n{LONG}"), (203, f"{LONG}\r\n" * 3000)]
    return rows + [(300 + i, LONG) for i in range(90)]


@pytest.mark.parametrize("options", [{}, {"most_bytes": 0}, {"least_docs": 2, "least_chars": 1}, {"least_docs": 2, "least_chars": 1, "most_bytes": 0}])
def test_lines_equal_plain_python(spark, monkeypatch, options):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 8)
    monkeypatch.setattr(line_dedup, "COPY_PROBES", 30)
    rows = many_lines(4)
    docs = spark.createDataFrame([(i, t, 1, b"x") for i, t in rows], "doc_id long, text string, n long, bits binary")
    plain = {"docs": options.get("least_docs", 5), "least": options.get("least_chars", 40)}
    assert deduped(docs.repartition(5), **options) == plain_lines(rows, **plain)


@pytest.mark.parametrize("most_bytes", [line_dedup.MOST_BYTES, 0])
def test_lines_of_awkward_tables(spark, most_bytes):
    docs = cases.documents(spark)
    assert deduped(cases.empty(docs), most_bytes=most_bytes) == []
    nobody = spark.createDataFrame([(None, LONG)] * 6, "doc_id long, text string")
    assert deduped(nobody, most_bytes=most_bytes) == [(None, LONG, 1, 0)] * 6
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert deduped(docs, most_bytes=most_bytes) == plain_lines(rows)
    with pytest.raises(ValueError):
        line_dedup.drop_shared_lines(docs, least_docs=1)


@pytest.mark.parametrize("n", [0, 1, 2, 63, 5000])
def test_the_hash_is_perfect_and_minimal(n):
    rng = np.random.default_rng(n)
    h1 = rng.integers(0, 2**63, n).astype(np.uint64)
    h2 = rng.integers(0, 2**63, n).astype(np.uint64)
    h1[: n // 3] = 7  # the second word tells them apart
    counts, lasts = np.arange(n) + 2, np.arange(n) * 3
    shard = line_dedup.Shard.read(*line_dedup.Shard.of(h1, h2, counts, lasts).row())
    assert sorted(shard.rank(h1, h2).tolist()) == list(range(n))
    found = shard.probe(h1, h2) if n else (counts, lasts)
    assert found[0].tolist() == counts.tolist() and found[1].tolist() == lasts.tolist()
    if n:
        strange = rng.integers(0, 2**63, 1000).astype(np.uint64)
        assert not shard.probe(strange, strange)[0].any()
        assert len(shard.bits) * 8 < 4 * n + 64 * len(shard.sizes)


def test_texts_and_lines_are_not_shuffled(spark):
    docs = spark.read.parquet(f"{cases.SF_DIR}/documents.parquet")
    plan = line_dedup.drop_shared_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    counted = line_dedup.repeated_lines(docs.select("doc_id", F.col("text").cast("binary").alias("text")), 40)
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("HashAggregate") == 2
