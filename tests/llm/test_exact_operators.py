"""Operators whose results follow from a contract, against plain Python."""

import hashlib
import os
import random
import re
import zlib
from collections import defaultdict
from types import SimpleNamespace

import llm_cases as cases
import numpy as np
import pyarrow as pa
import pytest
from public_tokenizers import path as tokenizer_path
from pyspark.sql import functions as F

from climcube.llm import common, decontamination, oracle, packing, quality_rules, queries, secrets, simhash, token_counts
from compare import difference, duck


@pytest.fixture(scope="module")
def docs(spark):
    return cases.documents(spark).cache()


@pytest.fixture(scope="module")
def real(spark):
    """The smallest given documents as rows."""
    return spark.read.parquet(f"{cases.SF_DIR}/documents.parquet").collect()


def rows_of(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def expected(rows, of):
    return sorted(((i, *of(t)) for i, t in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int, text string")


# quality rules

COUNTS = ("doc_id", *quality_rules.FEATURES, "base_failed")


def test_quality_counts(spark, docs, real):
    got = cases.pairs(quality_rules.judge(docs, labels(spark)), *COUNTS)
    assert got == expected(rows_of(docs), cases.quality_counts)
    got = cases.pairs(queries.op10_quality_rules(spark, cases.SF_DIR), *COUNTS)
    assert got == expected([(r.doc_id, r.text) for r in real], cases.quality_counts)


def test_quality_without_labels_only_base_rule(spark, docs):
    for r in quality_rules.judge(docs, labels(spark)).collect():
        assert r.kept == (not r.base_failed) and r.rejected_by == []
    assert quality_rules.judge(cases.empty(docs), labels(spark)).count() == 0


@pytest.mark.parametrize(("n", "k", "p"), [(10, 0, 0.1), (50, 3, 0.05), (2000, 4, 0.005), (100_000, 450, 0.005), (3, 3, 0.5)])
def test_binomial(spark, n, k, p):
    from math import exp, lgamma, log

    want = sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * log(p) + (n - i) * log(1 - p)) for i in range(k + 1))
    got = spark.range(1).select(quality_rules.binomial_cdf(F.lit(n).cast("long"), F.lit(k).cast("long"), p)).first()[0]
    assert got == pytest.approx(want, rel=1e-6)


def test_cutoffs_keep_their_promise(spark):
    """Good documents below every cutoff, bad ones with symbols: the rule is certified and used."""
    rng = random.Random(3)

    def text(bad):
        return " ".join(f"w{rng.randrange(10**9)}" + ("###########" if bad else "") for _ in range(60))

    rows = [(i, text(i % 5 == 0)) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = labels(spark, [(i, int(i % 5 != 0), 0, "") for i, _ in rows] + [(1, 1, 0, ""), (2, 0, 0, "")])
    cfg = quality_rules.RuleConfig(alpha=0.08)
    certified = quality_rules.certify(
        quality_rules.add_features(docs.select("doc_id", F.col("text").alias("_text"))), known, cfg
    ).collect()
    assert {r.rule for r in certified if r.rule == "symbol_ratio"} and all(r.n_rejected <= 0.02 * r.n_good for r in certified)
    kept = {r.doc_id: r.kept for r in quality_rules.judge(docs, known, cfg).collect()}
    assert all(kept[i] == (i % 5 != 0) for i, _ in rows)
    # Too few labels certify nothing.
    few = quality_rules.judge(docs, known.limit(20), cfg)
    assert few.where("kept").count() == 1500


def test_quality_stage_keeps_columns(spark, docs):
    kept = quality_rules.keep_good(docs, labels(spark))
    assert kept.columns == docs.columns
    want = [r for r in rows_of(docs) if not cases.quality_counts(r[1])[-1]]
    assert cases.pairs(kept, "doc_id", "text") == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))


# decontamination

ITEMS = [(1, cases.PASSAGE), (2, "two words"), (3, None), (4, "--"), (5, cases.PASSAGE.upper() + "!"), (6, "Ok"), (None, "w w w")]
HITS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def items(spark, rows=ITEMS):
    return spark.createDataFrame([(i, t, 3) for i, t in rows], "item_id int, text string, window int")


def test_contamination(spark, docs, real):
    known = [("" if i is None else i, t) for i, t in ITEMS]
    rows = rows_of(docs)
    want = dict(zip(range(len(rows)), cases.contamination([t for _, t in rows], known), strict=True))
    want = sorted(((rows[i][0], *v) for i, v in want.items()), key=lambda r: tuple((v is None, str(v)) for v in r))
    assert cases.pairs(decontamination.contamination(docs, items(spark)), *HITS) == want
    assert any(r[-1] for r in want) and not all(r[-1] for r in want)
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{cases.SF_DIR}/benchmark.parquet").collect()]
    want = cases.contamination([r.text for r in real], bench)
    want = sorted(((r.doc_id, *v) for r, v in zip(real, want, strict=True)), key=lambda r: tuple((v is None, str(v)) for v in r))
    assert cases.pairs(queries.op8_decontamination(spark, cases.SF_DIR), *HITS) == want


def test_contamination_of_empty_tables(spark, docs):
    assert decontamination.contamination(cases.empty(docs), items(spark)).count() == 0
    none = decontamination.contamination(docs, items(spark).limit(0))
    assert none.where("contaminated or n_hit > 0").count() == 0 and none.count() == docs.count()


def test_contamination_without_broadcast(spark, docs, monkeypatch):
    want = cases.pairs(decontamination.contamination(docs, items(spark)), *HITS)
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", 0)
    got = decontamination.contamination(docs, items(spark))
    assert cases.pairs(got, *HITS) == want


def test_no_array_of_words_is_shuffled(spark, docs, monkeypatch):
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", 0)
    shingles = decontamination._keyed(decontamination.shingles_of(items(spark)))
    plan = decontamination._matches(docs, shingles)._jdf.queryExecution().toString()
    lines = plan.split("== Physical Plan ==")[1].splitlines()
    below = [y for x, y in zip(lines, lines[1:], strict=False) if "Exchange hashpartitioning(key#" in x]
    assert below and "BroadcastHashJoin" not in plan
    # The array is read to make _here, but is no column of what is shuffled.
    assert "AS _here#" in below[0] and not re.search(r"[\[ ]_words#\d+[,\]]", below[0].split("concat_ws")[0])


def test_what_is_written_does_not_grow_with_a_common_passage(spark, monkeypatch):
    """A passage in many documents, many times: neither its positions nor its candidates are written."""
    written = []

    def cut(df, eager=True):
        out = common.cut(df, eager)
        written.append(out.count())
        return out

    monkeypatch.setattr(decontamination, "cut", cut)
    passage = " ".join(f"p{i}" for i in range(40))
    texts = [" ".join([f"own{n}", *[passage] * 20]) for n in range(150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = [(i, *w) for i, w in enumerate(cases.contamination(texts, [(1, passage)]))]
    got = cases.pairs(decontamination.contamination(docs, items(spark, [(1, passage)])), *HITS)
    assert sorted(got, key=str) == sorted(want, key=str)
    assert written and max(written) <= 28 * 9  # the shingles of the item's windows


def test_no_row_of_the_scan_holds_more_than_a_piece(spark):
    docs = spark.createDataFrame([(0, " ".join(f"w{i}" for i in range(1000)))], "doc_id long, text string")
    rows = decontamination._positions(docs, [2, 5]).select("at", "base", "k", "n_words", F.size("_words").alias("n")).collect()
    assert sorted((r["at"], r["k"]) for r in rows) == [(i, k) for i in range(1000) for k in (2, 5)]
    assert max(r["n"] for r in rows) < decontamination.PIECE + 2 * decontamination.WINDOW
    for r in rows:  # all that a window filed under this position may need
        assert r["base"] <= max(0, r["at"] - 8) and r["base"] + r["n"] >= min(r["n_words"], r["at"] + 13)


def test_passages_across_pieces(spark, monkeypatch):
    """Passages at every place of a piece, whole and short by a word at either end, of shared and of small items."""
    words = [f"p{i}" for i in range(15)]
    known = [(1, " ".join(words)), (2, " ".join(words)), (3, "p3 p4 p5 p6 p7 p8"), (4, "p9 o1")]
    texts = [" ".join([*[f"o{i}" for i in range(n)], *part, "o1 end"]) for n in range(70) for part in (words, words[1:13], words[:12])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = sorted(((i, *w) for i, w in enumerate(cases.contamination(texts, known))), key=str)
    for most in (decontamination.BROADCAST_ROWS, 0):
        monkeypatch.setattr(decontamination, "BROADCAST_ROWS", most)
        got = cases.pairs(decontamination.contamination(docs, items(spark, known)), *HITS)
        assert sorted(got, key=str) == want


def test_decontamination_stage(spark, docs):
    kept = decontamination.drop_contaminated(docs, items(spark))
    clean = decontamination.contamination(docs, items(spark)).where("not contaminated")
    assert kept.columns == docs.columns
    assert cases.pairs(kept, "doc_id") == cases.pairs(clean, "doc_id")


# secrets


def test_secret_spans(spark, docs, real):
    found, _ = secrets.scan(docs)
    got = sorted(
        (r.path is None, r.path or 0, ",".join(f"{x.rule}:{x.start}:{x.end}" for x in r.found)) for r in found.collect()
    )
    assert got == sorted((i is None, i or 0, cases.secret_spans(t)) for i, t in rows_of(docs))
    got = {r.doc_id: (r.spans, r.base_sha256) for r in queries.op1_secret_scan(spark, cases.SF_DIR).collect()}
    want = {r.doc_id: cases.secret_spans(r.text) for r in real}
    assert got == {i: (s, hashlib.sha256(s.encode()).hexdigest()) for i, s in want.items()}
    assert secrets.scan(cases.empty(docs))[0].count() == 0


@pytest.mark.parametrize("name", sorted(oracle.statements()))
def test_queries_equal_their_sql(spark, name):
    con = duck(cases.SF_DIR)
    assert difference(queries.registry()[name](spark, cases.SF_DIR), con, oracle.statements()[name]) is None


def test_ledger_is_incremental(spark, docs):
    """A second scan of old and new versions looks only at new blobs; a new rule version at that rule alone."""
    first = docs.where("doc_id < 13")
    found, ledger = secrets.scan(first)
    assert ledger.count() == 3 * first.select(F.coalesce("text", F.lit(""))).distinct().count()
    again, more = secrets.scan(docs, ledger)
    blobs = docs.select(F.coalesce("text", F.lit(""))).distinct().count()
    assert ledger.count() + more.count() == 3 * blobs
    whole, _ = secrets.scan(docs)
    assert cases.pairs(again, "path", "blob", "found") == cases.pairs(whole, "path", "blob", "found")
    newer = tuple(secrets.Rule(**{**r.__dict__, "version": 2}) if r.name == "hex" else r for r in secrets.RULES)
    _, changed = secrets.scan(docs, ledger.union(more), newer)
    assert {(r.rule, r.version) for r in changed.collect()} == {("hex", 2)} and changed.count() == blobs


def test_redaction(spark, docs):
    clean = secrets.redact(docs)
    assert clean.columns == docs.columns

    def without(text):
        spans = sorted(tuple(map(int, s.split(":")[1:])) for s in cases.secret_spans(text).split(",") if s)
        out, at = "", 0
        for start, end in spans:
            if start >= at:
                out += text[at:start] + "<SECRET>"
            at = max(at, end)
        return text if text is None else out + text[at:]

    want = [(i, without(t)) for i, t in rows_of(docs)]
    assert cases.pairs(clean, "doc_id", "text") == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))


# SimHash


def test_fingerprints_and_components(spark, docs, real):
    for frame, rows in ((simhash.near_duplicates(docs), rows_of(docs)),
                        (queries.op7_simhash(spark, cases.SF_DIR), [(r.doc_id, r.text) for r in real])):
        fps = [cases.fingerprint(t) for _, t in rows]
        ids = [i for i, _ in rows]
        want = [(i, f"{f:016x}", c) for i, f, c in zip(ids, fps, cases.components(ids, fps), strict=True)]
        assert cases.pairs(frame, "doc_id", "fingerprint", "component_id") == sorted(
            want, key=lambda r: tuple((v is None, str(v)) for v in r)
        )
    assert simhash.near_duplicates(cases.empty(docs)).count() == 0


def test_links_of_dense_and_chained_fingerprints(spark):
    """Balls around a point, chains of two-bit steps, the top bit, and points three bits apart."""
    rng = random.Random(5)
    points = {0, 1 << 63, (1 << 63) | 7, 0b111 << 20}
    for _ in range(12):
        centre = rng.getrandbits(64)
        points |= {centre ^ (1 << i) ^ (1 << j) for i, j in ((rng.randrange(64), rng.randrange(64)) for _ in range(25))}
        walk = rng.getrandbits(64)
        for _ in range(10):
            walk ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
            points.add(walk)
    points = sorted(points)
    signed = [int(np.uint64(p).astype(np.int64)) for p in points]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    from climcube.llm.components import components

    root = {r.node: r.root for r in components(simhash.links(frame, 2)).collect()}
    want = cases.components(signed, points)
    assert [root.get(p, p) for p in signed] == want


def test_anchor_geometry(spark):
    """Every anchor is a code word within two bits, and there are 32 of them, or one."""
    rng = random.Random(1)
    values = [0, -1, 5, *(rng.getrandbits(64) - (1 << 63) for _ in range(50))]
    frame = spark.createDataFrame([(v,) for v in values], "fp long")
    at = simhash.syndrome(F.col("fp"))
    for r in frame.select("fp", at.alias("s")).select("fp", "s", simhash.anchors(F.col("fp"), F.col("s")).alias("a")).collect():
        assert len(r.a) == len(set(r.a)) == (32 if r.s else 1)
        for a in r.a:
            low = r.fp & ((1 << 63) - 1)
            assert (a ^ low).bit_count() <= 2
            parity = 0
            for i in range(63):
                parity ^= (i + 1) * (a >> i & 1)
            assert parity == 0


def test_first_of_each_group_stays(spark, docs):
    kept = simhash.keep_first(docs)
    ids = [r.component_id for r in simhash.near_duplicates(docs).select("component_id").distinct().collect()]
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(ids) and kept.count() == len(ids)


# tokens


@pytest.fixture(scope="module")
def model_path():
    return tokenizer_path("piece_bpe_32k.model")


ODD = ["a" * 900, " " * 300, "▁ a  b", "x\n y \t" * 90, "日本語テキスト" * 60, "ab  c" * 90 + "😀" * 90, "<s> </s> <unk>", "　 x  y", "a▁ b ▁c"]


def test_token_counts(spark, docs, real, model_path):
    counter = token_counts.Counter(model_path)
    whole = lambda t: len(counter.model.encode(t or ""))
    got = cases.pairs(token_counts.count_tokens(docs, model_path), "doc_id", "n_bytes", "n_tokens", "over_limit")
    assert got == expected(rows_of(docs), lambda t: (len((t or "").encode()), whole(t), whole(t) > 4096))
    got = {r.doc_id: r.n_tokens for r in queries.op4_token_counts(spark, cases.SF_DIR).collect()}
    assert got == {r.doc_id: whole(r.text) for r in real}
    assert [counter.count(t) for t in ODD] == [whole(t) for t in ODD]


@pytest.mark.parametrize(("chunk", "overlap"), [(40, 4), (200, 8), (1000, 1)])
def test_overlap_resynchronisation(real, model_path, chunk, overlap):
    counter = token_counts.Counter(model_path, chunk, overlap)
    for text in ODD + [r.text for r in real[:40]]:
        assert counter.spliced(text) == len(counter.model.encode(text))


# packing


def test_encoder_equals_the_library(real, monkeypatch):
    encoder = packing.Encoder(tokenizer_path("byte_bpe_50k.json"))
    texts = [t for t in cases.TEXTS if t is not None] + ODD + [r.text for r in real] + ["<|endoftext|> a<|endoftext|>b ", "a <|endoftext|> b", "\x85 a\xa0 b", "don't  \n\n x \t y"]
    whole = [np.array(x.ids, "<u4").tobytes() for x in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [encoder.encode(t) for t in texts] == whole
    monkeypatch.setattr(packing, "SLICE", 60)
    assert [encoder.encode(t) for t in texts] == whole
    # Nothing is remembered, or little of it.
    for half in (0, 3):
        encoder = packing.Encoder(tokenizer_path("byte_bpe_50k.json"))
        encoder.later.half = encoder.first.half = half
        assert [encoder.encode(t) for t in texts[:300]] == whole[:300]
        assert len(encoder.later.young) <= half and len(encoder.later.old) <= half


def test_unseen_words_encoded_together(real, monkeypatch):
    """Blocks of any size give the same, also where a block cannot be taken apart."""
    path = tokenizer_path("byte_bpe_50k.json")
    texts = [r.text for r in real][:200] + ODD + ["a\nb c\nd  e", "x \t y z", "\x1c a \x1d b c\x1e d"]
    want = packing.Encoder(path).many(texts)
    for joined in (1, 2, 7):
        monkeypatch.setattr(packing.Encoder, "JOINED", joined)
        assert packing.Encoder(path).many(texts) == want
    lost = packing.Encoder(path)
    lost.spaced[:] = False
    assert lost.many(texts) == want


def check_pieces(rows, texts):
    encoder = packing.Encoder(tokenizer_path("byte_bpe_50k.json"))
    ids = [encoder.encode(t or "") + packing.END for t in texts]
    want, got = defaultdict(int), defaultdict(int)
    for x in ids:
        want[zlib.crc32(x), len(x) // 4] += 1
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= packing.CAPACITY
    assert sum(sum(n for _, n in parts) for parts in sequences.values()) == sum(len(x) // 4 for x in ids)
    return sequences


def test_batches_are_joined_and_split_as_by_the_plain_rule():
    from climcube.llm import words

    white = [chr(c) for c in range(0x3001) if chr(c).isspace() or chr(c) == "\u200b"]
    texts = [f"a{x} b c" for x in white] + [f"a {x}b" for x in white] + ["", " ", " a", "a ", "a\nb\n\nc d", "\na b\n", "a  b"]
    assert words.split(texts).to_pylist() == [words.parts_of(t) for t in texts]
    assert words.split(["a b", "\nc d\n"]).to_pylist() == [["a", "b"], ["\nc", "d\n"]]
    batches = [pa.record_batch([pa.array([i]), pa.array([f"w{i} word " * 5])], names=["doc_id", "_text"]) for i in range(40)]
    joined = list(packing.joined(batches, 500))
    assert 1 < len(joined) < 20 and pa.Table.from_batches(joined) == pa.Table.from_batches(batches)
    asked = []
    memory = words.Generations(lambda xs: asked.append(xs) or [x.encode() for x in xs], 8)
    assert memory.of(list("abcabd")) == [b"a", b"b", b"c", b"a", b"b", b"d"] and asked == [list("abcd")]


def test_packing(spark, docs, real):
    path = tokenizer_path("byte_bpe_50k.json")
    rows = packing.pack(docs, path).collect()
    check_pieces(rows, [t for _, t in rows_of(docs)])
    assert packing.pack(cases.empty(docs), path).count() == 0
    rows = queries.op6_packing(spark, cases.SF_DIR).collect()
    sequences = check_pieces(rows, [r.text for r in real])
    padding = sum(1024 - sum(n for _, n in s) for s in sequences.values())
    assert padding <= 1024 * 8
    encoder, of_doc = packing.Encoder(path), defaultdict(list)
    for r in rows:
        of_doc[r.doc_id].append(r)
    for d in real:
        ids, at = encoder.encode(d.text) + packing.END, 0
        for r in sorted(of_doc[d.doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) // 4
            assert r.ids_crc32 == zlib.crc32(ids[4 * at : 4 * (at + r.length)])
            at += r.length
        assert at == len(ids) // 4


def test_small_blocks_pack_alike(spark, docs):
    rows = packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), block=500).collect()
    check_pieces(rows, [t for _, t in rows_of(docs)])


def test_first_fit_decreasing():
    rng = random.Random(2)
    for n in (0, 1, 2, 7, 400):
        sizes = [rng.randrange(1, 100) for _ in range(n)]
        bins = packing.fill(sizes, 100)
        assert len(bins) == -(-sum(sizes) // 100)
        pieces = defaultdict(list)
        for b in bins:
            assert sum(x[2] for x in b) <= 100
            for item, start, length in b:
                pieces[item].append((start, length))
        for item, parts in pieces.items():
            at = 0
            for start, length in sorted(parts):
                assert start == at
                at += length
            assert at == sizes[item]
    tree = packing.Tournament(3, 10)
    assert [tree.place(s) for s in (7, 6, 3, 4, 9)] == [0, 1, 0, 1, 2]


def test_pipeline(spark, tmp_path):
    """Each stage against plain Python, on what the stage before it kept."""
    import corpus_pipeline

    texts = cases.TEXTS + [" ".join(f"{w}{i}" for i in range(80)) for w in ("u", "v")] + ["tok = 1 " + " ".join(f"u{i}" for i in range(79))]
    texts += [" ".join(f"s{i}" for i in range(70)) + " password=abcdefghijk", " ".join(f"b{i}" for i in range(60)) + " " + cases.PASSAGE]
    rows = cases.documents(spark, texts).drop("blob")
    folder = str(tmp_path / "in")
    rows.write.parquet(f"{folder}/documents.parquet")
    labels(spark).write.parquet(f"{folder}/labels.parquet")
    items(spark, [(1, cases.PASSAGE)]).write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = str(tmp_path / name)
        stage(spark, kept, folder).write.parquet(out)
        after = spark.read.parquet(out)
        assert after.columns == docs.columns
        before, rows = rows_of(kept), rows_of(after)
        if name == "quality_rules":
            want = [r for r in before if not cases.quality_counts(r[1])[-1]]
        elif name == "near_duplicates":
            ids = [i for i, _ in before]
            want = {c: t for (i, t), c in zip(before, cases.components(ids, [cases.fingerprint(t) for _, t in before]), strict=True) if i == c}
            want = list(want.items())
        elif name == "decontamination":
            bad = cases.contamination([t for _, t in before], [(1, cases.PASSAGE)])
            want = [r for r, b in zip(before, bad, strict=True) if not b[-1]]
        else:
            want = [(i, t.replace("password=abcdefghijk", "<SECRET>")) for i, t in before]
        assert sorted(rows, key=str) == sorted(want, key=str) and rows
        kept = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept, folder)
    check_pieces(pieces.collect(), [t for _, t in rows_of(kept)])
    assert corpus_pipeline.run(spark, folder).count() == pieces.count()
    assert len(os.listdir(folder)) == 3


def test_no_machine_local_folder_on_a_cluster():
    def session(master):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda name, default: default))

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(session("spark://somewhere:7077"))
