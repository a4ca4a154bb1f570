"""Run detection, exact dedup and hard negatives, quality scores and odd conversations against plain versions."""

import hashlib
import math
import os
import random
import re
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from pressloom.llm import chat, exact_dedup, hard_negatives, periodic_runs, quality

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def some(data):
    t = pq.read_table(f"{data}/documents.parquet").to_pandas()
    return [(int(i), x) for i, x in zip(t.doc_id, t.text)]


@pytest.fixture(scope="module")
def edges():
    long = " ".join(f"w{i % 977}x{i}" for i in range(20_000))
    rows = [(1, None), (2, ""), (3, " \t\n\x0b"), (4, "One two"), (4, "One two"), (5, "Onetwo"), (6, "One  two"), (7, "one two"), (8, long), (9, long + " "), (None, "O netwo"), (None, "no id"), (None, "no id")]
    return [*rows, (10, "a b " * 9_000), (11, "é中文 " * 40 + "x")]


# ---- 11 ------------------------------------------------------------------------------------


def values_of(texts):
    rows = np.append(0, np.cumsum([len(t) for t in texts])).astype(np.int64)
    return np.array([x for t in texts for x in t], np.uint64), rows


def runs_of(texts, **options):
    values, rows = values_of(texts)
    out = [[] for _ in texts]
    for r, a, b, q in zip(*(x.tolist() for x in periodic_runs.find_runs(values, rows, **options))):
        out[r].append((a - int(rows[r]), b - a, q))
    return out


def test_transform_convolves_exactly():
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, periodic_runs.PRIME, (2, 16, 3), dtype=np.uint64)
    want = np.array([[sum(int(a[i, c]) * int(b[(k - i) % 16, c]) for i in range(16)) % periodic_runs.PRIME for c in range(3)] for k in range(16)])
    both = periodic_runs.reduced(periodic_runs.transform(a.copy()) * periodic_runs.transform(b.copy()))
    got = periodic_runs.transform_back(both) * np.uint64(pow(16, -1, periodic_runs.PRIME)) % np.uint64(periodic_runs.PRIME)
    assert (got == want).all()


def random_words(rng):
    n, letters = rng.randrange(0, 120), rng.choice([1, 2, 3, 9])
    out = [rng.randrange(letters) for _ in range(n)]
    if n and rng.random() < 0.6:
        period = rng.randrange(1, 14)
        out = [out[i % min(period, n)] for i in range(n)]
        for _ in range(rng.randrange(3)):
            out[rng.randrange(n)] = 77
    return out


def test_runs_match_brute_force():
    rng = random.Random(11)
    texts = [random_words(rng) for _ in range(600)]
    texts += [[0] * 2000, [i % 450 for i in range(1999)], [rng.randrange(2) for _ in range(1500)], [0, 0, 0, 0, 0], [0] * 6, [1, 2] * 4, [1, 2] * 3 + [1]]
    assert runs_of(texts) == [brute.runs(t) for t in texts]
    assert runs_of(texts, least=12, times=5) == [brute.runs(t, 12, 5) for t in texts]


def test_a_lying_hash_loses_nothing(monkeypatch):
    """Every extension claims equality as far as it may; comparing words puts it right."""
    monkeypatch.setattr(periodic_runs, "steps_equal", lambda sums, down, left, right, room, forward: room)
    rng = random.Random(12)
    texts = [random_words(rng) for _ in range(200)]
    assert runs_of(texts) == [brute.runs(t) for t in texts]


def test_equal_residues_are_no_runs():
    """Numbers that differ by a multiple of the prime only seem equal to the transform."""
    texts = [[i * periodic_runs.PRIME for i in range(40)]]
    assert runs_of(texts) == [[]]


def test_run_digests(spark, some, edges, data):
    rows = some + [(100_000 + i, t) for i, (_, t) in enumerate(edges)] + [e for e in edges if e[0] is None]
    docs = frame(spark, rows)
    planted = periodic_runs.with_planted_cycles(docs).collect()
    assert sorted((repr(r["doc_id"]), brute.words(r["text"])) for r in planted) == sorted((repr(i), brute.with_cycle(i, t)) for i, t in rows)
    got = periodic_runs.run_digests(periodic_runs.with_planted_cycles(docs)).collect()
    small = [(i, t) for i, t in rows if len(t or "") < 30_000]
    want = sorted(repr((i, *brute.run_digest(brute.with_cycle(i, t)))) for i, t in small)
    big = {i for i, t in rows if len(t or "") >= 30_000}
    assert sorted(repr(tuple(r)) for r in got if r["doc_id"] not in big) == want
    assert len(got) == len(rows)
    assert sum(r["n_runs"] > 0 for r in got) > 10


def test_collapsed_texts(spark, edges):
    rows = {r["doc_id"]: r for r in periodic_runs.with_runs(frame(spark, edges).withColumns({"runs": F.lit("x"), "N_Runs": F.lit(1), "row": F.lit(2)})).collect()}
    assert rows[10]["collapsed"] == "a b" and [tuple(r) for r in rows[10]["runs"]] == [(0, 18_000, 2)]
    assert rows[11]["collapsed"] == "é中文 x" and rows[1]["collapsed"] == rows[3]["collapsed"] == ""
    assert rows[8]["collapsed"] == dict(edges)[8] and rows[4]["row"] == 2 and rows[4]["lang"] == "en"
    assert periodic_runs.with_runs(frame(spark, [])).count() == 0
    assert periodic_runs.run_digests(frame(spark, [])).count() == 0


# ---- 12 ------------------------------------------------------------------------------------


def plain(text):
    return re.sub("[\x20\x09-\x0d]", "", text or "")


def check_groups(rows, got):
    last = 1 << 63
    groups = {}
    for i, t in rows:
        groups.setdefault(plain(t), []).append((-len(t or ""), last if i is None else i, i))
    want = sorted(repr((i, min(groups[plain(t)])[2], len(groups[plain(t)]), hashlib.sha256(plain(t).encode()).hexdigest())) for i, t in rows)
    assert sorted(repr((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"])) for r in got) == want
    kept = [r for r in got if r["kept"]]
    assert sorted(plain(r["text"]) for r in kept) == sorted(groups)
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


def test_copies_match_a_plain_version(spark, some, edges):
    rows = edges + some + [(50_000 + i, f" {t}" if i % 3 else t) for i, t in some[:60]]
    check_groups(rows, exact_dedup.mark_copies(frame(spark, rows)).collect())


def test_bytes_tell_equal_hashes_apart(spark, some, edges):
    rows = edges + some[:40]
    check_groups(rows, exact_dedup.mark_copies(frame(spark, rows), content_hash=lambda c: F.lit("same")).collect())


def test_a_group_of_a_third_of_all_rows(spark):
    rows = [(i, "copied text" if i % 3 == 0 else f"own text {i % 1900}") for i in range(6000)]
    check_groups(rows, exact_dedup.mark_copies(frame(spark, rows).repartition(7)).collect())


def test_copies_keep_columns_of_any_name(spark, edges):
    docs = frame(spark, edges).withColumns({c: F.lit(c) for c in ("_key", "_sha", "_row", "_points", "_plain", "_best", "_size", "Kept", "keep_id")})
    out = exact_dedup.mark_copies(docs)
    assert [c.lower() for c in out.columns] == ["doc_id", "text", "lang", "source", "n_chars", "_key", "_sha", "_row", "_points", "_plain", "_best", "_size", "keep_id", "group_size", "kept", "text_sha256"]
    rows = out.collect()
    assert all(r["_row"] == "_row" and r["_best"] == "_best" for r in rows)
    check_groups(edges, rows)
    assert exact_dedup.drop_copies(docs).count() == len({plain(t) for _, t in edges})
    assert exact_dedup.mark_copies(frame(spark, [])).count() == 0


# ---- 13 ------------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int"


def mined(vectors, **options):
    return sorted((tuple(r) for r in hard_negatives.mine_negatives(vectors, F.col("vec_id") % 10 == 0, **options).collect()), key=repr)


def clustered(n, seed=5):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 16))
    out = []
    for i in range(n):
        v = (centres[rng.integers(6)] + 0.4 * rng.normal(size=16)) * rng.choice([0.1, 1, 3])
        out.append((i, [float(np.float32(x)) for x in v], int(rng.integers(4))))
    return out


def test_negatives_match_brute_force(spark):
    rows = clustered(700)
    rows += [(i + 1000, *rows[i][1:]) for i in range(0, 60, 3)] + [(5, *rows[5][1:]), (10, *rows[10][1:])]
    want = brute.hard_negatives(rows, lambda i: i % 10 == 0)
    frame = spark.createDataFrame(rows, VECTORS)
    assert len(want) > 500
    assert mined(frame) == want
    assert mined(frame, shard_rows=64, slice_rows=7) == want


def test_negatives_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = clustered(60)
    rows += [(100, None, 1), (110, [], 1), (120, [nan] * 16, 1), (130, [inf] + [0.0] * 15, 2), (140, [1.0] * 15 + [None], 2), (150, rows[0][1], None)]
    rows += [(160, [0.0] * 16, 0), (161, [0.0] * 16, 0), (162, [0.0] * 16, 1), (None, rows[20][1], 1), (None, rows[20][1], 2), (170, [1.0, 2.0], 1), (171, [1.0, 2.5], 1), (172, [1.0, 2.25], 3)]
    want = brute.hard_negatives(rows, lambda i: i % 10 == 0)
    out = spark.createDataFrame(rows, VECTORS).withColumns({"row": F.lit("x"), "dim": F.lit("y"), "asks": F.lit(1), "id": F.lit(2)})
    assert mined(out) == want and any(a == 160 for a, *_ in want) and any(a == 170 for a, *_ in want) and any(n is None for _, _, _, n, _, _ in want)
    assert mined(spark.createDataFrame([], VECTORS)) == []


def test_large_components_are_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(10**6, 4 * 10**6, 4)], i % 2) for i in range(40)]
    assert mined(spark.createDataFrame(rows, VECTORS.replace("float", "double"))) == brute.hard_negatives(rows, lambda i: i % 10 == 0)


def test_pruning_leaves_rows_out():
    """Buckets and ranges hold far fewer candidates than rows, and all that reach the bound."""
    rng = np.random.default_rng(8)
    whole = np.floor(256 * rng.normal(size=(3000, 32)) ** 3 * rng.choice([0.2, 1], 3000)[:, None]).astype(np.int64)
    long = np.argsort(-(whole.astype(float) ** 2).sum(1))
    index = hard_negatives.Index(whole, np.arange(3000))
    met = 0
    for q in whole[long[::40]][:30]:
        length = float(np.sqrt((q.astype(float) ** 2).sum()))
        focus = np.argsort(-np.abs(q), kind="stable")[: hard_negatives.FOCUS]
        least = 0.8 * float(q @ q)
        found = np.concatenate([b.candidates(q / length, length, focus, least) for b in index.buckets])
        met += len(found)
        assert set(np.flatnonzero(whole @ q >= least)) <= set(found.tolist())
    assert met < 0.2 * 30 * 3000


# ---- 8 -------------------------------------------------------------------------------------


def bucket(*words):
    """Spark's xxhash64 of some strings, by buckets."""
    h = 42
    for w in words:
        h = xxhash.xxh64_intdigest(w.encode(), seed=h)
    return (h - (1 << 64) if h >> 63 else h) % quality.BUCKETS


def grams_of(text):
    w = [x.lower() for x in brute.words(text)]
    return [bucket(x) for x in w] + [bucket(a, b) for a, b in zip(w, w[1:])]


def test_scores_and_verdicts_match_a_plain_version(spark, some, data):
    rows = some + [(9000, None), (9001, ""), (9002, "word " * 60), (9003, some[0][1]), (9004, " ".join(f"New{i}" for i in range(70)))]
    labels = pq.read_table(f"{data}/labels.parquet").to_pandas()
    trusted = {int(i) for i in labels[labels.quality == 1].doc_id} | {9004}
    corpus, target = Counter(), Counter()
    for i, t in rows:
        corpus.update(grams_of(t))
        if i in trusted:
            target.update(grams_of(t))
    n, m = sum(corpus.values()), sum(target.values())
    weight = {b: round(math.log((target[b] / m + c / n) / 2) - math.log(c / n), 6) for b, c in corpus.items()}
    out = quality.with_quality(frame(spark, rows), spark.createDataFrame([(i,) for i in trusted], "doc_id long")).collect()
    assert len(out) == len(rows) and len({r["kept"] for r in out}) == 2
    plain = dict(rows)
    for r in out:
        grams = grams_of(plain[r["doc_id"]])
        score = sum(weight[b] for b in grams) / len(grams) if grams else 0.0
        assert abs(r["score"] - score) < 2e-6
        *base, failed = brute.base_measures(plain[r["doc_id"]])
        assert [r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] == base and r["base_failed"] == failed
        if abs(score - quality.THRESHOLD) > 1e-5:
            assert r["kept"] == (not failed and score >= quality.THRESHOLD)


# ---- 10 ------------------------------------------------------------------------------------


def test_odd_conversations(spark):
    """Repeated turns, equal turn numbers, nulls, very long texts, control strings and clashing columns."""
    long = "x </turn> \\ ### " * 20_000
    rows = [(1, 0, "user", "hi"), (1, 0, "user", "hi"), (1, 1, "assistant", "b"), (1, 1, "assistant", "a"), (1, None, "user", None), (2, 0, "assistant", long), (2, 1, "user", ""), (3, 5, None, None), (None, 0, "user", "no id"), (None, 1, "assistant", "### user: x")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit("z") for c in ("turns", "loss", "_loss", "example", "formatted", "late")})
    got = {r["conv_id"]: r for r in chat.chat_digests(table).collect()}
    assert set(got) == {1, 2, 3, None}
    for conv in got:
        turns = sorted(((t is None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv))
        said = "".join(f"{r}\n{x}\n" for *_, r, x in turns)
        loss = "".join(x for *_, r, x in turns if r == "assistant")
        r = got[conv]
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())


# ---- pipeline ------------------------------------------------------------------------------


def test_the_pipeline_leaves_its_result_only(spark, data):
    folder = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(folder))
    out = corpus_pipeline.run(spark, data)
    made = set(os.listdir(folder)) - before
    assert len(made) == 1 and "byte-level" in made.pop()
    assert out.count() > 0 and out.columns == [*corpus_pipeline.COLUMNS, "ids"]
