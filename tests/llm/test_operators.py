"""Each operator against a plain version, on a small table and on edge rows."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import brute
from pressloom.llm import bpe, chat, embedding_dedup, mixing, ngram_join, pretokens, quality, sharding, substring_dedup, token_files, toxicity
from pressloom.llm.components import components
from pressloom.llm.queries import RANKS, TOKENIZER

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS)


@pytest.fixture(scope="module")
def some(data):
    t = pq.read_table(f"{data}/documents.parquet").to_pandas()
    return [(int(i), x) for i, x in zip(t.doc_id, t.text)]


@pytest.fixture(scope="module")
def edges(spark):
    """Nulls, empty, blank and very long texts, ties, repeated rows, clashing column names."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(20_000))
    rows = [(1, None, None), (2, "", "a"), (3, " \t\n", "a"), (4, "One two", "b"), (5, "one TWO", "b"), (5, "one TWO", "b"), (6, long, "a"), (7, long + " tail", "a")]
    rows += [(None, "no id here at all", "b"), (8, "é中文 ' 's 've 12 ｆｕｌｌ", None)]
    return frame(spark, rows).withColumns({"score": F.lit("x"), "size": F.lit("y"), "Slot": F.lit(1), "ids": F.lit("z"), "n_words": F.lit("q")})


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


# ---- 1 -------------------------------------------------------------------------------------


def test_hypergeometric_matches_its_mean_and_bounds():
    rng = np.random.default_rng(0)
    drawn = [sharding.hypergeometric(rng, 30, 70, 20) for _ in range(4000)]
    assert 0 <= min(drawn) and max(drawn) <= 20
    assert abs(np.mean(drawn) - 6) < 0.15
    assert abs(np.var(drawn) - 20 * 0.3 * 0.7 * 80 / 99) < 0.3
    big = sharding.hypergeometric(rng, 3 * 10**10, 5 * 10**10, 4 * 10**10)
    assert abs(big - 1.5 * 10**10) < 10**6


def test_matrix_has_exact_margins():
    rows = sharding.communication_rows(np.random.default_rng(1), [5, 0, 7, 100], [28, 28, 28, 28])
    assert [sum(r) for r in rows] == [5, 0, 7, 100] and [sum(c) for c in zip(*rows)] == [28] * 4


def test_shards_hold_every_row_once(spark, some, edges, empty):
    docs = frame(spark, [(i, t, "s") for i, t in some])
    got = sharding.shuffle_into_shards(docs, 7, bucket_rows=10).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(i for i, _ in some)
    slots = {j: sorted(r["slot"] for r in got if r["shard"] == j) for j in range(7)}
    assert all(x == list(range(len(x))) for x in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    out = sharding.shuffle_into_shards(edges, 3)
    assert "Slot" not in out.columns and out.count() == edges.count()
    assert sharding.shard_digests(empty).count() == 0


# ---- 2 -------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model(spark, data):
    docs = spark.read.parquet(f"{data}/../sf0.01/documents.parquet")
    return toxicity.fit_toxicity(docs, spark.read.parquet(f"{data}/../sf0.01/labels.parquet"))


def test_held_out_documents(spark, data, model):
    folder = f"{data}/../sf0.01"
    scored = toxicity.with_toxicity(spark.read.parquet(f"{folder}/documents.parquet"), model)
    rows = scored.filter(toxicity.held_out(F.col("doc_id"))).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").select("score", "toxic").collect()
    bad, good = [r["score"] for r in rows if r["toxic"]], [r["score"] for r in rows if not r["toxic"]]
    assert np.mean([b > g for b in bad for g in good]) > 0.85
    assert np.mean([g >= toxicity.REJECT_FROM for g in good]) < 0.02


@pytest.mark.parametrize("hidden", ["1d10t", "i d i o t", "i.d.i.o.t", "idiooooot", "1diiiot", "m0r0n", "w0rthl3ss", "s-t-u-p-i-d"])
def test_hidden_words_are_restored(model, hidden):
    plain = {"1d10t": "idiot", "i d i o t": "idiot", "i.d.i.o.t": "idiot", "idiooooot": "idiot", "1diiiot": "idiot", "m0r0n": "moron", "w0rthl3ss": "worthless", "s-t-u-p-i-d": "stupid"}
    decoder = toxicity.Decoder(model.grams)
    assert decoder.restore(f"The {hidden} there, ok.") == f"the {plain[hidden]} there ok"


@pytest.mark.parametrize("hidden", ["i d ! o t", "1  d 1\t0 t", "i  d  i  o  t", "i\nd\ni\no\nt", "idi000t", "id111ot", "iiddiioott", "11ddii00tt"])
def test_signs_and_repeats_hide_nothing(model, hidden):
    assert toxicity.Decoder(model.grams).restore(f"The {hidden} there, ok.") == "the idiot there ok"


@pytest.mark.parametrize("plain", ["4.0", "555-7713", "2017", "1 2 3", "000", "letter", "committee"])
def test_numbers_and_doubled_letters_stay(model, plain):
    assert toxicity.Decoder(model.grams).restore(f"some {plain} there") == f"some {plain} there"


@pytest.mark.parametrize("hidden", ["4$$", "455", "@ s s", "4 $ $"])
def test_words_of_signs_only(spark, hidden):
    decoder = toxicity.Decoder(toxicity.count_grams(spark.createDataFrame([("ass " * 2000,)], "text string")))
    assert decoder.restore(f"{hidden} and") == "ass and" and decoder.restore("2017") == "2017"


def test_features_of_many_texts_are_those_of_their_words(model):
    odd = ["", " \n", "a", "The (idiot), 1d10t! $tupid$ a$$ word$$$ --end--", "i d i o t and a b c", "llamall ssoo aaah aaaah é éé ééé", "ΟΔΟΣ İstanbul Straße ﬁne 日本語 𝒳𝒴𝒵𝒳𝒴𝒵𝒳 ciónasbo"]
    odd += ["x" * 3, "ab" * 20, "ab" * 21, "." * 9 + "far" + "!" * 9, "one\u00a0two\u2003three\x1cfour\x85five", "4.0 555-7713 mail@host.example password=15959ad93"]
    decoder, r = toxicity.Decoder(model.grams), random.Random(3)
    odd += [" ".join(r.choice(["", "(", "--"]) + "".join(r.choices("aabeost1éñ日", k=r.randint(1, 9))) + r.choice(["", ".", ",\"", "$"]) for _ in range(30)) for _ in range(40)]
    plain = [(i, x) for i, t in enumerate(odd) for x in {y for w in decoder.unspaced(t.lower()).split() for y in toxicity.word_features(decoder.word(w))}]
    assert [*zip(*(x.tolist() for x in toxicity.text_features(odd, decoder, {})))] == sorted(plain)
    numbers = toxicity.feature_numbers(model.wanted)
    assert [*zip(*(x.tolist() for x in toxicity.text_features(odd, decoder, {}, numbers)))] == sorted((i, model.wanted[x]) for i, x in plain if x in model.wanted)


def test_fit_goes_through_blocks_of_rows(monkeypatch):
    r = np.random.default_rng(2)
    rows = [np.unique(r.integers(0, 20, r.integers(0, 9))).astype(np.int32) if i % 7 else np.zeros(0, np.int32) for i in range(500)]
    toxic = np.array([float(3 in x or 5 in x or not i % 11) for i, x in enumerate(rows)])
    whole = toxicity.fit(rows, toxic, 20)
    monkeypatch.setattr(toxicity, "FIT_BLOCK", 40)
    parted = toxicity.fit(rows, toxic, 20)
    assert np.allclose(whole[0], parted[0], atol=1e-10) and abs(whole[1] - parted[1]) < 1e-10
    # near the least of the penalised loss no weight is pulled far
    p = 1 / (1 + np.exp(-np.array([whole[0][x].sum() + whole[1] for x in rows])))
    pull = 0.3 * whole[0] + np.bincount(np.concatenate(rows), np.repeat(p - toxic, [len(x) for x in rows]), minlength=20)
    assert np.abs(pull).max() < 0.05
    assert toxicity.fit([np.zeros(0, np.int32)] * 4, np.array([0.0, 1, 0, 0]), 0)[0].shape == (0,)


def test_grams_are_summed_in_a_few_jobs(spark):
    texts = ["One two, 3", None, "", "é l'été ", "a"]
    spark.sparkContext.setJobGroup("grams", "grams")
    try:
        counts = toxicity.count_grams(spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("grams")) <= 3
    seen, wanted = " one two é l été a ", np.zeros_like(counts)
    for k in range(toxicity.ORDERS):
        for i in range(len(seen) - k):
            wanted[k, toxicity.gram_bucket(seen[i : i + k + 1])] += 1
    assert (counts == wanted).all()


def test_long_rows_of_a_sign_are_decoded_in_time(model):
    decoder = toxicity.Decoder(model.grams)
    assert decoder.word("o" * 300 + "h1") and not toxicity.DOUBLED.fullmatch("o" * 300 + "h")
    assert [bool(toxicity.DOUBLED.fullmatch(x)) for x in ("aa", "aaa", "aaaa", "aabb", "aabbc", "aab", "$$00")] == [False, False, True, True, False, False, True]


def test_toxicity_edges(spark, edges, empty, model):
    rows = toxicity.with_toxicity(edges, model, restored="restored").collect()
    assert len(rows) == edges.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["score"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1 / (1 + np.exp(-model.intercept))}
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.toxicity_scores(empty, labels).count() == 0
    alike = toxicity.toxicity_scores(edges.select("doc_id", "text"), labels).select("score").distinct().collect()
    assert [r["score"] for r in alike] == [0.5]


# ---- 3 -------------------------------------------------------------------------------------


def near_copies():
    """A base with copies of more and more changed words, copies of copies, and short texts."""
    rng = random.Random(3)
    base = [f"word{i}" for i in range(120)]
    out = [(0, " ".join(base))]
    for i in range(1, 120):
        w = list(rng.choice(out)[1].split()) if i % 3 else list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
            w[rng.randrange(len(w))] = f"other{rng.randrange(10_000)}"
        out.append((i, " ".join(w)))
    out += [(200 + i, " ".join(f"s{j}" for j in range(i % 4))) for i in range(12)]
    long = [f"l{i}" for i in range(600)]
    for i in range(30):
        w = list(long)
        for _ in range(i):
            w[rng.randrange(600)] = f"x{rng.randrange(10_000)}"
        out.append((300 + i, " ".join(w)))
    return out


@pytest.mark.parametrize(("size", "num", "pair_sets"), [(3, 90, 256), (5, 80, 256), (3, 90, 100), (3, 90, 0)])
def test_jaccard_join_finds_every_link(spark, size, num, pair_sets):
    docs = near_copies()
    got = ngram_join.jaccard_components(frame(spark, [(i, t, "s") for i, t in docs]), size, num, 100, pair_sets).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute.jaccard_components(docs, size, num)


def test_jaccard_join_with_frequent_tokens(spark, some, monkeypatch):
    docs = near_copies() + [(1000 + i, t) for i, t in some]
    got = ngram_join.jaccard_components(frame(spark, [(i, t, "s") for i, t in docs])).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute.jaccard_components(docs)


def changed(i, k=120):
    """A text of ``k`` words, and the same with one word changed."""
    w = [f"own{i}x{j}" for j in range(k)]
    return " ".join(w), " ".join([*w[:60], f"other{i}", *w[61:]])


def test_rows_of_one_id_keep_all_their_links(spark):
    """Twelve rows of id 500 (or none), each a near copy of another document."""
    docs = [(i, changed(i)[0], "s") for i in range(1, 13)]
    for again in range(2):
        got = ngram_join.jaccard_components(frame(spark, docs + [(500, changed(i)[1], "s") for i in range(1, 13)]).repartition(3 + again)).collect()
        assert {(r["doc_id"], r["component_id"]) for r in got} == {(i, 1) for i in [*range(1, 13), 500]} and len(got) == 24
        got = ngram_join.jaccard_components(frame(spark, docs + [(None, changed(i)[1], "s") for i in range(1, 13)]).repartition(3 + again)).collect()
        assert sorted((r["doc_id"] or 0, r["component_id"]) for r in got) == sorted([(i, i) for i in range(1, 13)] + [(0, i) for i in range(1, 13)])


def test_one_row_of_a_group_stays(spark):
    docs = [(i, changed(i)[0], "s") for i in range(1, 13)] + [(500, changed(i)[1], "s") for i in range(1, 7)] + [(None, changed(i)[1], "s") for i in range(4, 13)]
    docs += [(7, "seven words that stand here alone twice", "s")] * 2 + [(None, "eight words that stand without any id twice", "s")] * 2
    docs += [(600, None, "a"), (600, None, "a"), (None, " ", "b"), (None, "", "b"), (None, "", "b")]
    kept = ngram_join.drop_near_copies(frame(spark, docs).withColumns({"_doc": F.lit(1), "least": F.lit(2)}), 3, 90).collect()
    want = [(i, changed(i)[0]) for i in range(1, 13)] + [(7, docs[-9][1]), (None, docs[-7][1])] + [(i, t) for i, t, _ in docs[-5:]]
    assert sorted(map(repr, want)) == sorted(repr((r["doc_id"], r["text"])) for r in kept)
    assert all(r["_doc"] == 1 and r["least"] == 2 for r in kept)


def test_large_groups_of_copies(spark):
    """A third of all rows is one text, a third near copies of another."""
    docs = [(i, "one text that very many rows have in common") for i in range(400)]
    docs += [(1000 + i, " ".join([f"w{j}" for j in range(100)] + [f"end{i}"])) for i in range(150)]
    docs += [(2000 + i, f"a text of its own number {i} and nothing else {i * 7}") for i in range(300)]
    got = ngram_join.jaccard_components(frame(spark, [(i, t, "s") for i, t in docs])).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: 0 if i < 400 else 1000 if i < 2000 else i for i, _ in docs}
    assert ngram_join.drop_near_copies(frame(spark, [(i, t, "s") for i, t in docs]), 3, 90).count() == 302


def test_jaccard_edges(edges, empty):
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_components(edges).collect()}
    assert {(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (None, 3, None)} <= got
    assert {(i, c) for i, _, c in got} >= {(6, 6), (7, 6)}
    assert ngram_join.jaccard_components(empty).count() == 0


# ---- 4 -------------------------------------------------------------------------------------


def test_wavelet_matrix_against_the_plain_sequence():
    rng = np.random.default_rng(5)
    for n, top in ((1, 1), (10, 2), (9000, 50257), (20_000, 3)):
        ids = rng.integers(0, top, n).astype(np.uint32)
        m = token_files.WaveletMatrix.from_bytes(token_files.WaveletMatrix.build(ids).to_bytes())
        assert (m.decode() == ids).all()
        for i in rng.integers(0, n, 20).tolist():
            token = int(ids[i])
            assert m.access(i) == token
            assert m.rank(token, i) == int((ids[:i] == token).sum())
            places = np.flatnonzero(ids == token)
            k = int(rng.integers(0, len(places)))
            assert m.locate(token, k) == places[k]
        assert m.locate(int(ids[0]), n) == -1 and m.rank(1 << 20, n) == 0


def test_a_question_inflates_few_chunks():
    ids = np.random.default_rng(6).integers(0, 50257, 1_500_000).astype(np.uint32)
    data = token_files.WaveletMatrix.build(ids).to_bytes()
    whole = 16 * -(-len(ids) // 8 // token_files.CHUNK)
    for ask in (lambda m: m.access(777_777), lambda m: m.rank(int(ids[5]), 1_234_567), lambda m: m.locate(int(ids[5]), 3)):
        m = token_files.WaveletMatrix.from_bytes(data)
        ask(m)
        assert 0 < sum(p.inflated for p in m.planes) <= 64 < whole


def test_wavelet_matrix_of_no_ids():
    m = token_files.WaveletMatrix.from_bytes(token_files.WaveletMatrix.build(np.zeros(0, np.uint32)).to_bytes())
    assert m.decode().tolist() == [] and m.rank(3, 0) == 0 and m.locate(3, 0) == -1


def test_token_files_round_trip(spark, some, edges, empty):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    docs = [(i, t) for i, t in some] + [(-5, None), (10**9, "<|endoftext|> it's"), (10**9 + 1, "a <|endoftext|> b"), (10**9 + 2, "x" * 9000 + "<|endoftext|><|endoftext|>")]
    files = token_files.write_token_files(frame(spark, [(i, t, "s") for i, t in docs]), TOKENIZER, 2, shard_ids=5000)
    got = {r["doc_id"]: (r["start"], list(r["ids"])) for r in token_files.read_token_files(files).collect()}
    at = 0
    for i, t in sorted(docs):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        assert got[i] == (at, ids)
        at += len(ids)
    assert got[10**9 + 1][1] == [64, 220, 50256, 275, 2]
    assert files.count() > 3
    assert token_files.token_file_digests(edges, TOKENIZER).count() == edges.count()
    assert token_files.token_file_digests(empty, TOKENIZER).count() == 0


# ---- 5 -------------------------------------------------------------------------------------


def test_pieces_are_the_pattern_s():
    pattern = regex.compile(public_tokenizers.PATTERN)
    rng = random.Random(1)
    for _ in range(1500):
        texts = ["".join(rng.choice("ab'stmdrevl  \n\t1２é中!? 　'’\r") for _ in range(rng.randint(0, 14))) for _ in range(5)]
        found = pretokens.pieces(texts)
        assert [[found.distinct[j] for j in found.number[a:b]] for a, b in zip(found.rows[:-1], found.rows[1:])] == [pattern.findall(t) for t in texts]


@pytest.fixture(scope="module")
def plain_bpe():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_merges_are_the_library_s(plain_bpe):
    encoder = bpe.encoder(RANKS)
    rng = random.Random(2)
    texts = ["".join(rng.choice("abababaa theing éx中") for _ in range(rng.randint(1, 40))) for _ in range(2000)] + ["a" * 5000, "ab" * 3000, "the" * 2000]
    texts = [p for t in texts for p in regex.findall(public_tokenizers.PATTERN, t)]
    ids, stops = encoder.encode_many([t.encode() for t in texts])
    assert [ids[a:b].tolist() for a, b in zip(stops[:-1], stops[1:])] == [plain_bpe.encode_ordinary(t) for t in texts]


def test_bpe_against_the_library(spark, some, edges, empty, plain_bpe):
    docs = some + [(-1, None)]
    got = {r["doc_id"]: tuple(r)[1:] for r in bpe.bpe_digests(frame(spark, [(i, t, "s") for i, t in docs]), RANKS).collect()}
    for i, t in docs:
        ids = plain_bpe.encode_ordinary(t or "")
        assert got[i] == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
    coded = bpe.decode_bpe(bpe.encode_bpe(edges, RANKS), RANKS).select("text", F.col("decoded").cast("string").alias("d")).collect()
    assert all((r["text"] or "") == r["d"] for r in coded)
    assert bpe.bpe_digests(empty, RANKS).count() == 0


# ---- 6 -------------------------------------------------------------------------------------


def plain_targets(sizes, cap=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    left, open_, out = float(sum(sizes.values())), set(names), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = {s for s in open_ if share[s] > cap * sizes[s]}
        if not above:
            return out | share
        for s in above:
            out[s] = cap * sizes[s]
            left -= out[s]
        open_ -= above
    return out


def test_mix_meets_its_targets(spark, edges, empty):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.choice([1, 3, 30, 200])), rng.choice([None, "a", "b", "b", "b", "b", "", "ü"])) for i in range(3000)] + [(9999, None, "zero")]
    docs = frame(spark, rows)
    got = mixing.mix_sources(docs).collect()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(brute.words(t))
    want = plain_targets(sizes)
    assert len(got) == len(rows)
    for s in sizes:
        own = [r for r in got if r["source"] == s]
        assert own[0]["source_size"] == sizes[s] and own[0]["target"] == pytest.approx(want[s])
        assert abs(sum(r["taken"] for r in own) - want[s]) <= 0.02 * want[s] + 400
    assert all(r["taken"] == r["copies"] * r["size"] <= 3 * r["size"] for r in got)
    again = mixing.mix_sources(docs.repartition(3)).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in again) == sorted((r["doc_id"], r["taken"]) for r in got)
    mixed = mixing.mix_sources(edges)
    assert mixed.count() == edges.count()
    assert mixing.emit_copies(mixed).count() == mixed.agg(F.sum("copies")).first()[0]
    assert mixing.mix_sources(empty).count() == 0


# ---- 7 -------------------------------------------------------------------------------------


def test_repeats_against_brute_force(spark, some, edges, empty, monkeypatch):
    rng = random.Random(6)
    passage = [f"p{i}" for i in range(60)]
    docs = list(some) + [(5000 + i, " ".join([f"a{i}", *passage[rng.randrange(30) :], f"b{i}", *passage[: rng.randrange(15, 40)]])) for i in range(200)]
    docs += [(9000, "x " * 100), (9001, None)]
    want = brute.removed_repeats(docs)
    for held in (2_000_000, 500):
        monkeypatch.setattr(substring_dedup, "HELD_WINDOWS", held)
        got = substring_dedup.repeat_digests(frame(spark, [(i, t, "s") for i, t in docs]).repartition(5)).collect()
        assert {r["doc_id"]: tuple(r)[1:] for r in got} == want
    out = {(r["doc_id"], r["n_removed"]) for r in substring_dedup.remove_repeats(edges).collect()}
    assert {(6, 0), (7, 20_000), (1, 0), (None, 0)} <= out
    assert substring_dedup.repeat_digests(empty).count() == 0


# ---- 8 -------------------------------------------------------------------------------------


def test_base_measures(spark, some, edges, empty, data):
    docs = some + [(-1, None), (-2, "a b c a b c " * 20), (-3, "x\nx\n\n \nx")]
    frame_of = frame(spark, [(i, t, "s") for i, t in docs])
    labels = spark.read.parquet(f"{data}/labels.parquet")
    out = quality.with_quality(frame_of, labels.filter("quality = 1"))
    got = {r["doc_id"]: r for r in out.collect()}
    for i, t in docs:
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == brute.base_measures(t)
        assert r["kept"] == (not r["base_failed"] and r["score"] >= quality.THRESHOLD)
    assert quality.with_quality(edges, labels).count() == edges.count()
    assert quality.with_quality(empty, labels.limit(0)).count() == 0


def test_quality_tells_trusted_text_from_junk(spark):
    good = [(i, " ".join(f"good{(i * 7 + j) % 90}" for j in range(80)), "s") for i in range(40)]
    junk = [(100 + i, " ".join(f"junk{i}x{j}" for j in range(80)), "s") for i in range(10)]
    trusted = spark.createDataFrame([(i,) for i in range(0, 40, 2)], "doc_id long")
    kept = {r["doc_id"] for r in quality.with_quality(frame(spark, good + junk), trusted).filter("kept").collect()}
    assert kept == set(range(40))


def test_columns_of_any_name_pass_through(spark, some):
    """Names that the operators use inside themselves."""
    inner = ["_key", "_row", "_part", "_at", "_source", "_mark", "_class", "_salt", "_rank", "_before", "_each", "_offset", "_rows", "_words", "_size", "_copy", "_lines", "_windows", "_places", "_grams", "_id", "_trusted", "_weight", "_cap", "_level", "_doc", "_same", "_starts", "bucket", "n", "t"]
    plain = frame(spark, [(i, t, "s" if i % 2 else "r") for i, t in some[:50]])
    docs = plain.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in inner})
    trusted = plain.select("doc_id").limit(20)
    mixed = mixing.mix_sources(docs)
    made = {
        "shards": (sharding.shuffle_into_shards(docs, 3), None, ()),
        "mix": (mixed, mixing.mix_sources(plain), ("size", "source_size", "target", "copies", "taken")),
        "copies": (mixing.emit_copies(mixed).distinct(), None, ()),
        "quality": (quality.with_quality(docs, trusted), quality.with_quality(plain, trusted), quality.MEASURES),
        "repeats": (substring_dedup.remove_repeats(docs), substring_dedup.remove_repeats(plain), ("n_words", "n_removed")),
    }
    for name, (out, want, results) in made.items():
        rows = out.collect()
        assert len(rows) > (10 if name == "copies" else 49) and set(inner) <= set(out.columns), name
        assert all(r[c] == f"{c}{r['doc_id']}" for r in rows for c in inner), name
        if want is not None:
            assert sorted((r["doc_id"], *(r[c] for c in results)) for r in rows) == sorted((r["doc_id"], *(r[c] for c in results)) for r in want.collect()), name


def test_native_operators_use_no_python(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    for df in (mixing.mix_sources(docs), quality.with_quality(docs, docs.select("doc_id"))):
        assert not any(x in df._jdf.queryExecution().executedPlan().toString() for x in ("Python", "Pandas", "Arrow"))


# ---- 9 -------------------------------------------------------------------------------------


def test_embedding_links(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 16))
    rows, at = [], []
    for i in range(600):
        v = centres[i % 40] + rng.normal(size=16) * rng.choice([0.0, 0.1, 0.2, 0.4])
        rows.append((i, [float(np.float32(x)) for x in v], int(i % 3)))
        at.append(np.array(rows[-1][1]))
    bad = [(700, None, 1), (701, [0.0] * 16, 1), (702, [float("nan")] + [1.0] * 15, 1), (703, rows[0][1], None), (704, [], 1), (705, [1e300] * 16, 2), (706, [1e300] * 16, 2), (707, [None] + [1.0] * 15, 1)]
    frame_of = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, label int")
    at = np.stack(at)
    at /= np.linalg.norm(at, axis=1, keepdims=True)
    label = np.arange(600) % 3
    linked = (at @ at.T >= 0.93) & (label[:, None] == label[None]) & ~np.eye(600, dtype=bool)
    of = brute.smallest_reachable(range(600), [(int(a), int(b)) for a, b in zip(*np.nonzero(linked)) if a < b])
    for rows_a_shard in (8192, 60):
        got = {r["vec_id"]: r for r in embedding_dedup.embedding_components(frame_of, shard_rows=rows_a_shard).collect()}
        n = np.array([got[i]["n_links"] for i in range(600)])
        assert (n <= linked.sum(1)).all() and n.sum() >= 0.97 * linked.sum()
        assert np.mean([got[i]["component_id"] == of[i] for i in range(600)]) > 0.97
        assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in (700, 701, 702, 703, 704, 707))
        assert (got[705]["n_links"], got[706]["component_id"]) == (1, 705)
    assert embedding_dedup.embedding_components(frame_of.limit(0)).count() == 0


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_every_vector_searches_the_graph(monkeypatch):
    """Also where links are so sparse that the audit ends with the last vector."""
    rng = np.random.default_rng(4)
    x = unit(rng.normal(size=(700, 24)))
    x[650:] = unit(x[:50] + 0.02 * rng.normal(size=(50, 24)))
    graph, searches = embedding_dedup.Graph.build(x, 0), []
    plain = embedding_dedup.Graph.within
    monkeypatch.setattr(embedding_dedup.Graph, "within", lambda self, q, least, width: searches.append(width) or plain(self, q, least, width))
    found = embedding_dedup.linked(graph, x, 0.93, True)
    truth = (x @ x.T >= 0.93) & ~np.eye(700, dtype=bool)
    assert (found == truth).all() and truth.sum() == 100
    assert len(searches) >= 700 and max(searches) < 700
    # without what the audit saw
    hits = sum(int((truth[i] & np.isin(np.arange(700), plain(graph, x[i], 0.93, 16))).sum()) for i in range(700))
    assert hits >= 0.98 * truth.sum()


def test_vectors_without_id_and_repeated_rows(spark):
    v = [float(np.float32(a)) for a in np.random.default_rng(2).normal(size=8)]
    rows = [(None, v, 1), (None, v, 1), (4, v, 1), (4, v, 1), (5, [-a for a in v], 1), (None, None, None)]
    out = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({"point": F.lit(1), "copies": F.lit(2), "fine": F.lit("x")})
    got = sorted(((r["vec_id"] or -1, r["n_links"], r["component_id"] or -1, r["kept"]) for r in embedding_dedup.embedding_components(out).collect()))
    assert got == [(-1, 0, -1, True), (-1, 3, 4, False), (-1, 3, 4, False), (4, 3, 4, True), (4, 3, 4, True), (5, 0, 5, True)]


def test_a_group_wider_than_the_beam_is_found_across_shards():
    rng = np.random.default_rng(0)
    x = unit(np.concatenate([rng.normal(size=16) + rng.normal(size=(400, 16)) * 0.22, rng.normal(size=(600, 16))]))[rng.permutation(1000)]
    one, other = x[:500], x[500:]
    graph, truth = embedding_dedup.Graph.build(one, 0), other @ one.T >= 0.93
    assert truth.sum(1).max() > 5 * embedding_dedup.FIRST_BEAM
    found = [graph.within(q, 0.93, embedding_dedup.FIRST_BEAM) for q in other]
    assert all(truth[i, f].all() and len(set(f.tolist())) == len(f) for i, f in enumerate(found))
    assert sum(map(len, found)) >= 0.98 * truth.sum()


@pytest.mark.parametrize("giant, pairs", [(0, 12), (600, 300)])
def test_the_audit_sees_sparse_links_and_small_groups(giant, pairs):
    rng = np.random.default_rng(5)
    near = rng.normal(size=(pairs, 64))
    centre = rng.normal(size=64)
    one, other = (unit(np.concatenate([near + rng.normal(size=near.shape) * 0.15, centre + rng.normal(size=(giant, 64)) * 0.1, rng.normal(size=(1500, 64))])) for _ in range(2))
    truth = other @ one.T >= 0.93
    got = embedding_dedup.linked(embedding_dedup.Graph.build(one, 0), other, 0.93, False)
    assert truth[:pairs].sum() >= pairs and not (got & ~truth).any()
    assert got[:pairs].sum() >= 0.98 * truth[:pairs].sum()
    assert got.sum() >= 0.98 * truth.sum()
    same = embedding_dedup.linked(embedding_dedup.Graph.build(one, 0), one, 0.93, True)
    assert same.sum() >= 0.98 * ((one @ one.T >= 0.93).sum() - len(one)) and not same.diagonal().any()


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(500, 500 + i) for i in range(1, 50)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {500 + i: 500 for i in range(50)}


# ---- 10 ------------------------------------------------------------------------------------


def test_chat_round_trip(spark):
    rng = random.Random(9)
    signs = ["\\", "###", "</turn>", "### assistant:\n", "a", ":", "\n", "<", "#", "é"]
    chats = {c: [(rng.choice(["user", "assistant", "system", "a:b\n\\"]), "".join(rng.choice(signs) for _ in range(rng.randint(0, 12)))) for _ in range(rng.randint(1, 9))] for c in range(60)}
    rows = [(c, k, role, text) for c, turns in chats.items() for k, (role, text) in enumerate(turns)] + [(None, 0, None, None), (None, None, "assistant", "x")]
    rng.shuffle(rows)
    frame_of = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    chats[None] = [("", ""), ("assistant", "x")]
    examples = {}
    for r in chat.format_chats(frame_of).collect():
        examples.setdefault(r["conv_id"], []).append(r)
    for r in chat.chat_digests(frame_of).collect():
        turns = chats[r["conv_id"]]
        said = "".join(t for role, t in turns if role == "assistant")
        assert (r["n_turns"], r["loss_chars"], r["loss_sha256"]) == (len(turns), len(said), hashlib.sha256(said.encode()).hexdigest())
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        own = sorted(examples[r["conv_id"]], key=lambda x: x["example"])
        assert r["formatted_chars"] == sum(len(x["formatted"]) for x in own)
        trained = [x for x in own if x["loss_start"] is not None]
        assert len(trained) == sum(role == "assistant" for role, _ in turns)
        for x, upto in zip(trained, [k for k, (role, _) in enumerate(turns) if role == "assistant"]):
            assert chat.parse(x["formatted"]) == turns[: upto + 1]
            assert chat.unescape(x["formatted"][x["loss_start"] : x["loss_end"]]) == turns[upto][1]
    assert chat.chat_digests(frame_of.limit(0)).count() == 0


