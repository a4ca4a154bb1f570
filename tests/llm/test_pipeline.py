"""Each stage of the pipeline on what the one before kept, against plain versions."""

import random

import pytest
import regex
import public_tokenizers
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from pressloom.llm import bpe, mixing, toxicity
from pressloom.llm.queries import RANKS

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LAST = (1 << 63) - 1  # stands for a null id


@pytest.fixture(scope="module")
def kept(spark, data, tmp_path_factory):
    """The rows after each stage, the input first; some copies and passages are added to the documents."""
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = [tuple(r) for r in docs.select(*COLUMNS).collect()]
    rng = random.Random(7)
    passage = " ".join(f"passage{i}" for i in range(55))
    for i in range(40):
        doc_id, text, lang, source, _ = rng.choice(rows)
        words = text.split()
        words[rng.randrange(len(words))] = "changed"
        text = " ".join(words) if i % 2 else f"{i} before {passage} after {i} " + " ".join(f"own{i}x{j}" for j in range(60))
        rows.append((10_000 + i, text, lang, source, len(text)))
    rows.append((20_000, None, None, None, None))
    # copies without an id, or with one that another text has too
    for i in range(4):
        text = " ".join(f"copied{i}x{j}" for j in range(70))
        near = text.replace(f"copied{i}x35 ", "changed ")
        rows += [(None if i % 2 else 30_000, t, "en", "s", len(t)) for t in (text, text, near)]
    spark.createDataFrame(rows, docs.select(*COLUMNS).schema).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{data}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    tables, frames = [], []
    now = spark.read.parquet(f"{folder}/documents.parquet")
    tables.append([r.asDict() for r in now.collect()])
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        frames.append(now)
        stage(spark, now, folder).write.parquet(f"{folder}/out{k}")
        now = spark.read.parquet(f"{folder}/out{k}")
        tables.append([r.asDict() for r in now.collect()])
    return folder, tables, frames


def ids(rows):
    return sorted(LAST if r["doc_id"] is None else r["doc_id"] for r in rows)


def test_stages_keep_the_columns(kept):
    _, tables, _ = kept
    assert all(list(t[0]) == COLUMNS for t in tables[:-1]) and list(tables[-1][0]) == [*COLUMNS, "ids"]


def test_toxic_documents_go(spark, kept):
    folder, tables, frames = kept
    model = toxicity.fit_toxicity(frames[0], spark.read.parquet(f"{folder}/labels.parquet"))
    clean = toxicity.with_toxicity(frames[0], model).filter(F.col("score") < toxicity.REJECT_FROM).select("doc_id").collect()
    assert ids(clean) == ids(tables[1])


def test_one_of_each_group_stays(kept):
    _, tables, _ = kept
    rows = sorted((LAST if r["doc_id"] is None else r["doc_id"], r["text"] or "") for r in tables[1])
    of = brute.jaccard_components([(k, t) for k, (_, t) in enumerate(rows)], 5, 80, 100)
    groups = {}
    for k, (i, t) in enumerate(rows):
        groups.setdefault(of[k][1], []).append((i, t))
    kept = [(LAST if r["doc_id"] is None else r["doc_id"], r["text"] or "") for r in tables[2]]
    # one row of each group, of the smallest id
    assert ids(tables[2]) == sorted(min(i for i, _ in g) for g in groups.values())
    assert all(len(set(g) & set(kept)) == 1 for g in groups.values())
    assert len(tables[2]) < len(tables[1])


def test_repeated_passages_are_cut(kept):
    _, tables, _ = kept
    rows = sorted((LAST if r["doc_id"] is None else r["doc_id"], r["text"] or "") for r in tables[2])
    want = brute.removed_repeats([(k, t) for k, (_, t) in enumerate(rows)])
    left = sorted((LAST if r["doc_id"] is None else r["doc_id"], len(brute.words(r["text"]))) for r in tables[3])
    assert left == sorted((rows[k][0], n - gone) for k, (n, gone, _) in want.items())
    assert all(r["n_chars"] == (len(r["text"]) if r["text"] is not None else None) for r in tables[3])
    assert sum(gone for _, gone, _ in want.values()) > 300


def test_the_mix_emits_its_copies(kept):
    _, tables, frames = kept
    copies = mixing.mix_sources(frames[3]).collect()
    assert ids(tables[4]) == ids([r for r in copies for _ in range(r["copies"])])


def test_ids_are_the_text_s(kept):
    _, tables, _ = kept
    encoder = bpe.encoder(RANKS)
    assert sorted((r["doc_id"] or LAST, r["text"]) for r in tables[5]) == sorted((r["doc_id"] or LAST, r["text"] or "") for r in tables[4])
    for r in tables[5]:
        assert r["ids"] == [i for p in regex.findall(public_tokenizers.PATTERN, r["text"]) for i in encoder.encode(p.encode())]
