"""The pipeline against its stages applied by brute force, and the registered queries."""

from __future__ import annotations

import random

import numpy as np
import pytest

import __spark_entry__
import corpus_pipeline
from sitemill.llm import simhash_dedup
from tests.llm.test_operators import components, prose


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("data"))
    r = random.Random(0)
    item, shared = prose(40, 900), prose(60, 901)
    docs, labels = [], []
    for i in range(300):
        words = prose(80, 1000 + i).split()
        toxic = i % 5 == 0 and i >= 10
        if toxic:
            words[r.randint(0, 70)] = "idiot"
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    docs += [(400, docs[1][1]), (401, docs[1][1].upper()), (402, prose(60, 7) + "\n" + shared), (403, prose(60, 8) + "\n" + shared), (404, prose(30, 9) + " " + item + " " + prose(30, 10)), (405, None), (406, ""), (407, None)]
    spark.createDataFrame([(a, b, "en", "src0", len(b or "")) for a, b in docs], "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").coalesce(1).write.parquet(f"{d}/benchmark.parquet")
    return d, dict(docs), {i for i, _, t in labels if t}, shared


def test_stages(spark, data, tmp_path):
    d, texts, toxic, shared = data
    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns = docs.columns
    left = []
    for k, (_, f) in enumerate(corpus_pipeline.STAGES):
        docs = f(spark, docs, d)
        docs.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        left.append({r["doc_id"]: r for r in docs.collect()})
        if k < 4:
            assert docs.columns == columns
    ids = set(texts)
    assert set(left[0]) == ids - toxic
    assert set(left[1]) == set(left[0]) - {400, 401, 406, 407}
    assert 1 in left[1] and not {400, 401, 406, 407} & set(left[1]) and 405 in left[1]
    assert set(left[2]) == set(left[1])
    assert shared in left[2][402]["text"] and shared not in left[2][403]["text"]
    assert left[2][403]["n_chars"] == len(left[2][403]["text"]) and left[2][405]["text"] is None
    assert all(left[2][i]["text"] == texts[i] for i in left[2] if i < 400)
    assert set(left[3]) == set(left[2]) - {404}
    assert set(left[4]) == set(left[3])


def jaccard_classes(texts, similarity=0.8):
    """Index -> smallest index of its class, by all pairs."""
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[a : a + 5]) for a in range(max(1, len(w) - 4))} if w else set())
    links = [(a, b) for a in range(len(sets)) for b in range(a) if len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b])]
    return components(range(len(sets)), links)


@pytest.mark.parametrize("sample,common,block", [(16, 4, 4096), (1, 2, 4096), (16, 4, 3)])
def test_near_copies_by_five_word_jaccard(spark, monkeypatch, sample, common, block):
    monkeypatch.setattr(simhash_dedup, "SAMPLE", sample)
    monkeypatch.setattr(simhash_dedup, "COMMON_IN_SAMPLE", common)
    monkeypatch.setattr(simhash_dedup, "PARITY_BITS", 64)
    r = random.Random(3)
    texts = []
    for i in range(40):
        words = prose(r.choice([6, 30, 120]), 3000 + i).split()
        for k in range(5):
            w = list(words)
            for _ in range(k if len(w) > 20 else k % 2):
                w[r.randrange(len(w))] = "edit"
            texts.append(" ".join(w))
    base = prose(140, 77).split()  # a large group, some of whose pairs are below the similarity
    for i in range(60):
        w = list(base)
        for _ in range(r.randrange(9)):
            w[r.randrange(len(w))] = f"x{r.random()}"
        texts.append(" ".join(w))
    texts += [None, "", " \n"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    root = jaccard_classes(texts)
    got = {x["doc_id"]: x["root"] for x in simhash_dedup.near_groups(df, block=block).collect()}
    first = {}
    assert all(first.setdefault(got[i], root[i]) == root[i] for i in sorted(got)) and len(first) == len(set(root.values()))
    assert {x["doc_id"] for x in simhash_dedup.keep_one(df).collect()} == set(root.values())


def test_keep_one_loses_no_text(spark):
    a, b, x, y = (prose(60, s) for s in (1, 2, 3, 4))
    rows = [(1, a), (5, b), (5, a), (7, x), (7, y), (None, x), (None, "alone " + prose(20, 5)), (9, b), (9, b), (3, prose(30, 6)), (3, prose(30, 6))]
    df = spark.createDataFrame([(i, t, "q", 1) for i, t in rows], "doc_id long, text string, rid string, root int")
    got = sorted(((r["doc_id"], r["text"]) for r in simhash_dedup.keep_one(df).collect()), key=repr)
    assert got == sorted([(1, a), (5, b), (7, x), (7, y), rows[6], (3, rows[9][1])], key=repr)
    assert simhash_dedup.keep_one(df).columns == df.columns
    assert simhash_dedup.keep_one(df.limit(0)).count() == 0


def test_parity_maps_bound_the_difference():
    rng = np.random.default_rng(0)
    for n in (3, 600, 3000):
        x = np.unique(rng.integers(0, 1 << 63, n, dtype="u8"))
        y = np.unique(np.r_[x[n // 5 :], rng.integers(0, 1 << 63, n // 5, dtype="u8")])
        a, b = (np.frombuffer(simhash_dedup.parity_map(v), "<u8") for v in (x, y))
        while len(a) != len(b):
            a, b = (v[: len(v) // 2] ^ v[len(v) // 2 :] if len(v) == max(len(a), len(b)) else v for v in (a, b))
        assert np.bitwise_count(a ^ b).sum() <= len(np.setxor1d(x, y))


def test_run(spark, data):
    d, texts, toxic, _ = data
    out = corpus_pipeline.run(spark, d).collect()
    assert {r["doc_id"] for r in out} == set(texts) - toxic - {400, 401, 404, 406, 407}
    by = {}
    for r in out:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(places), sorted(places)[1:], strict=False))


def test_registered():
    names = set(__spark_entry__.queries())
    assert "pipeline" in names
    assert all(len([n for n in names if n.startswith(f"op{i}_")]) == 1 for i in range(1, 11))
