"""Each corpus operator against brute force or an exact round trip, on small tables with odd rows."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from sitemill.llm import decontaminate, html_extract, license_scan, lm_scoring, packing, simhash_dedup, substring_dedup, toxicity, url_filter, vector_dedup
from sitemill.llm.common import connected_components, join_labels

DOCS = "doc_id long, text string, lang string, fp string, removed string, score string, path string"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def prose(n: int, seed: int) -> str:
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 8))) for _ in range(n)]
    return ". ".join(" ".join(words[i : i + 9]).capitalize() for i in range(0, n, 9)) + "."


def documents(spark, extra=()):
    base = prose(120, 1)
    near = base.replace(base.split()[60], "changed")
    rows = [
        (1, base),
        (2, base),
        (3, base.upper()),
        (4, near),
        (5, None),
        (6, ""),
        (7, "one"),
        (7, "one"),
        (None, "no id at all but some words"),
        (8, prose(3000, 2)),
        (9, "  \n\t "),
        (10, prose(90, 3) + "\n" + base),
        (11, "é ß 漢字 🎉 <|endoftext|> it's fine   "),
        *extra,
    ]
    return spark.createDataFrame([(d, t, "en", "x", "y", "z", "w") for d, t in rows], DOCS), rows


def components(ids, linked):
    root = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(root[a], root[b])
            if root[a] != low or root[b] != low:
                root[a] = root[b] = low
                changed = True
    return root


# --- shared -------------------------------------------------------------------------------
def test_connected_components(spark):
    r = random.Random(4)
    pairs = [(r.randint(1, 300), r.randint(1, 300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)] + [(5, 5), (2000, 2001)]
    real = [(a, b) for a, b in pairs if a != b]
    empty = spark.createDataFrame([], "src long, dst long")
    for small in (0, 10**6):
        got = {x["node"]: x["root"] for x in connected_components(spark.createDataFrame(pairs, "src long, dst long"), small=small).collect()}
        assert got == components({x for p in real for x in p}, real)
        assert connected_components(empty, small=small).count() == 0


def test_join_labels():
    comp = np.arange(6)
    join_labels(comp, np.array([5, 4, 1]), np.array([4, 3, 0]))
    assert comp.tolist() == [0, 0, 2, 3, 3, 3]


# --- 1 --------------------------------------------------------------------------------------
def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(60, 16))
    rows = [v for b in base for v in (b, *(b + rng.normal(scale=s, size=16) for s in (0.05, 0.1, 0.25, 0.35)))]
    rows += [rows[0]] * 3 + [rows[7] * 2.0]
    data = [(i, v.tolist()) for i, v in enumerate(rows)]
    odd = [(1000, None), (1001, [0.0] * 16), (1002, [math.nan] * 16), (1003, [None] * 16), (1004, []), (1005, [math.inf] + [0.0] * 15), (None, rows[0].tolist()), (1006, [1.0, 0.0])]
    df = spark.createDataFrame([(i, v, 3, 1) for i, v in data + odd], "vec_id long, embedding array<double>, label int, rep int")
    got = {r["vec_id"]: r for r in vector_dedup.vector_groups(df, block=32).collect()}
    x = np.array(rows)
    n = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = n @ n.T >= 0.9
    np.fill_diagonal(link, False)
    root = components(range(len(rows)), [tuple(map(int, p)) for p in np.argwhere(link)])
    found = sum(got[i]["n_links"] for i in range(len(rows)))
    assert 0.97 * link.sum() <= found <= link.sum()
    assert sum(got[i]["component_id"] == root[i] for i in range(len(rows))) >= 0.97 * len(rows)
    assert all(got[i]["n_links"] == 0 and got[i]["component_id"] == i and got[i]["kept"] for i in range(1000, 1007))
    assert got[None]["component_id"] is None and not got[None]["kept"]
    assert len(got) == len(rows) + 8


def test_vectors_recall_holds_with_many_reference_points(spark, monkeypatch):
    monkeypatch.setattr(vector_dedup, "VECTORS_PER_PIVOT", 2)  # 2048 points, as for 820,000 vectors
    rng = np.random.default_rng(1)
    x, way = rng.normal(size=(2100, 64)), rng.normal(size=(2100, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    way -= (way * x).sum(1, keepdims=True) * x
    way /= np.linalg.norm(way, axis=1, keepdims=True)
    y = 0.9001 * x + math.sqrt(1 - 0.9001**2) * way
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(np.r_[x, y])], "vec_id long, embedding array<float>")
    got = {r["vec_id"]: r["component_id"] for r in vector_dedup.vector_groups(df).collect()}
    assert sum(got[i] == got[i + 2100] for i in range(2100)) >= 0.98 * 2100


def test_vectors_recall_in_few_dimensions():
    # on a circle the six nearest of many points span no such angle: fewer points are taken
    a = np.random.default_rng(2).uniform(0, 2 * math.pi, 3048)
    points, k = vector_dedup.reference_points(np.stack([np.cos(a), np.sin(a)], 1), 2048, 0.9, 6, 2)
    t = np.linspace(0, 2 * math.pi, 720)
    near = [vector_dedup.nearest_pivots(np.stack([np.cos(x), np.sin(x)], 1), points, k) for x in (t, t + math.acos(0.9))]
    assert np.mean([len(set(p) & set(q)) >= 2 for p, q in zip(*near, strict=True)]) >= 0.95


def test_vectors_empty(spark):
    assert vector_dedup.vector_groups(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_links_of_a_list_are_reported_once():
    x = np.array([[1.0, 0.0], [1.0, 0.01], [0.0, 1.0]])
    p = np.array([[0, 1], [0, 1], [0, 2]], "i2")
    pairs = lambda pivot: [(int(a), int(b)) for i, j in vector_dedup.links_in_list(pivot, x, x, p, p, True, 0.9, 2) for a, b in zip(i, j, strict=True)]
    assert pairs(0) == [(0, 1)] and pairs(1) == []


# --- 2 --------------------------------------------------------------------------------------
def backoff(texts, order, own=True):
    docs = [lm_scoring.tokens(t) for t in texts]
    counts, each = Counter(), []
    for w in docs:
        c = Counter(tuple(w[i : i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1))
        each.append(c)
        counts.update(c)
    total = sum(map(len, docs))
    out = []
    for w, c in zip(docs, each, strict=True):
        have = lambda g, c=c: counts[g] - (c[g] if own else 0)
        size = max(1, total - (len(w) if own else 0))
        s = 0.0
        for i in range(len(w)):
            cost = 0
            for n in range(min(order, i + 1), 0, -1):
                g = tuple(w[i - n + 1 : i + 1])
                if n > 1 and have(g) > 0:
                    s += math.log10(have(g) / have(g[:-1])) + cost * math.log10(0.4)
                    break
                if n == 1:
                    known = have(g) > 0
                    s += math.log10(max(have(g), 1) / size) + (cost + (0 if known else 1)) * math.log10(0.4)
                cost += 1
        out.append(s)
    return out


@pytest.mark.parametrize("order,own", [(3, True), (2, False)])
def test_lm_scores(spark, order, own):
    df, rows = documents(spark)
    got = lm_scoring.lm_scores(df, order=order, exclude_own=own, chunk_tokens=200).collect()
    want = backoff([t for _, t in rows], order, own)
    key = lambda d, n, s: (d if d is not None else -1, n, round(s, 6))
    assert sorted(key(r["doc_id"], r["n_tokens"], r["log10_score"]) for r in got) == sorted(key(d, len(lm_scoring.tokens(t)), s) for (d, t), s in zip(rows, want, strict=True))
    assert all((r["mean_log10"] is None) == (r["n_tokens"] == 0) for r in got)
    assert lm_scoring.lm_scores(df.limit(0)).count() == 0


def test_lm_scores_of_rows_in_another_order_each_time(spark):
    texts = {i: prose(40, 40 + i % 30) for i in range(200)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    shuffled = df.mapInArrow(reordered, df.schema)
    got = {r["doc_id"]: r["log10_score"] for r in lm_scoring.lm_scores(shuffled, chunk_tokens=200).collect()}
    assert got == pytest.approx(dict(zip(texts, backoff(list(texts.values()), 3), strict=True)))


def reordered(batches):
    """Rows of a partition in another order at each call."""
    import os

    import pyarrow as pa

    t = pa.Table.from_batches(list(batches)).select(["doc_id", "text"])
    yield from t.take(np.random.default_rng(list(os.urandom(8))).permutation(t.num_rows)).combine_chunks().to_batches()


# --- 3 --------------------------------------------------------------------------------------
def test_decontamination(spark):
    item, short = prose(40, 50), "tiny benchmark item"
    w = item.split()
    noise = prose(100, 51).split()
    edited = [*w[:20], "edited", *w[21:]]
    extra = [
        (20, " ".join([*noise[:30], *w, *noise[30:]])),
        (21, " ".join([*noise[:50], *edited, *noise[50:]])),
        (22, " ".join([*noise[:50], *w[:12], *noise[50:]])),
        (23, "x " + short.upper() + "! y"),
        (24, item),
        (None, "start " + item),
        (25, " ".join(w * 3)),
    ]
    df, _ = documents(spark, extra)
    bench = spark.createDataFrame([(1, item, 0), (2, None, 0), (3, "", 0), (4, short, 0), (5, item, 0)], "item_id long, text string, doc_id int")
    hits = decontaminate.contamination(df, bench).collect()
    got = {(r["doc_id"], r["item_id"]) for r in hits}
    assert got == {(d, i) for d in (20, 21, 24, None, 25) for i in (1, 5)} | {(23, 4)}
    exact = next(r for r in hits if r["doc_id"] == 20 and r["item_id"] == 1)
    assert exact["similarity"] == 1.0 and exact["hamming"] == 0
    assert len(hits) == len(got)
    kept = decontaminate.drop_contaminated(df, bench)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 22, None}
    assert kept.where("doc_id is null").count() == 1 and kept.where("doc_id = 7").count() == 2
    assert decontaminate.contamination(df, bench.limit(0)).count() == 0
    assert decontaminate.contamination(df.limit(0), bench).count() == 0


def test_blocks_guarantee_the_radius(spark):
    r = random.Random(1)
    rows = []
    for i in range(300):
        x = r.getrandbits(128)
        y = x
        for k in r.sample(range(128), r.randint(0, decontaminate.RADIUS)):
            y ^= 1 << k
        rows.append((i, *(v - (1 << 63) for z in (x, y) for v in (z >> 64, z & (1 << 64) - 1))))
    df = spark.createDataFrame(rows, "i int, a long, b long, c long, d long")
    ok = decontaminate.within_blocks([F.col("a"), F.col("b")], [F.col("c"), F.col("d")])
    assert df.where(ok).count() == 300
    rows = [(i, *(r.getrandbits(64) - (1 << 63) for _ in range(4))) for i in range(1000)]
    assert spark.createDataFrame(rows, "i int, a long, b long, c long, d long").where(ok).count() < 200


def test_decontamination_against_all_windows_and_items(spark):
    r = random.Random(6)
    common = prose(12, 600)
    items = {i: (common + " " if i % 3 == 0 else "") + prose(r.choice([4, 12, 30, 60]), 610 + i) for i in range(12)}
    docs = {}
    for d in range(240):
        w = re.findall(r"[a-z]+", items[d % 12].lower())
        for _ in range(r.randint(0, 1 + len(w) // 14)):
            at, what = r.randrange(len(w)), r.random()
            w = w[:at] + (["edit"] if what < 0.6 else []) + w[at + (what < 0.8) :] if what < 0.8 else [*w[:at], "more", *w[at:]]
        docs[d] = " ".join([*prose(r.randint(0, 40), 700 + d).split(), *w, *prose(r.randint(0, 40), 900 + d).split()])
    split = lambda t: re.findall(r"[a-z0-9]+", t.lower())
    grams = lambda w, k: {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}
    each = {}
    for i, t in items.items():
        w = split(t)
        each[i] = (len(w), min(5, len(w)), grams(w, min(5, len(w))))
    df = Counter((k, g) for _, k, s in each.values() for g in s)
    weight = lambda k, s: sum(1 / max(1, df[k, g]) for g in s)
    want, shorter = {}, {}
    for d, t in docs.items():
        w = split(t)
        for i, (n, k, s) in each.items():
            for a in range(1 - n, len(w)):  # at the ends of a text windows can be shorter
                x = grams(w[max(a, 0) : a + n], k)
                if x & s and (sim := 2 * weight(k, x & s) / (weight(k, x) + weight(k, s))) >= 0.8 - 1e-9:
                    shorter[d, i] = max(sim, shorter.get((d, i), 0))
                    if len(w[max(a, 0) : a + n]) == min(n, len(w)):
                        want[d, i] = max(sim, want.get((d, i), 0))
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = {(x["doc_id"], x["item_id"]): x["similarity"] for x in decontaminate.contamination(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), bench).collect()}
    assert len(want) > 60 and sum(0.8 <= s < 0.9 for s in want.values()) > 8
    assert len(set(want) - set(got)) <= 0.01 * len(want)
    assert all(got[p] <= shorter[p] + 1e-9 for p in got)


# --- 4 --------------------------------------------------------------------------------------
def test_urls(spark):
    urls = [
        ("http://A.Example.COM/en/1?x", "block", "example.com/en/"),
        ("https://www.example.com/en/1", "allow", "www.example.com/en/"),
        ("http://m.www.example.com/en/#t", "allow", "www.example.com/en/"),
        ("http://b.net/es/1/2", "block", "net/es/"),
        ("http://b.net/ES/1", "allow", None),
        ("http://b.net/fr", "allow", None),
        ("http://notcom/x", "allow", None),
        ("http://x.com", "allow", None),
        ("http://x.com/", "allow", "com/"),
        ("no scheme", "allow", None),
        (None, "allow", None),
        ("http://h?://b.net/es/", "allow", None),
        ("://net/fr/?", "block", "net/fr/"),
    ]
    df = spark.createDataFrame([(i, u, "h", "t") for i, (u, _, _) in enumerate(urls)], "page_id long, url string, host string, template string")
    got = {r["page_id"]: r for r in url_filter.judge_urls(df).collect()}
    assert [(got[i]["verdict"], got[i]["rule"]) for i in range(len(urls))] == [(v, r) for _, v, r in urls]
    assert (got[0]["host"], got[0]["path"]) == ("a.example.com", "/en/1")
    assert (got[11]["host"], got[11]["path"]) == ("h", "") and (got[10]["host"], got[10]["path"]) == ("", "")
    assert url_filter.judge_urls(df.limit(0)).count() == 0


def test_url_templates(spark):
    rows = [(i, f"http://h.org/user/name{chr(97 + i % 26)}{chr(97 + i // 26)}/post-{i}") for i in range(60)] + [(100 + i, f"http://h.org/about/{i}") for i in range(3)]
    df = spark.createDataFrame(rows, "page_id long, url string")
    got = {r["template"] for r in url_filter.judge_urls(df).collect()}
    assert got == {"/user/*/post-{n}", "/about/{n}"}


def test_url_purity_rejects(spark):
    # the rule blocks most pages of one template; those that it does not fit share the verdict
    rows = [(i, f"http://h.org/bad/{i}") for i in range(30)] + [(50, "http://h.org/bad/x7"), (51, "http://h.org/good/1")]
    df = spark.createDataFrame(rows, "page_id long, url string")
    rules = (*(("block", f"h.org/bad/{d}") for d in range(10)),)
    got = {r["page_id"]: r for r in url_filter.judge_urls(df.unionByName(spark.createDataFrame([(60 + i, f"http://h.org/bad/x{i}") for i in range(3)], "page_id long, url string")), rules=(*rules, ("block", "h.org/bad/x0"), ("block", "h.org/bad/x1"), ("block", "h.org/bad/x2"))).collect()}
    assert got[5]["verdict"] == "block" and got[51]["verdict"] == "allow"
    assert got[50]["rule"] is None and got[50]["purity"] >= 0.5 and got[50]["verdict"] == "block"


def plain_tree(rows, rules):
    """The verdicts of the tree by loops over all pages, for paths of two levels."""
    parts = lambda u: re.fullmatch(r"[^:]*://([^/]*)(/[^/]*)(/.*)", u).groups()
    shape = lambda s: re.sub(r"\d+", "{n}", s)
    pages = []
    for i, u in rows:
        host, a, b = parts(u)
        fits = [(len(t), what) for what, t in rules if (host + a + b).startswith(t)]
        pages.append((i, host, shape(a) + shape(b), max(fits)[1] if fits else None))
    count = lambda host, t: [sum(1 for _, h, x, v in pages if (h, x) == (host, t) and v in vs) for vs in (("allow", "block"), ("block",))]
    out = {}
    for i, host, t, verdict in pages:
        n, bad = count(host, t)
        kin = {x for _, h, x, _ in pages if h == host and x.rpartition("/")[2] == t.rpartition("/")[2]}
        own = {x: count(host, x) for x in kin}
        known = [c for c in own.values() if c[0]]
        if not n and known:
            p = (sum((b + 1) / (m + 4) for m, b in known) + 1) / (len(known) + 4)
        else:
            fn, fbad = sum(m for m, _ in known), sum(b for _, b in known)
            if n and (fbad in (0, fn) or abs(bad - n * fbad / fn) / math.sqrt(n * fbad / fn * (1 - fbad / fn)) < 1.96):
                n, bad = fn, fbad
            p = (bad + 1) / (n + 4)
        out[i] = verdict or ("block" if p >= 0.5 else "allow")
    return out


def test_urls_without_labels_join_their_siblings(spark):
    r = random.Random(4)
    rows = [(k, f"http://{h}.net/{s}/{r.randint(1, 999)}") for k, (h, s) in enumerate((h, s) for h in "abc" for s in ("es", "fr", "de", "it", "pl", "new") for _ in range(r.randint(8, 30)))]
    rules = (*(("block", f"a.net/{s}/") for s in ("es", "fr", "de", "it")), *(("block", f"b.net/{s}/") for s in ("es", "fr")), ("block", "c.net/es/"), ("allow", "c.net/fr/"))
    got = {x["page_id"]: (x["verdict"], x["rule"]) for x in url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), rules=rules).collect()}
    assert {i: v for i, (v, _) in got.items()} == plain_tree(rows, rules)
    new = {u.split("/")[2]: got[i][0] for i, u in rows if "/new/" in u}
    assert new == {"a.net": "block", "b.net": "allow", "c.net": "allow"}


def test_deep_paths_keep_all_segments(spark):
    rows = [(1, "http://h.org/" + "/".join("abcdefghij")), (2, "http://h.org/" + "/".join("abcdefghiz"))]
    got = {x["page_id"]: x["template"] for x in url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert got == {1: "/a/b/c/d/e/f/g/h/i/j", 2: "/a/b/c/d/e/f/g/h/i/z"}


# --- 5 --------------------------------------------------------------------------------------
def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    df, rows = documents(spark, [(30, "word " * 2500), (31, "a" * 5000)])
    got = packing.pack(df, TOKENIZER).collect()
    t = Tokenizer.from_file(TOKENIZER)
    want = Counter()
    for d, text in rows:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        first = len(ids) if len(ids) <= 1024 else len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[d, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for off, n in sorted(places):
            assert off == at
            at += n
        assert at <= 1024
    total = sum(r["length"] for r in got)
    assert len(by) <= -(-total // 1024) + 1
    assert packing.pack(df.limit(0), TOKENIZER).count() == 0


@pytest.mark.parametrize("n,seed", [(12, 0), (60, 1), (500, 2), (4000, 3)])
def test_bin_completion(n, seed):
    rng = np.random.default_rng(seed)
    counts = np.bincount(np.minimum(1024, rng.lognormal(6.2, 0.8, n).astype(int) + 1), minlength=1025)
    plan, fit = packing.bin_completion(counts), packing.best_fit(counts)
    for p in (plan, fit):
        used = np.zeros(1025, int)
        for items, times in p:
            assert sum(items) <= 1024 and times > 0
            for x in items:
                used[x] += times
        assert (used == counts).all()
    bins = sum(t for _, t in plan)
    assert packing.lower_bound(counts) <= bins <= sum(t for _, t in fit)


def test_bin_completion_is_optimal_where_best_fit_is_not():
    counts = np.bincount([6, 5, 5, 4, 4, 3, 3], minlength=11)  # 6+4, 5+5, 4+3+3 fill three bins
    assert sum(t for _, t in packing.bin_completion(counts, 10)) == 3


def test_encoder_equals_the_tokenizer():
    from tokenizers import Tokenizer

    t, e = Tokenizer.from_file(TOKENIZER), packing.encoder(TOKENIZER)
    for text in ("", " ", "a  b   c\n\n d", "don't stop", "x<|endoftext|>y", "ÀÉ ñ ß ü 123,456.78\t\r\n", "привет мир", "漢字", "a" * 4000, "   x", "é" * 50):
        assert e(text).tolist() == t.encode(text, add_special_tokens=False).ids, text


# --- 6 --------------------------------------------------------------------------------------
def test_substrings(spark):
    shared = prose(60, 70)
    df, rows = documents(spark, [(40, "Own words of this one here now.\n" + shared), (41, "Entirely other words stand in this line. " + shared + "\nThe end of this document is its own."), (42, shared)])
    got = {}
    for r in substring_dedup.substring_dedup(df).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert got[1][0]["text"] == rows[0][1] and got[1][0]["removed"] == []
    assert got[2][0]["text"] == "" and got[3][0]["text"] == ""
    assert got[5][0]["text"] is None and got[6][0]["text"] == ""
    assert [r["text"] for r in got[7]] == ["one", "one"] and len(got[None]) == 1
    assert got[40][0]["text"].endswith(shared)
    assert got[41][0]["text"] == "Entirely other words stand in this line. The end of this document is its own."
    assert got[42][0]["text"] == ""
    originals = dict(rows)
    for d in (2, 10, 41, 42):
        t, at, kept = originals[d], 0, ""
        for s in got[d][0]["removed"]:
            kept, at = kept + t[at : s["start"]], s["end"]
        assert kept + t[at:] == got[d][0]["text"]
    assert got[2][0]["lang"] == "en"
    assert substring_dedup.substring_dedup(df.limit(0)).count() == 0


def plain_units(text):
    """(start, end, words): cut at line breaks and sentence ends; short ones of a line join the next, the last one the one before."""
    out, line, start, i = [], [], 0, 0
    words = lambda a, b: text[a:b].lower().split()

    def close():
        got, at = [], None
        for a, b in line:
            at = a if at is None else at
            if len(words(at, b)) >= 4:
                got.append((at, b))
                at = None
        if at is not None:
            got[-1:] = [(got[-1][0], line[-1][1])] if got else [(at, line[-1][1])]
        out.extend(got)
        line.clear()

    while i < len(text):
        j = i
        if text[i] == "\n":
            while j < len(text) and text[j] == "\n":
                j += 1
            line.append((start, j))
            close()
            start = i = j
        elif text[i] in ".!?…":
            j += 1
            while j < len(text) and text[j] in "\"'»”)]":
                j += 1
            k = j
            while k < len(text) and text[k] in " \t":
                k += 1
            if k > j:
                line.append((start, k))
                start = i = k
            else:
                i += 1
        else:
            i += 1
    if start < len(text):
        line.append((start, len(text)))
    close() if line else None
    return [(a, b, tuple(words(a, b))) for a, b in out]


def plain_substrings(rows):
    """What is left of each text: later copies of a unit go in runs of eight words with a unit of four."""
    rank = lambda r: (r[0] is None, r[0] or 0, xxhash.xxh64_intdigest((r[1] or "").encode(), seed=42) - (xxhash.xxh64_intdigest((r[1] or "").encode(), seed=42) >> 63 << 64))
    seen, out = set(), []
    for d, t in sorted(rows, key=rank):
        if not t:
            out.append((d, t))
            continue
        left, run = "", []
        fresh = set()
        for a, b, w in [*plain_units(t), (len(t), len(t), ())]:
            if w and (w in seen or w in fresh):
                run.append((a, b, w))
                continue
            fresh.add(w)
            if sum(len(x) for _, _, x in run) < 8 or max(len(x) for _, _, x in run) < 4:
                left += "".join(t[x:y] for x, y, _ in run)
            run = []
            left += t[a:b]
        seen |= fresh
        out.append((d, left))
    return out


@pytest.mark.parametrize("top", [1, 50_000])
def test_substrings_against_brute_force(spark, monkeypatch, top):
    monkeypatch.setattr(substring_dedup, "TOP_DIGESTS", top)
    r = random.Random(8)
    pool = [prose(r.randint(3, 40), 300 + i) for i in range(12)]
    rows = [(i, "\n".join(r.choice([prose(20, 900 + 7 * i + k), r.choice(pool), "Is on. Is on. Is on."]) for k in range(r.randint(0, 6)))) for i in range(80)]
    rows += [(200, prose(60, 990))] * 3 + [(201, prose(30, 991)), (201, prose(30, 992) + " " + prose(30, 991)), (None, prose(40, 993)), (None, prose(40, 993)), (None, None), (202, prose(40, 993))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter((x["doc_id"], x["text"]) for x in substring_dedup.substring_dedup(df).collect())
    assert got == Counter(plain_substrings(rows))
    assert got[200, ""] == 2 and got[200, rows[80][1]] == 1


def test_units_cover_the_text():
    for t in ("a. b c! d\n\ne", "", "x", "One two three four five. Six.\nSeven eight.", 'He said "so." Then left'):
        assert "".join(t[a:b] for a, b in substring_dedup.units(t)) == t
        assert "".join(t[a:b] for a, b, _ in substring_dedup.passages(t)) == t


# --- 7 --------------------------------------------------------------------------------------
PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var t="</p>";</script></head><body><header><h1>Site</h1></header>
<nav><ul><li><a href="/">Home</a></li></ul></nav><!-- ad --><div class="ad">Buy</div><article><h1>Title &amp; more</h1><p><b>One<i>two</i>  three<br>four<p>A &lt;b&gt; c&nbsp;d
e</p><form>x<input></form><div id="sidebar-x">side</div><section class="comments"><article><p>Reader</p></article></section></article><aside>s</aside><footer>f</footer>"""


def main_text(page):
    texts, marked = html_extract.own_blocks(page)
    return "\n".join(texts) if marked else None


def test_main_text():
    assert main_text(PAGE) == "Title & more\nOnetwo three four\nA <b> c d e"
    assert main_text(None) is main_text("") is main_text("<p>no main part") is None
    assert main_text("<article>a < b &am c") == "a < b &am c"
    assert main_text("<nav><ul><li>menu<article><p>in</article>") == "in"


def test_wrappers_do_not_hide_the_main_part():
    for page in (
        "<form id=aspnet><main><p>Body</p></main></form>",
        '<article class="post share-enabled"><p>Body</p></article>',
        '<div class="page-header widget"><article><p>Body</p></article></div>',
        '<main class="content related"><p>Body</p></main>',
        '<div class="layout with-sidebar"><article>Body<div class="share">x</div></article></div>',
        '<main><p>Body</p><section class="comments-list"><article>a reader</article></section><article class="comment">b</article></main>',
        '<article><p>Body</p></article><aside><article>other</article></aside><div class="related-posts"><article>more</article></div>',
    ):
        assert main_text(page) == "Body", page
    assert html_extract.own_blocks("<!-- <article> --><div><p>Real text</p></div>") == (["Real text"], False)
    assert html_extract.own_blocks("<article><nav>x</nav></article><p>Else</p>") == (["Else"], False)


def pages_of(marked, n, r):
    """Pages of a host: unique text, a line that all have, one that few have, and a copy."""
    shared, few = prose(12, 801), prose(12, 802)
    body = ["".join(f"<p>{x}</p>" for x in (prose(30, 2000 + i), shared, *([few] if i % 12 == 0 else [])))for i in range(n)]
    body += [body[0]] * (n // 3)
    wrap = "<body><article>{}</article></body>" if marked else "<body><div>{}</div></body>"
    return [wrap.format(b) for b in body], shared, few


@pytest.mark.parametrize("shard,few_names", [(400, 10**6), (7, 10**6), (7, 0)])
def test_pages_of_a_host_do_not_depend_on_its_shards(spark, monkeypatch, shard, few_names):
    monkeypatch.setattr(html_extract, "SHARD_PAGES", shard)
    monkeypatch.setattr(html_extract, "BROADCAST_NAMES", few_names)
    r = random.Random(2)
    rows = []
    for h, marked in (("a", False), ("b", True)):
        html, shared, few = pages_of(marked, 60, r)
        rows += [(len(rows) + k, f"http://{h}.org/{k}", x) for k, x in enumerate(html)]
    rows += [(900, "http://c.org/1", rows[0][2]), (901, None, rows[0][2]), (902, "http://d.org", "<p>" + "word " * 50_000 + "</p>"), (902, "http://d.org", "<p>x</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = Counter((x["page_id"], x["text"]) for x in html_extract.extract_text(df).collect())
    want = Counter()
    for i, u, x in rows:
        texts = re.findall("<p>(.*?)</p>", x)
        # few is on a twelfth of the pages; host b marks its articles, which stay whole
        keep = texts if u is None or u[7] in "bcd" else [t for t in texts if t != shared]
        want[i, "\n".join(t.strip() for t in keep)] += 1
    assert got == want and few in got.most_common(1)[0][0][1] + "".join(t for _, t in got)


def test_pages(spark):
    frame = "<body><div><p>Welcome to this site of ours where you find all things</p></div><div><p>{}</p></div><div class=cookie>ok</div></body>"
    rows = [(i, "http://h.org/" + str(i), frame.format(prose(12, 200 + i))) for i in range(12)] + [(50, "http://m.org", PAGE), (51, None, None), (52, "x", ""), (53, "http://h.org/9", frame.format(prose(12, 200)))]
    df = spark.createDataFrame([(*r, "q", "s") for r in rows], "page_id long, url string, html string, text string, shard string")
    got = {r["page_id"]: r for r in html_extract.extract_text(df).collect()}
    assert len(got) == len(rows)
    for i in range(12):
        assert got[i]["text"] == prose(12, 200 + i)
    assert got[53]["text"] == prose(12, 200)  # a copy of page 0 is no sign of boilerplate
    assert got[50]["text"].startswith("Title & more") and got[51]["text"] == got[52]["text"] == ""
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert html_extract.extract_text(df.limit(0)).count() == 0


def test_shared_paragraphs_of_articles_stay(spark):
    """What pages share is their article, on small hosts, in marked main parts, and in near copies."""
    shared = prose(60, 901)
    story = lambda wrap, h, n: [(f"http://{h}.org/{i}", wrap.format(f"<p>Story {i}.</p><p>{shared}</p><p>{i}.</p>")) for i in range(n)]
    rows = story("<div>{}</div>", "two", 2) + story("<div>{}</div>", "nine", 9) + story("<article>{}</article>", "five", 5) + story("<main>{}</main>", "many", 40)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, html string")
    got = {r["url"]: r["text"] for r in html_extract.extract_text(df).collect()}
    assert all(got[u] == "\n".join([f"Story {u.split('/')[-1]}.", shared, f"{u.split('/')[-1]}."]) for u, _ in rows)


def test_boilerplate_of_unmarked_pages_goes(spark):
    notice = "This site has a long standing notice that every single page of it repeats in full"
    rows = [(i, f"http://h.org/{i}", f"<div><p>{prose(20, 950 + i)}</p></div><div><p>{notice}</p></div>") for i in range(12)]
    got = html_extract.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == {i: prose(20, 950 + i) for i in range(12)}


def test_repeated_words_against_brute_force():
    rng = np.random.default_rng(3)
    words, pages = rng.integers(0, 4, 600).astype("u8"), np.repeat(np.arange(6), 100)
    for length, least in ((5, 2), (8, 2), (6, 3)):
        where = {}
        for i in range(len(words) - length + 1):
            if pages[i] == pages[i + length - 1]:
                where.setdefault(tuple(words[i : i + length]), []).append(i)
        want = np.zeros(len(words), bool)
        for at in where.values():
            if len({pages[i] for i in at}) >= least:
                for i in at:
                    want[i : i + length] = True
        assert (html_extract.repeated_words(words, pages, length, least) == want).all()


# --- 8 --------------------------------------------------------------------------------------
def test_toxicity(spark):
    rows, labels = [], []
    for i in range(1500):
        bad = i % 6 == 0
        words = prose(60, 5000 + i).split()
        if bad:
            words[i % 50] = ("idiot", "scum", "moron")[i % 3 if i % 18 else (i // 18) % 3]
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    odd = [(9000, None), (9001, ""), (None, "you idiot"), (9002, "idiot " * 30_000)]
    docs = spark.createDataFrame([(d, t, "x", "y") for d, t in rows + odd], "doc_id long, text string, score string, y string")
    lab = spark.createDataFrame([*labels, (9000, 1, None), (None, 0, 1), (77777, 0, 0)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity.flag_toxic(docs, lab).collect()}
    held = [i for i in range(1500) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i]["held_out"] == (i in set(held)) for i in range(1500))
    assert sum(got[i]["predicted"] == (i % 6 == 0) for i in held) >= 0.97 * len(held)
    assert got[9000]["score"] == got[9001]["score"] and 0 < got[9000]["score"] < 0.5
    assert got[None]["predicted"] == 1 and not got[None]["held_out"] and got[9002]["predicted"] == 1
    assert toxicity.flag_toxic(docs, lab.limit(0)).where("predicted = 1").count() == 0
    assert toxicity.flag_toxic(docs.limit(0), lab).count() == 0


def test_pairwise_terms_are_learnt():
    # either word alone is harmless, the two together are not: no linear weights can say so
    rng = np.random.default_rng(0)
    a, b = (toxicity.word_features(w)[0] for w in ("insult", "group"))
    rows, y = [], []
    for i in range(3000):
        f = set(rng.integers(0, 1 << toxicity.BITS, 5).tolist())
        kind = i % 4
        f |= {a} if kind in (1, 3) else set()
        f |= {b} if kind in (2, 3) else set()
        rows.append(np.array(sorted(f)))
        y.append(float(kind == 3))
    m = toxicity.train(rows, np.array(y), 0.25, epochs=30)
    s = m.score([np.array([]).astype("i8"), np.array([a]), np.array([b]), np.array(sorted([a, b]))])
    assert s[3] > 0.5 > max(s[:3])
    assert float(m.v[a] @ m.v[b]) > 0


def test_pairs_that_differ_only_together_pass_the_screen():
    # either term alone marks label 1, both together or none label 0: each is spread evenly
    rng = np.random.default_rng(1)
    a, b = (toxicity.word_features(w)[0] for w in ("one", "other"))
    rows, y = [], []
    for i in range(3000):
        f = set(rng.integers(0, 1 << toxicity.BITS, 5).tolist())
        f |= ({a} if i % 4 in (1, 3) else set()) | ({b} if i % 4 in (2, 3) else set())
        rows.append(np.array(sorted(f)))
        y.append(float(i % 4 in (1, 2)))
    kept = toxicity.screened(rows, np.array(y), 1 << toxicity.BITS, toxicity.SCREEN_Z)
    assert kept[a] and kept[b] and kept.sum() < 100
    m = toxicity.train(rows, np.array(y), 0.5, epochs=60)
    s = m.score([np.array(sorted(x), "i8") for x in ([a], [b], [a, b])])
    assert min(s[:2]) > 0.5 > s[2]


def test_rare_terms_of_one_class_pass_the_screen():
    rows = [np.array([1 if i < 12 else 2]) if i < 4000 else np.array([2]) for i in range(8000)]
    assert toxicity.screened(rows, np.array([1.0] * 4000 + [0.0] * 4000), 8, toxicity.SCREEN_Z)[1]


def test_scores_are_sums_over_pairs():
    rng = np.random.default_rng(2)
    m = toxicity.FactorizationMachine(-0.3, rng.normal(size=50), rng.normal(size=(50, 4)))
    rows = [np.sort(rng.choice(50, k, replace=False)) for k in (0, 1, 2, 7, 30)]
    raw = [m.bias + sum(m.w[i] for i in r) + sum(m.v[i] @ m.v[j] for k, i in enumerate(r) for j in r[k + 1 :]) for r in rows]
    assert m.score(rows) == pytest.approx([1 / (1 + math.exp(-x)) for x in raw])


# --- 9 --------------------------------------------------------------------------------------
def plain_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(spark):
    base = prose(400, 90).split()
    extra = [(100 + i, " ".join([*base[:i], "edit", *base[i + 1 :]])) for i in range(0, 60)]
    df, rows = documents(spark, extra)
    got = simhash_dedup.simhash_groups(df).collect()
    fps = [plain_fingerprint(t) for _, t in rows]
    assert sorted((r["doc_id"] or -1, r["fingerprint"]) for r in got) == sorted((d or -1, f"{f:016x}") for (d, _), f in zip(rows, fps, strict=True))
    ids = [d for d, _ in rows if d is not None]
    f = {d: x for (d, _), x in zip(rows, fps, strict=True) if d is not None}
    root = components(ids, [(a, b) for a in ids for b in ids if a < b and (f[a] ^ f[b]).bit_count() <= 3])
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None} == root
    assert root[5] == root[6] == root[9] == 5
    assert simhash_dedup.simhash_groups(df.limit(0)).count() == 0


def test_spark_hash_is_the_same(spark):
    t = ["", "a b c", "é ß x", "x" * 100]
    got = spark.createDataFrame([(x,) for x in t], "t string").select(F.xxhash64("t")).collect()
    assert [r[0] % (1 << 64) for r in got] == [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in t]


def test_trie_against_brute_force_and_split_buckets(spark):
    rng = np.random.default_rng(5)
    fp = rng.integers(0, 1 << 63, 40, dtype="u8") * np.uint64(2)
    for _ in range(4):
        fp = np.unique(np.concatenate([fp, fp ^ (np.uint64(1) << rng.integers(0, 64, len(fp)).astype("u8"))]))
    want = components(range(len(fp)), [tuple(map(int, p)) for p in np.argwhere(np.bitwise_count(fp[:, None] ^ fp) <= 3)])
    comp = simhash_dedup.trie_classes(np.zeros(len(fp), "i8"), fp, chunk=500)
    assert comp.tolist() == [want[i] for i in range(len(fp))]
    rows = spark.createDataFrame([(int(x), i) for i, x in enumerate(fp.view("i8"))], "fp long, rep long")
    for hot in (20, 10**6):
        got = {r["node"]: r["root"] for r in connected_components(simhash_dedup.fingerprint_edges(rows, hot=hot)).collect()}
        assert all(got.get(i, i) == want[i] for i in range(len(fp)))


# --- 10 -------------------------------------------------------------------------------------
def test_licenses(spark):
    mit = license_scan.TEMPLATES[8][1]
    extra = [
        (60, prose(30, 1) + "\nThis work is licensed under the GNU General Public License, version 2.\n" + prose(9, 2)),
        (61, prose(30, 3) + " Licensed under CC BY-NC 3.0."),
        (62, "Copyright 2020\n" + mit.replace(". ", ".\n") + "\n" + prose(30, 4)),
        (63, "released under the mit license"),
        (64, "We talk of a license here and of the public in general."),
        (65, prose(30, 5) + "\nAll rights reserved."),
    ]
    df, rows = documents(spark, extra)
    got = {r["doc_id"]: r for r in license_scan.scan_licenses(df).collect()}
    assert {d: got[d]["best"] for d in range(60, 66)} == {60: "GPL", 61: "CC-BY-NC", 62: "MIT", 63: "MIT", 64: None, 65: None}
    assert all(got[d]["n_matches"] == 0 for d in (1, 5, 6, 8, 9, None))
    hit = got[60]["licenses"][0]
    assert dict(rows)[60][hit["start"] : hit["end"]].strip() == "This work is licensed under the GNU General Public License, version 2."
    assert hit["dice"] == 1.0
    assert license_scan.scan_licenses(df.limit(0)).count() == 0


def test_dice_and_size_bounds():
    a, b = license_scan.bigrams("a b c d"), license_scan.bigrams("b c d e")
    assert license_scan.dice(a, b) == pytest.approx(2 * 2 / 6)
    s = license_scan.Scanner((("T", "one two three four five six"),))
    assert s.scan("one two three four five six") == [("T", 1.0, 0, 27)]
    assert s.scan("one two three") == [] and s.scan("one two three four five six " + "x " * 40) == []


def test_runs_pass_units_without_words_of_the_template():
    bsd, mit = (next(t for n, t in license_scan.TEMPLATES if n == name and len(t) > 200) for name in ("BSD", "MIT"))
    a, b, c = re.split(r" (?=Redistributions )", bsd)
    numbered = f"Copyright 2020 someone.\n\n{a}\n\n1. {b}\n2. {c}\n\nint main;\n"
    paragraphs = re.split(r"(?<=[.:]) (?=The above|THE SOFTWARE|to deal)", mit)
    commented = "/*\n" + "".join(" * " + "\n * ".join(re.findall(r".{1,70}(?: |$)", x)) + "\n *\n" for x in paragraphs) + " */\nint main;\n"
    s = license_scan.Scanner()
    for name, text in (("BSD", numbered), ("MIT", commented)):
        hits = s.scan(text)
        assert [h[0] for h in hits] == [name] and hits[0][1] > 0.9
        assert "int main" not in text[slice(*hits[0][2:])]


def test_runs_against_brute_force():
    r = random.Random(11)
    templates = (("A", "a b c d e f g h"), ("B", "c d e a b"), ("C", "h"), ("D", "b 1 c"))
    s = license_scan.Scanner(templates)
    for _ in range(400):
        text = "".join(r.choice(["a", "b c", "a b c", "d e", "f g h", "h", "1.", "*", "x y", "e a b"]) + r.choice(["\n", ". ", " "]) for _ in range(r.randint(1, 9)))
        spans, found = substring_dedup.units(text), []
        for i in range(len(spans)):
            for j in range(i, len(spans)):
                for name, t in templates:
                    d = license_scan.dice(license_scan.bigrams(text[spans[i][0] : spans[j][1]]), license_scan.bigrams(t))
                    if d >= license_scan.DICE:
                        found.append((round(d, 9), spans[i][0], spans[j][1], name))
        best = min(found, key=lambda x: (-x[0], x[2] - x[1]), default=None)
        got = s.scan(text)
        assert bool(got) == bool(best) and (not best or max(h[1] for h in got) == best[0]), text


def _fewest(items, capacity):
    """Fewest bins by dynamic programming over subsets."""
    best = [(0, capacity + 1)]
    for m in range(1, 1 << len(items)):
        options = []
        for i, x in enumerate(items):
            if m >> i & 1:
                bins, used = best[m ^ (1 << i)]
                options.append((bins, used + x) if used + x <= capacity else (bins + 1, x))
        best.append(min(options))
    return best[-1][0]


def test_packing_search_against_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(60):
        capacity = int(rng.choice([10, 20, 50]))
        items = [int(x) for x in rng.integers(1, capacity + 1, rng.integers(1, 10))]
        counts = np.bincount(items, minlength=capacity + 1)
        plans = [packing.bin_completion(counts, capacity, exact=e) for e in (True, False)]
        for plan in plans:
            assert sorted(x for f, n in plan for _ in range(n) for x in f) == sorted(items) and all(sum(f) <= capacity for f, _ in plan)
        exact, quick = (sum(n for _, n in plan) for plan in plans)
        assert packing.lower_bound(counts, capacity) <= exact == _fewest(items, capacity) <= quick


def test_packing_dominance():
    assert packing.covers((7, 3), (5, 2, 3)) and packing.covers((4, 4), (4, 3)) and packing.covers((3,), ())
    assert not packing.covers((5, 5), (6, 2)) and not packing.covers((4, 4), (3, 3, 2)) and not packing.covers((9,), (5, 5))
    counts = np.bincount([9, 5, 4, 4, 3, 1], minlength=11)
    assert packing.all_fillings(counts, 10) == [(9, 1)]  # 5, 4 and 1 fit in 9 and 1, as does every other set
    assert (6, 3) in packing.all_fillings(np.bincount([7, 6, 3], minlength=10), 9)


@pytest.mark.parametrize("dense", [0, 10**9])
def test_links_of_a_list_either_way(monkeypatch, dense):
    """Few candidates are gathered, many are multiplied out: the same links."""
    monkeypatch.setattr(vector_dedup, "DENSE", dense)
    rng = np.random.default_rng(8)
    x = rng.standard_normal((60, 8))
    x[30:] = x[:30] + 0.1 * rng.standard_normal((30, 8))
    p = np.array([rng.choice(9, 4, replace=False) for _ in range(60)], "i2")
    p[:, 0] = 3
    got = {(int(a), int(b)) for i, j in vector_dedup.links_in_list(3, x, x, p, p, True, 0.9, 2) for a, b in zip(i, j, strict=True)}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    both = lambda a, b: set(p[a]) & set(p[b])
    assert got == {(a, b) for a in range(60) for b in range(a + 1, 60) if u[a] @ u[b] >= 0.9 and len(both(a, b)) >= 2 and min(both(a, b)) == 3}
