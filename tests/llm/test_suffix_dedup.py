"""Suffix arrays of collections, anchors, and repeated spans against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from sitemill.llm import suffix_dedup as sd


@pytest.mark.parametrize("read", [3, 1 << 20])
def test_collection_suffixes(tmp_path, monkeypatch, read):
    monkeypatch.setattr(sd, "READ", read)
    r = random.Random(read)
    for trial in range(25):
        alphabet, cap = r.choice([1, 2, 3, 60]), r.choice([3, 5, 100])
        strings = [[r.randrange(alphabet) for _ in range(r.randint(1, 12))] for _ in range(r.randint(1, 25))]
        start = np.r_[0, np.cumsum([len(x) for x in strings])]
        folder = tmp_path / str(trial)
        folder.mkdir()
        suffix, prefix = sd.collection_suffixes(np.concatenate(strings), start, cap, folder)
        of = {start[i] + j: x[j:] for i, x in enumerate(strings) for j in range(len(x))}
        got = [of[p] for p in suffix.tolist()]
        assert sorted(suffix.tolist()) == sorted(of) and all(a <= b for a, b in zip(got, got[1:]))
        for (a, b), k in zip(zip(got, got[1:]), prefix[1:]):
            same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert k == min(same, cap)


def test_least_of_stretches():
    r = np.random.default_rng(2)
    values = r.integers(0, 25, 1000).astype(np.uint8)
    least = sd._Least(values)
    a = r.integers(0, 1000, 3000)
    b = np.minimum(a + r.integers(0, 600, 3000), 999)
    assert (least(a, b) == [values[x : y + 1].min() for x, y in zip(a, b)]).all()


def test_anchors_depend_on_the_window_alone(monkeypatch):
    r = random.Random(4)
    shared = bytes(r.choice(b"abcdefgh ") for _ in range(1500))
    texts = [b"x" * 700 + shared + b"y" * 900, bytes(r.choice(b"abc") for _ in range(800)) + shared, b"ab" * 400]
    for stretch in (1 << 19, 333):
        monkeypatch.setattr(sd, "STRETCH", stretch)
        seen: dict[bytes, set] = {}
        for t in texts:
            covered = []
            for key, anchor, first, last in zip(*sd.anchors(t)):
                assert first <= anchor <= first + sd.LENGTH - sd.GRAM and last <= anchor
                for w in range(first, last + 1):
                    covered.append(w)
                    seen.setdefault(t[w : w + sd.LENGTH], set()).add((key, anchor - w))
            assert covered == list(range(len(t) - sd.LENGTH + 1))
        assert all(len(x) == 1 for x in seen.values())
    assert [len(x) for x in sd.anchors(b"a" * 399)] == [0] * 4


def brute(texts, length):
    """(n_bytes, spans, digest of the rest) of each text."""
    raw = [(t or "").encode() for t in texts]
    count = Counter(t[i : i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for t in raw:
        gone = np.zeros(len(t) + 2, bool)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i + 1 : i + 1 + length] = True
        edge = np.flatnonzero(gone[1:] != gone[:-1])
        kept = bytes(c for c, g in zip(t, gone[1:]) if not g)
        out.append((len(t), tuple(zip(edge[::2].tolist(), edge[1::2].tolist())), hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 8))) for _ in range(400)]
    prose = lambda n: " ".join(r.choice(words) for _ in range(n))
    passage, long_ = prose(90), prose(700)
    edited = long_.split()
    for i in range(0, 700, 120):
        edited[i] = "é漢🎉"
    texts = [prose(50) + passage + prose(60) for _ in range(12)] + [long_, long_, " ".join(edited), long_[:2000] + "x", "y" + long_[301:3300]]
    texts += [None, "", "short", "a" * 399, "a" * 400, "b" * 2000, "ab" * 700, "word " * 300, "word " * 310 + "!", passage[:399], passage[:400], passage, passage + passage]
    texts += ["é" * 500, "漢字" * 100 + passage, prose(40) + passage[5:420] + prose(30), passage[3:]]
    return texts


SCHEMA = "doc_id long, text string, digest string, n int, num string, removed int, keys string, `a.b` int"


@pytest.mark.parametrize("length,block,options", [(400, 16, {}), (400, 16, {"hot": 3, "task_bytes": 9_000}), (150, 8, {"task_bytes": 20_000}), (77, 16, {}), (64, 32, {"hot": 1})])
def test_against_brute_force(spark, length, block, options):
    texts = corpus(length)
    rows = [(None if i == 3 else min(i, 30), t, "x", 1, "y", 2, "z", 3) for i, t in enumerate(texts)]
    got = sd.suffix_dedup(spark.createDataFrame(rows, SCHEMA), length=length, block=block, **options)
    assert got.columns == ["doc_id", "n_bytes", "removed", "kept_sha256"]
    found = Counter((r["doc_id"], r["n_bytes"], tuple((s["start"], s["end"]) for s in r["removed"]), r["kept_sha256"]) for r in got.collect())
    assert found == Counter((row[0], *b) for row, b in zip(rows, brute(texts, length)))


def test_empty_tables_and_one_text(spark):
    assert sd.suffix_dedup(spark.createDataFrame([], SCHEMA)).count() == 0
    row = (1, "b" * 900, "x", 1, "y", 2, "z", 3)
    assert [(r["n_bytes"], [tuple(s) for s in r["removed"]]) for r in sd.suffix_dedup(spark.createDataFrame([row], SCHEMA)).collect()] == [(900, [(0, 900)])]
    with pytest.raises(ValueError):
        sd.repeated_spans(spark.createDataFrame([row], SCHEMA), length=20)
