"""Toxicity by a factorization machine over hashed terms (operator 8)."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import boxed, cut, named

WORD = re.compile(r"[^\W_]+")
#: Features are word stems of these lengths and whole words, hashed.
STEMS = (4, 5, 6)
BITS = 18
FACTORS = 8
#: At most so many labelled rows of each class, by the order of a hash of their ids, fit the model.
SAMPLE_PER_CLASS = 4_000
#: Features are learnt whose likelihood ratio between the classes is that of so many standard errors,
#: and so are both of a pair, among so many of the commonest others, whose joint presence exceeds so many.
SCREEN_Z, PAIR_TERMS, PAIR_Z = 3.0, 1000, 7.0


def word_features(word: str, bits: int = BITS) -> list[int]:
    """Hashed features of a lower-case word: the word, and its stems if it is longer."""
    out = [zlib.crc32(word.encode()) >> (32 - bits)]
    out += [zlib.crc32(f"{word[:n]}~".encode()) >> (32 - bits) for n in STEMS if len(word) > n]
    return out


def features(text: str | None, cache: dict[str, list[int]], bits: int = BITS) -> np.ndarray:
    """Distinct hashed features of a whole text, in order."""
    found: set[int] = set()
    for w in set(WORD.findall((text or "").lower())):
        f = cache.get(w)
        if f is None:
            f = word_features(w, bits)
            if len(cache) < 200_000:
                cache[w] = f
        found.update(f)
    return np.fromiter(sorted(found), "i8", len(found))


@dataclass
class FactorizationMachine:
    """score = sigmoid(bias + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j), x_i = 1 for present features."""

    bias: float
    w: np.ndarray
    v: np.ndarray

    def raw(self, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Scores before the sigmoid; ``starts`` marks where each row begins, rows may be empty."""
        sizes = np.diff(np.r_[starts, len(flat)])
        out = np.full(len(starts), self.bias)
        full = np.flatnonzero(sizes)
        if len(full):
            s, v = starts[full], self.v[flat]
            sums = np.add.reduceat(v, s)
            out[full] += np.add.reduceat(self.w[flat], s) + 0.5 * ((sums**2).sum(1) - np.add.reduceat((v**2).sum(1), s))
        return out

    def score(self, rows: list[np.ndarray]) -> np.ndarray:
        if not rows:
            return np.zeros(0)
        starts = np.r_[0, np.cumsum([len(r) for r in rows])[:-1]].astype("i8")
        return 1 / (1 + np.exp(-np.clip(self.raw(np.concatenate(rows), starts), -35, 35)))


def likelihood_ratio(pos: np.ndarray, n1: int, neg: np.ndarray, n0: int) -> np.ndarray:
    """Twice the log likelihood ratio of presence between classes of n1 and n0 rows; zero counts are sound."""
    term = lambda o, e: np.where(o > 0, o * np.log(np.maximum(o, 1e-300) / np.maximum(e, 1e-300)), 0.0)
    share = (pos + neg) / (n1 + n0)
    return 2 * (term(pos, n1 * share) + term(neg, n0 * share) + term(n1 - pos, n1 * (1 - share)) + term(n0 - neg, n0 * (1 - share)))


def candidates(pos: np.ndarray, n1: int, neg: np.ndarray, n0: int, z: float, pair_terms: int = PAIR_TERMS, pair_z: float = PAIR_Z) -> tuple[np.ndarray, np.ndarray]:
    """Features that differ between the classes alone, and in order the common others that are tested in pairs."""
    kept = (likelihood_ratio(pos, n1, neg, n0) >= z * z) | (z <= 0)
    count = np.where(kept | (pos + neg == n1 + n0), 0, pos + neg)
    common = np.argsort(-count, kind="stable")[:pair_terms]
    return kept, np.sort(common[count[common] >= pair_z])


def screened(rows: list[np.ndarray], labels: np.ndarray, n: int, z: float, pair_terms: int = PAIR_TERMS, pair_z: float = PAIR_Z) -> np.ndarray:
    """Which of ``n`` features differ between the classes, alone or in a pair of two that don't alone."""
    n1, n0 = int((labels == 1).sum()), int((labels == 0).sum())
    pos, neg = (np.bincount(np.concatenate([r for r, y in zip(rows, labels, strict=True) if y == c] or [[]]).astype("i8"), minlength=n).astype("f8") for c in (1, 0))
    kept, common = candidates(pos, n1, neg, n0, z, pair_terms, pair_z)
    if len(common) < 2:
        return kept
    both = [np.zeros((len(common), len(common)), "f4") for _ in range(2)]
    for c in (0, 1):
        own = [r for r, y in zip(rows, labels, strict=True) if y == c]
        for at in range(0, len(own), 500):
            x = np.zeros((min(500, len(own) - at), len(common)), "f4")
            for k, r in enumerate(own[at : at + 500]):
                i = np.searchsorted(common, r)
                i = i[(i < len(common)) & (common[np.minimum(i, len(common) - 1)] == r)]
                x[k, i] = 1
            both[c] += x.T @ x
    for k in range(len(common)):
        hit = likelihood_ratio(both[1][k].astype("f8"), n1, both[0][k].astype("f8"), n0) >= pair_z * pair_z
        hit[k] = False
        kept[common[hit]] = True
    return kept


def train(rows: list[np.ndarray], labels: np.ndarray, prior: float, bits: int = BITS, factors: int = FACTORS, epochs: int = 8, rate: float = 0.05, decay: float = 1e-3, seed: int = 7, screen: float = SCREEN_Z) -> FactorizationMachine:
    """AdaGrad on the log loss in small batches; ``prior`` is the share of label 1 outside the sample.

    Features that occur alike in both classes, alone and in pairs, keep weight and factors zero:
    with hundreds of terms a text, unscreened noise terms outweigh the few that matter. Pairs are
    tested among the ``PAIR_TERMS`` commonest such features.
    """
    n = 1 << bits
    rng = np.random.default_rng(seed)
    m = FactorizationMachine(float(np.log(prior / (1 - prior))), np.zeros(n), np.zeros((n, factors)))
    if not len(rows) or labels.min() == labels.max():
        return m
    kept = screened(rows, labels, n, screen)
    m.v[kept] = rng.normal(0, 0.01, (int(kept.sum()), factors))
    rows = [r[kept[r]] for r in rows]
    # each class weighs as it does in the whole table
    share = labels.mean()
    weight = np.where(labels == 1, prior / share, (1 - prior) / (1 - share))
    gb, gw, gv = 1e-8, np.full(n, 1e-8), np.full((n, factors), 1e-8)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for k in range(0, len(order), 64):
            batch = order[k : k + 64]
            part = [rows[i] for i in batch]
            sizes = np.array([len(r) for r in part])
            flat = np.concatenate(part) if sizes.sum() else np.zeros(0, "i8")
            starts = np.r_[0, np.cumsum(sizes)[:-1]].astype("i8")
            p = 1 / (1 + np.exp(-np.clip(m.raw(flat, starts), -35, 35)))
            g = (p - labels[batch]) * weight[batch] / len(batch)
            gb += g.sum() ** 2
            m.bias -= rate * g.sum() / np.sqrt(gb)
            if not len(flat):
                continue
            v = m.v[flat]
            sums = np.zeros((len(batch), factors))
            full = np.flatnonzero(sizes)
            sums[full] = np.add.reduceat(v, starts[full])
            each = np.repeat(g, sizes)
            ids, inv = np.unique(flat, return_inverse=True)
            dw = np.bincount(inv, each) + decay * m.w[ids] / len(batch)
            pull = each[:, None] * (np.repeat(sums, sizes, 0) - v)
            dv = np.stack([np.bincount(inv, pull[:, f]) for f in range(factors)], 1) + decay * m.v[ids] / len(batch)
            gw[ids] += dw**2
            gv[ids] += dv**2
            m.w[ids] -= rate * dw / np.sqrt(gw[ids])
            m.v[ids] -= rate * dv / np.sqrt(gv[ids])
    return m


def fold(id_col: str) -> F.Column:
    """crc32 of the id as text, modulo 5; 0 is held out."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_class: int = SAMPLE_PER_CLASS) -> FactorizationMachine:
    """Fit on labelled rows outside the held-out fold, ``per_class`` rows of each class at most.

    The bounded sample (ids first in the order of a hash) is screened where it lies: the driver gets
    how many rows of each class have each of the 2^18 features, and then of each row those features that
    pass the screen or are tested in pairs, whatever its length. Rows without a label, an id or a text take no part; of labels that
    disagree for one id the larger holds, of texts that share an id the one of the smallest hash. Without any label every text scores a low prior.
    """
    lab = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y")).where("id is not null and y in (0, 1)")
    lab = lab.where(fold("id") != 0).groupBy("id").agg(F.max("y").alias("y"))
    counts = {r["y"]: r["count"] for r in lab.groupBy("y").count().collect()}
    prior = (counts.get(1, 0) + 0.5) / (sum(counts.values()) + 10)
    mixed = F.xxhash64("id", F.lit("fit"))
    pick = None
    for y in (0, 1):
        part = lab.where(F.col("y") == y).orderBy(mixed, "id").limit(per_class)
        pick = part if pick is None else pick.unionByName(part)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, list[int]] = {}
        for b in batches:
            f = [features(t, cache).astype("i4") for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("y"), pa.array(f, pa.list_(pa.int32()))], names=["id", "y", "f"])

    # at most 2 * per_class rows, so the broadcast has a fixed bound
    one = texts.join(F.broadcast(pick), "id").groupBy("id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    rows = cut(one.select("id", "y", "text").mapInArrow(hashed, "id long, y int, f array<int>"))
    size = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    if not size:
        return train([], np.zeros(0), prior)
    counts = [np.zeros(1 << BITS) for _ in range(2)]
    for r in rows.select("y", F.explode("f").alias("f")).groupBy("f").pivot("y", [0, 1]).count().toArrow().to_pylist():
        counts[0][r["f"]], counts[1][r["f"]] = r["0"] or 0, r["1"] or 0
    wanted, common = candidates(counts[1], size.get(1, 0), counts[0], size.get(0, 0), SCREEN_Z)
    wanted[common] = True

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = [x.values.to_numpy() for x in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([x[wanted[x]] for x in f], pa.list_(pa.int32()))], names=["id", "y", "f"])

    got = rows.mapInArrow(some, "id long, y int, f array<int>").orderBy("id").toArrow()
    return train([v.values.to_numpy().astype("i8") for v in got.column("f").combine_chunks()], got.column("y").to_numpy().astype(float), prior)


def toxicity_scores(docs: DataFrame, model: FactorizationMachine, text_col: str = "text") -> DataFrame:
    """``docs`` with a score column (0 to 1) for each whole text; null and empty texts score by the bias.

    Every row gives one row; other columns pass through, a former score column does not. The model is a few MB of fixed size.
    """
    names = [c for c in docs.columns if c != "score"]
    docs = docs.select(*[named(c) for c in names])
    shared = docs.sparkSession.sparkContext.broadcast((model.bias, model.w.astype("f4"), model.v.astype("f4")))
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bias, w, v = shared.value
        m, cache = FactorizationMachine(bias, w, v), {}
        for b in batches:
            cols = b.column(0).flatten()
            texts = cols[at].to_pylist()
            s = [m.score([features(t, cache) for t in texts[i : i + 256]]) for i in range(0, len(texts), 256)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(np.concatenate(s) if s else np.zeros(0))], names=[*names, "score"])

    return docs.select(boxed(docs)).mapInArrow(run, docs.select(*[named(c) for c in names], F.lit(0.0).alias("score")).schema)


def flag_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``; a null id is not held out."""
    model = fit(docs, labels, id_col, text_col, label_col)
    cols = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = toxicity_scores(cols, model)
    return out.select("doc_id", F.coalesce(fold("doc_id") == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
