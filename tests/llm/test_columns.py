"""Stages and operators that return their input's columns: any names, rows and values unchanged."""

from __future__ import annotations

import numpy as np
import pytest

import corpus_pipeline
from sitemill.llm import decontaminate, simhash_dedup, substring_dedup, toxicity
from sitemill.llm.common import fresh

from .test_operators import prose

#: Names that a step uses inside, and names that need quoting.
NAMES = (
    "row doc id rid key h none place filled digest unit later first top n a b k w wh f y x s s0 fp bits prefix atom root comp token own lo hi grams spots windows label score removed removed_ spans "
    "__id __rid __n __top __at __units __copy __none __place __key __h __bad __badrid a.b x`y doc_id.text"
).split()


def documents(spark):
    texts = [prose(80, 1), prose(80, 2), prose(80, 3) + " " + prose(30, 9), None, "", prose(60, 4) + "\n" + prose(30, 9)]
    rows = [(i, t, *[f"{n}{i}" for n in NAMES]) for i, t in enumerate(texts)]
    quoted = ", ".join("`" + n.replace("`", "``") + "` string" for n in NAMES)
    return spark.createDataFrame(rows, f"doc_id long, text string, {quoted}"), rows


STEPS = {
    "drop_toxic": lambda docs, labels, items: toxic_stage(docs, labels),
    "drop_near_duplicates": lambda docs, labels, items: simhash_dedup.keep_one(docs),
    "drop_repeated_passages": lambda docs, labels, items: corpus_pipeline.drop_repeated_passages(docs.sparkSession, docs, ""),
    "drop_contaminated": lambda docs, labels, items: decontaminate.drop_contaminated(docs, items),
}


def toxic_stage(docs, labels):
    kept = corpus_pipeline.table
    corpus_pipeline.table = lambda spark, sf_dir, name: labels
    try:
        return corpus_pipeline.drop_toxic(docs.sparkSession, docs, "")
    finally:
        corpus_pipeline.table = kept


@pytest.mark.parametrize("step", sorted(STEPS))
def test_columns_of_any_name(spark, step):
    docs, rows = documents(spark)
    labels = spark.createDataFrame([(i, 0) for i in range(6)], "doc_id long, toxic int")
    items = spark.createDataFrame([(1, prose(20, 77))], "item_id long, text string")
    out = STEPS[step](docs, labels, items)
    assert out.columns == docs.columns
    got = {r["doc_id"]: tuple(r) for r in out.collect()}
    want = {r[0]: r for r in rows}
    if step == "drop_near_duplicates":
        assert set(got) <= set(want) and {0, 1, 2, 5} <= set(got)
    else:
        assert set(got) == set(want)
    for i, r in got.items():
        assert r[2:] == want[i][2:] and (r[1] == want[i][1] or step == "drop_repeated_passages")
    if step == "drop_repeated_passages":
        assert got[5][1] != want[5][1] and got[0][1] == want[0][1]


def test_scores_and_spans_replace_columns_of_their_name(spark):
    docs, _ = documents(spark)
    scored = toxicity.toxicity_scores(docs, toxicity.train([], np.zeros(0), 0.5))
    assert scored.columns == [c for c in docs.columns if c != "score"] + ["score"] and scored.count() == 6
    cut_out = substring_dedup.substring_dedup(docs)
    assert cut_out.columns == [c for c in docs.columns if c != "removed"] + ["removed"] and cut_out.count() == 6
    assert fresh(docs, "removed") == "removed__" and fresh(docs, "free") == "free"
