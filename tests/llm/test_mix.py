import random
from collections import defaultdict

import oracle
import pytest

from tidemark.llm import mix

DOCS = "doc_id long, text string, source string, lang string, topic string, n long"


def data():
    draw = random.Random(1)
    rows = [
        (i, draw.choice(["a b c ", "x@y ", "7 ", "Licensed "]) * draw.randrange(1, 9), draw.choice("AAAABC"), draw.choice(["en", "de", None]), "t", 1)
        for i in range(3000)
    ]
    return rows + [(9000, None, None, None, None, None), (9001, "", "A", "en", None, 1), (5, "a", "A", "en", "t", 1)]


def test_shares_reach_the_targets(spark):
    docs = spark.createDataFrame(data(), DOCS)
    targets = {"source": {"A": 0.3, "B": 0.4, "C": 0.3}, "lang": {"en": 0.5, "de": 0.5}}
    rows = mix.with_probability(docs, targets=targets, sweeps=25).collect()
    weight = defaultdict(float)
    for r in rows:
        assert 0 <= r["__probability"] <= 1
        for value in (r.source, r.lang):
            weight[value] += r["__tokens"] * r["__probability"]
    total = weight["A"] + weight["B"] + weight["C"]
    assert weight["B"] / total == pytest.approx(0.4, abs=0.01)
    assert weight["en"] / total == pytest.approx(0.5, abs=0.01)
    assert weight[None] == 0
    kept = mix.sample(docs, targets=targets, sweeps=25)
    assert kept.columns == docs.columns
    tokens = {r.doc_id: len((r.text or "").split()) for r in docs.collect()}
    by = defaultdict(int)
    for r in kept.collect():
        by[r.source] += tokens[r.doc_id]
    assert by["B"] / sum(by.values()) == pytest.approx(0.4, abs=0.05)


def test_equals_sql_with_hard_rows(spark):
    docs = spark.createDataFrame([*data(), (None, "w " * 20000, "B", "de", "t", 1)], DOCS)
    con = oracle.connect()
    con.register("given_rows", docs.toPandas())
    con.execute("CREATE OR REPLACE VIEW documents AS SELECT doc_id::BIGINT AS doc_id, text, source, lang FROM given_rows")
    assert oracle.compare(mix.report(docs), con, mix.report_sql()) is None
    assert oracle.compare(mix.report(docs, sent_cells=0), con, mix.report_sql()) is None


def test_degenerate(spark):
    docs = spark.createDataFrame([(1, None, "A", "en", "t", 1), (2, "", None, None, None, None)], DOCS)
    assert [r.kept for r in mix.report(docs).collect()] == [True, True]
    assert mix.report(docs.limit(0)).count() == 0


def test_one_rare_cell_does_not_set_the_volume(spark):
    data = [(i, "a b c d e", "big", "en") for i in range(2000)] + [(i, "a b c d e", "mid", "fr") for i in range(2000, 2400)]
    data += [(9000, "x@y", "rare", "es")]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string, lang string")
    thin = mix.with_probability(docs, sweeps=1).selectExpr("sum(__probability * __tokens) AS w").first().w
    rows = mix.with_probability(docs, covered=0.95, sweeps=1).groupBy("source").agg({"__probability": "max"}).collect()
    each = {r[0]: r[1] for r in rows}
    before = {r[0]: r[1] for r in mix.with_probability(docs, sweeps=1).groupBy("source").agg({"__probability": "max"}).collect()}
    assert all(abs(each[s] / each["big"] - before[s] / before["big"]) < 1e-9 for s in each)  # same proportions
    got = [r.doc_id for r in mix.sample(docs, covered=0.95, sweeps=1).select("doc_id").collect()]
    assert thin < 0.5 * 12_001 and 5 * len(got) > 0.5 * 12_001
    assert got.count(9000) in (int(each["rare"]), int(each["rare"]) + 1) and got.count(9000) > 1
