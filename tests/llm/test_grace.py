import hashlib
from collections import defaultdict

import pytest

from tidemark.llm import grace

DOCS = "doc_id long, text string, keep_id string"


def brute(data):
    groups = defaultdict(list)
    for doc_id, text, *_ in data:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        one = False
        for i in ids:
            kept = i == keep and not one
            one |= kept
            out.append((str(i), str(keep), len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("budget", [200, 5000, 64 << 20])
def test_equals_brute_force(spark, budget):
    data = [(i, f"text {i % 90} " * (1 + i % 7), "x") for i in range(400)]
    data += [(None, None, "x"), (5000, "", "y"), (5001, None, "y"), (None, "only null", "y"), (6000, "long " * 40000, "z")]
    data += [(7000, "hot", "h")] * 150 + [(8000 + i, "hot", "h") for i in range(150)]
    docs = spark.createDataFrame(data, DOCS).repartition(3)
    rows = grace.dedup(docs, budget=budget).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in rows) == brute(data)


def test_empty(spark):
    assert grace.dedup(spark.createDataFrame([], DOCS)).count() == 0


def test_one_digest_for_two_contents_fails():
    table = grace.OpenTable(1000)
    assert table.add(b"12345678", b"a", 1, 1)
    with pytest.raises(ValueError):
        table.add(b"12345678", b"b", 2, 1)
