"""The n-gram join against all pairs."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from tidemark.llm import vertical

DOCS = "doc_id long, text string, key string, n long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size):
    words = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    if not words:
        return frozenset()
    size = min(size, len(words))
    return frozenset(" ".join(words[i : i + size]) for i in range(len(words) - size + 1))


def brute(data, size=3, percent=90):
    sets = [shingles(text, size) for _, text, *_ in data]
    lead = list(range(len(data)))

    def find(i):
        while lead[i] != i:
            i = lead[i]
        return i

    links = defaultdict(set)
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                lead[find(i)] = find(j)
                if a != b:
                    links[a].add(b)
                    links[b].add(a)
    least = {}
    for i, (doc_id, *_) in enumerate(data):
        root = find(i)
        if doc_id is not None:
            least[root] = min(doc_id, least.get(root, doc_id))
    return sorted((str(row[0]), len(sets[i]), str(least.get(find(i))), len(links[sets[i]])) for i, row in enumerate(data))


def got(frame):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.n_links) for r in frame.collect())


def edited(draw, words, edits):
    words = list(words)
    for _ in range(edits):
        words[draw.randrange(len(words))] = f"e{draw.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def data():
    draw = random.Random(12)
    rows = []
    for base in range(25):  # families around the threshold, of texts of all lengths
        words = [f"w{draw.randrange(400)}" for _ in range(draw.choice([5, 9, 11, 30, 120, 400]))]
        for _ in range(draw.randrange(1, 12)):
            text = edited(draw, words, draw.choice([0, 0, 1, 1, 2, 4, 9]))
            rows.append((len(rows), text.upper() if base % 3 == 0 else text))
    common = " ".join(f"c{i}" for i in range(60))  # a passage that many share
    rows += [(1000 + i, common + " " + " ".join(f"x{draw.randrange(900)}" for _ in range(draw.randrange(12)))) for i in range(60)]
    rows += [(2000 + i, "copy " * 3 + common) for i in range(80)]
    rows += [(3000, None), (3001, ""), (3002, " \t\n"), (3003, "one"), (3004, "one"), (3005, "ONE two"), (3006, "one  two")]
    rows += [(None, rows[0][1]), (None, "only null ids have this text"), (3007, "long " * 30000), (3008, "long " * 20000 + "x")]
    rows += [(3009, " ".join(f"l{i}" for i in range(20000))), (3010, " ".join(f"l{i}" for i in range(20500)))]
    rows += [(7, "the same id, another text " + common), (7, rows[7][1])]
    return [(*row, "x", 1) for row in rows]


@pytest.mark.parametrize("members,percent", [(512, 90), (3, 90), (8, 75)])
def test_equals_brute_force(spark, data, members, percent):
    docs = spark.createDataFrame(data, DOCS).repartition(4)
    assert got(vertical.components_of(docs, 3, percent, members)) == brute(data, 3, percent)


def test_dense_family_below_the_threshold(spark):
    draw = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, edited(draw, words, draw.choice([1, 2, 3, 4, 5, 6])), "x", 1) for i in range(300)]
    docs = spark.createDataFrame(rows, DOCS)
    frame = vertical.components_of(docs, members=64)
    assert got(frame) == brute(rows)


def test_fragments_add_up(monkeypatch):
    monkeypatch.setattr(vertical, "_WIDE", 7)
    draw = np.random.default_rng(1)

    def block(n):
        sets = [np.unique(draw.integers(0, 80, draw.integers(40, 120))) for _ in range(n)]
        return sets, (np.array([len(s) for s in sets]), np.array([len(s) for s in sets]), np.concatenate(sets))

    (a, left), (b, right) = block(30), block(20)
    want = [[100 * len(set(x) & set(y)) >= 75 * len(set(x) | set(y)) for y in b] for x in a]
    assert vertical.links_between(left, right, False, 75).tolist() == want
    alone = vertical.links_between(left, left, True, 75)
    assert alone.tolist() == [[i != j and 100 * len(set(x) & set(y)) >= 75 * len(set(x) | set(y)) for j, y in enumerate(a)] for i, x in enumerate(a)]


def test_empty(spark):
    assert vertical.components_of(spark.createDataFrame([], DOCS)).count() == 0
