import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import chosen, components

DOCS = "doc_id long, text string, key string, component string, n string"


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(data):
    sets = [shingles(t) for _, t, *_ in data]
    parent = list(range(len(data)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            if sets[i] and sets[j]:
                shared = len(sets[i] & sets[j])
                if 100 * shared >= 75 * (len(sets[i]) + len(sets[j]) - shared):
                    parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(data)):
        groups[find(i)].append(data[i][0])
    out = []
    for i, (doc_id, *_) in enumerate(data):
        least = min((d for d in groups[find(i)] if d is not None), default=None)
        least = doc_id if not sets[i] else least
        out.append((str(doc_id), len(sets[i]), str(least), doc_id == least))
    return sorted(out), sets


def corpus(seed):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = [draw.choice(vocabulary) for _ in range(60)]
    data = []
    for i in range(50):
        words = [draw.choice(vocabulary) for _ in range(draw.randrange(8, 160))]
        if i % 3 == 0:
            words += passage
        data.append((1000 + i, " ".join(words)))
        for k in range(draw.randrange(4)):
            copy = list(words)
            for _ in range(draw.randrange(0, 1 + len(words) // 25)):
                copy[draw.randrange(len(copy))] = "Changed"
            data.append((draw.randrange(100_000), " ".join(copy)))
    base = [draw.choice(vocabulary) for _ in range(150)]
    for i in range(90):  # a large group of near copies, chained
        base[draw.randrange(len(base))] = f"c{i}"
        data.append((200_000 + i, " ".join(base)))
    data += [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE  two"), (6, "two one"), (None, "one two"), (7, "a b c d e")]
    data += [(None, "only null ids here"), (9, "long text " * 20000), (10, "long text " * 19000 + "x"), (4, "one two"), (4, "one two")]
    return [(d, t, "x", None, "y") for d, t in data]


@pytest.mark.parametrize("seed, small", [(1, 32), (2, 3)])
def test_equals_brute_force(spark, seed, small):
    data = corpus(seed)
    docs = spark.createDataFrame(data, DOCS).repartition(3)
    rows = chosen.report(docs, small=small).collect()
    want, _ = brute(data)
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept or False) for r in rows) == [
        (d, n, c, k if d != "None" else k or c == "None") for d, n, c, k in want
    ]


def family(seed, members, twins):
    """Texts that are alike at about 0.70, all with each other, and some pairs of them at 0.75 to 0.80."""
    draw = random.Random(seed)
    base = [f"w{i}" for i in range(1000)]

    def edited(words, edits):
        words = list(words)
        for place in draw.sample(range(len(words)), edits):
            words[place] = f"e{draw.randrange(1 << 40)}"
        return words

    data = []
    for i in range(members):
        own = edited(base, 5)  # what a twin has too
        for k in range(2 if i < twins else 1):
            data.append((10 * i + k, " ".join(edited(own, 13)), "x", None, "y"))
    return data


def test_links_in_a_dense_family(spark):
    data = family(5, 220, 20)
    want, _ = brute(data)
    joined = sum(not kept for *_, kept in want)
    assert 15 <= joined <= 60  # the twins, and few others by chance
    rows = chosen.report(spark.createDataFrame(data, DOCS).repartition(3), small=2).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in rows) == want


def test_dense_nodes_put_out_no_branches(spark, monkeypatch):
    members, trees = 60, 4
    docs = spark.createDataFrame(family(8, members, 0), DOCS)
    rows = chosen.sketches(docs, 5, trees)
    classes = rows.select("roots", "sketch", F.monotonically_increasing_id().alias("id"))
    kept, keep = [], chosen.scratch.keep

    def counted(table, *how):
        table = keep(table, *how)
        kept.append(table.count())
        return table

    monkeypatch.setattr(chosen.scratch, "keep", counted)
    leaves = chosen._leaves(classes, 2)
    first, most = kept[0], max(kept)
    assert 0 < first <= members * trees
    assert leaves.where("size > 2").count() > first / 2  # most are in dense nodes
    assert most <= first  # before, each row of these was put out once per position


def test_recall_of_the_trees_at_any_depth():
    n, trees = chosen.POSITIONS, 20
    assert len(set(chosen.first_positions(trees))) == trees
    missed = 0.0
    for agree in range(n + 1):
        f = agree / n
        lost = (1 - f) / f if f > 0.5 else 1.0
        unseen = agree < chosen._AGREE
        missed += math.comb(n, agree) * 0.75**agree * 0.25 ** (n - agree) * (1.0 if unseen else lost**trees)
    assert missed < 1e-5


def test_one_of_each_group_stays(spark):
    data = corpus(3)
    docs = spark.createDataFrame(data, DOCS)
    kept = chosen.deduplicated(docs)
    assert kept.columns == docs.columns
    want, _ = brute(data)
    ids = sorted(str(r.doc_id) for r in kept.collect())
    named = sorted({d for d, _, c, _ in want if d == c and d != "None"} | {"None"})
    assert ids == named


def test_empty(spark):
    docs = spark.createDataFrame([], DOCS)
    assert chosen.report(docs).count() == 0
    assert chosen.deduplicated(docs).count() == 0


def test_components(spark):
    draw = random.Random(1)
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 180)] + [(180, 179), (5, 5)]
    links += [(draw.randrange(300, 400), draw.randrange(300, 400)) for _ in range(80)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.id: r.label for r in components.label(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent if find(x) != x}
