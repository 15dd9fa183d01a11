import hashlib
import random
import re

import pytest

from tidemark.llm import decon

DOCS = "doc_id long, text string, n_words string, hits string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(data, items, span=10):
    out = []
    for doc_id, text, *_ in data:
        ws, hit, found = words(text), set(), set()
        for item_id, item in items:
            item_words = words(item)
            length = min(span, len(item_words))
            windows = {tuple(item_words[i : i + length]) for i in range(len(item_words) - length + 1)} if length else set()
            for i in range(len(ws) - length + 1):
                if tuple(ws[i : i + length]) in windows:
                    hit.update(range(i, i + length))
                    if item_id is not None:
                        found.add(str(item_id))
        ids = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((str(doc_id), len(ws), len(hit), len(found), ids, bool(hit)))
    return sorted(out)


@pytest.fixture(scope="module")
def case():
    draw = random.Random(3)
    vocabulary = ["Äpfel", "der", "a", "B", "ccc", "x9", "Öl", "İ", "und"]

    def text(n):
        return "".join(draw.choice(vocabulary) + draw.choice([" ", ", ", "\n", "--"]) for _ in range(n))

    items = [(i, text(draw.choice([12, 15, 30]))) for i in range(12)]
    items += [(20, items[0][1]), (21, "zwei Worte"), (22, ""), (23, None), (None, "only-null here"), (24, "!?")]
    data = [(i, text(draw.randrange(0, 60))) for i in range(60)]
    data += [(100 + i, text(9) + items[i][1].upper().replace("ß", "ss") + text(4)) for i in range(12)]
    data += [(200, "ZWEI   worte zwei worte"), (201, "Only null HERE"), (202, None), (203, ""), (204, ". , ;")]
    data += [(None, items[3][1]), (205, items[1][1] * 800), (300, items[2][1]), (300, items[2][1]), (300, "other")]
    return [(*row, "x", None) for row in data], items


@pytest.mark.parametrize("limit", [20_000, 5])
def test_equals_brute_force(spark, case, limit):
    data, items = case
    rows = decon.report(
        spark.createDataFrame(data, DOCS).repartition(3),
        spark.createDataFrame(items, "item_id long, text string"),
        set_limit=limit,
    ).collect()
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows)
    assert got == brute(data, items)


@pytest.mark.parametrize("limit", [20_000, 5])
def test_clean(spark, case, limit):
    data, items = case
    docs = spark.createDataFrame(data, DOCS)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    hit = [row[-1] for row in brute(data, items)]
    kept = decon.clean(docs, benchmark, set_limit=limit)
    assert kept.columns == docs.columns
    assert kept.count() == hit.count(False)
    cut = decon.clean(docs, benchmark, remove="spans", set_limit=limit)
    assert cut.count() == len(data)
    texts = {(r.doc_id, r.text) for r in cut.collect()}
    assert (200, "") in texts and (202, None) in texts and (204, ". , ;") in texts
    assert (300, "other") in texts and (300, "") in texts


def test_empty_tables(spark, case):
    data, items = case
    docs = spark.createDataFrame(data, DOCS)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert not any(r.contaminated for r in decon.report(docs, benchmark.limit(0)).collect())
    assert decon.report(docs.limit(0), benchmark).count() == 0


@pytest.mark.parametrize("limit", [20_000, 0])
def test_words_with_characters_that_a_literal_would_escape(spark, limit):
    odd = [f"b{chr(code)}d c d e f g h i j k" for code in (0x85, 0xA0, 0xAD, 0x9F)]
    docs = spark.createDataFrame([(i, f"x {text} y", "x", None) for i, text in enumerate([*odd, "clean words"])], DOCS)
    benchmark = spark.createDataFrame(list(enumerate(odd)), "item_id long, text string")
    assert [r.doc_id for r in decon.clean(docs, benchmark, set_limit=limit).collect()] == [len(odd)]
