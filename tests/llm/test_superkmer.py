import hashlib
import random

import duckdb
import numpy as np
import oracle
import pytest

from tidemark.llm import superkmer, texts

DOCS = "doc_id long, text string, spans string, bucket string"


def brute(data, size=13):
    first = {}
    split = [(t or "").encode().split() for _, t, *_ in data]
    for (doc_id, *_), words in zip(data, split, strict=True):
        for i in range(len(words) - size + 1):
            window = tuple(words[i : i + size])
            if doc_id is not None:
                first[window] = min(first.get(window, doc_id), doc_id)
    out = []
    for (doc_id, *_), words in zip(data, split, strict=True):
        gone = set()
        for i in range(len(words) - size + 1):
            if doc_id is not None and first[tuple(words[i : i + size])] < doc_id:
                gone.update(range(i, i + size))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((str(doc_id), len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def corpus(seed):
    draw = random.Random(seed)
    vocabulary = [f"wört{i}" for i in range(60)] + ["a", "b,", "C."]
    passages = [[draw.choice(vocabulary) for _ in range(draw.choice([13, 14, 40]))] for _ in range(5)]
    data = []
    for i in range(300):
        words = [draw.choice(vocabulary) for _ in range(draw.randrange(0, 90))]
        for _ in range(draw.randrange(3)):
            at = draw.randrange(len(words) + 1)
            words[at:at] = draw.choice(passages)
        data.append((draw.randrange(10_000), "".join(w + draw.choice([" ", " ", "\n", "  ", " \t"]) for w in words)))
    hot = " ".join(passages[2])
    data += [(20_000 + i, f"{i} before {hot} after {i} {i}") for i in range(120)]
    data += [(i, data[5][1]) for i in (1, 2, 2, 30_000)] + [(None, data[6][1]), (None, None), (3, None), (4, ""), (5, "few words")]
    data += [(6, "again and again " * 8000), (40_000, "again and again " * 50), (7, "word" * 30000)]
    return [(d, t, "x", None) for d, t in data]


@pytest.mark.parametrize("seed, how", [(1, {}), (2, {"flush": 20_000, "bucket_bytes": 5000}), (3, {"gram": 1}), (4, {"gram": 13})])
def test_equals_brute_force(spark, seed, how):
    data = corpus(seed)
    rows = superkmer.report(spark.createDataFrame(data, DOCS).repartition(4), **how).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in rows) == brute(data)


def test_given_documents(spark):
    path = f"{oracle.FOLDER}/documents.parquet"
    data = duckdb.sql(f"SELECT doc_id, text FROM '{path}'").fetchall()
    rows = superkmer.report(spark.read.parquet(path)).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in rows) == brute(data)


def test_super_kmers_cover_each_window_once():
    draw = random.Random(8)
    raw = [" ".join(draw.choice("abcdef") for _ in range(n)).encode() for n in (0, 5, 13, 14, 200, 12, 77)]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    _, _, first, owner, window, windows, _ = superkmer._super_kmers(np.frombuffer(b"".join(raw), np.uint8), offsets, 13, 4)
    got = [(o, w + k - first[o]) for o, w, n in zip(owner, window, windows, strict=True) for k in range(n)]
    assert got == [(d, i) for d, r in enumerate(raw) for i in range(len(r.split()) - 12)]


def test_least_places():
    draw = np.random.default_rng(1)
    codes = draw.integers(0, 5, 100).astype(np.uint64)
    for width in (1, 2, 3, 7, 10):
        got = superkmer._least_places(codes, width)
        assert got.tolist() == [i + int(np.argmin(codes[i : i + width])) for i in range(101 - width)]


def test_words_of_texts():
    raw = ["a  b\tc\n", "", " x", "é ü z\x0b\x0c", "no\x1cbreak"]
    data = "".join(raw).encode()
    offsets = np.concatenate([[0], np.cumsum([len(r.encode()) for r in raw])])
    starts, ends, first = texts.spans(np.frombuffer(data, np.uint8), offsets)
    assert [data[a:b] for a, b in zip(starts, ends, strict=True)] == [w for r in raw for w in r.encode().split()]
    assert np.diff(first).tolist() == [len(r.encode().split()) for r in raw]


def test_empty(spark):
    assert superkmer.report(spark.createDataFrame([], DOCS)).count() == 0


def test_kept_text(spark):
    data = [(1, "a b c d e f g h i j k l m n"), (2, "x  a b c d e f g h i j k l m\ty z"), (3, None)]
    docs = spark.createDataFrame([(d, t, "", "") for d, t in data], DOCS)
    got = {r.doc_id: r.kept_text for r in superkmer.remove_repeats(docs).collect()}
    assert got == {1: data[0][1], 2: "x y z", 3: ""}


def test_copies_cause_flushes_too():
    """One text under ever larger, ever smaller or the same doc_id: what is held is counted, and nothing is lost."""
    content = b"a b c d e f g h i j k l m"
    for ids in (range(1000), range(1000, 0, -1), [7] * 1000):
        packer = superkmer._Packer(4, 1 << 30)
        for i, doc_id in enumerate(ids):
            packer.add(content, 1, doc_id, i, 0, 1, 13)
        assert packer.held > 60_000
        rows = [superkmer._unpack(blob) for batch in packer.flush() for blob in batch.column("blob").to_pylist()]
        assert sum(len(numbers) for _, _, numbers, _ in rows) == 1000
        assert packer.held == 0
