import random
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from test_chosen import brute as near_groups
from test_decon import brute as contamination
from tokenizers import Tokenizer

SYLLABLES = {"en": "the of and with ing tion er th", "de": "der die und schen ung ei ich"}
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    draw = random.Random(12)

    def prose(lang, n):
        parts = SYLLABLES[lang].split()
        return " ".join("".join(draw.choice(parts) for _ in range(draw.randrange(1, 4))) for _ in range(n))

    items = [(i, prose("en", 20)) for i in range(4)]
    rows = []
    for i in range(120):
        lang = draw.choice(["en", "en", "de"])
        text = prose(lang, draw.randrange(30, 120))
        rows.append((i, text, lang))
        if i % 5 == 0:
            rows.append((1000 + i, text if i % 2 else text + " extra", lang))
        if i % 17 == 0:
            rows.append((2000 + i, text[:100] + " " + items[i % 4][1] + " " + prose(lang, 9), lang))
    rows += [(3000, None, "en"), (3001, "12 34 !!", "de"), (3002, "", None), (3003, "ЖЩ ЪЫ ЭЮ " * 20, None)]
    rows = [(d, t, lang, f"src{d % 3}", len(t or "")) for d, t, lang in rows]
    path = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(path / "benchmark.parquet"))
    return str(path), rows, items


def test_each_stage_on_its_input(spark, folder):
    path, rows, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    seen = {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        seen[name] = {r.doc_id: r.text for r in docs.collect()}
        out = stage(spark, docs, path)
        if number < 4:
            assert out.columns == docs.columns
        out.write.parquet(f"{path}/{number}")
        docs = spark.read.parquet(f"{path}/{number}")
    first, near, decontaminated, mixing, tokens = seen.values()
    assert set(first) - set(near) == {3000, 3001, 3002, 3003}
    want, _ = near_groups([(d, t) for d, t in near.items()])
    assert set(decontaminated) == {int(d) for d, _, c, _ in want if d == c}
    hit = {int(d) for d, *_, bad in contamination(list(decontaminated.items()), items) if bad}
    assert hit and set(mixing) == set(decontaminated) - hit
    assert set(tokens) <= set(mixing) and len(tokens) > len(mixing) / 3
    library, start = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in docs.collect()}
    assert set(got) == set(tokens)
    for doc_id in sorted(tokens):
        ids = np.array([*library.encode(tokens[doc_id], add_special_tokens=False).ids, 0], "<u4")
        assert got[doc_id] == (start, len(ids), zlib.crc32(ids))
        start += len(ids)


def test_run_equals_the_stages(spark, folder):
    path, *_ = folder
    rows = corpus_pipeline.run(spark, path).collect()
    stages = spark.read.parquet(f"{path}/4").collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, stages))


def test_hard_columns(spark, tmp_path):
    """Nulls in every column, repeated rows, and columns of clashing names."""
    rows = [(None, None, None, None, None, "x"), (None, "the ing of " * 9, None, None, None, None)]
    rows += [(5, "the tion " * 30, "en", "s", 1, "y")] * 2 + [(6, "der und ung " * 20, "de", None, None, None)]
    docs = spark.createDataFrame(rows, COLUMNS + ", n_words string")
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    columns = docs.columns
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if number < 4:
            assert out.columns == columns
        out.write.parquet(str(tmp_path / f"{number}"))
        docs = spark.read.parquet(str(tmp_path / f"{number}"))
    near = spark.read.parquet(str(tmp_path / "1"))
    assert sorted(str(r.doc_id) for r in near.collect()) == ["5", "6", "None"]
    empty = spark.createDataFrame([], COLUMNS)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


