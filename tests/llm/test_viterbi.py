import random

import duckdb
import oracle
import public_tokenizers
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from tidemark.llm import viterbi

DOCS = "doc_id long, text string, n_chars string, score string"
PATH = public_tokenizers.path("piece_bpe_32k.model")


def library(pieces, by_bytes):
    tokenizer = Tokenizer(models.Unigram(pieces, 0, by_bytes))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=True)
    return tokenizer


def texts():
    draw = random.Random(6)
    parts = ["a", "ab", "ba", "the", " ", "  ", "\n", "é", "日本", "😀", "▁", "<s>", "<0x41>", "x", "zq"]
    some = ["".join(draw.choice(parts) for _ in range(draw.randrange(25))) for _ in range(1500)]
    some += [r[0] for r in duckdb.sql(f"SELECT text FROM '{oracle.FOLDER}/documents.parquet'").fetchall()]
    return [*some, "", " ", "y" * 5000, "日" * 500]


def test_public_vocabulary(spark):
    pieces = viterbi.vocabulary(PATH)
    reference, counter = library(pieces, True), viterbi.Counter(pieces, most_words=100)
    for text in texts():
        assert counter.count(text)[0] == len(reference.encode(text, add_special_tokens=False).ids), text[:100]


@pytest.mark.parametrize("seed", range(6))
def test_ties_and_unknown(seed):
    draw = random.Random(seed)
    letters = "ab▁éx"
    pieces = {"<unk>": 0.0}
    for _ in range(14):
        pieces["".join(draw.choice(letters) for _ in range(draw.randrange(1, 4)))] = float(draw.randrange(-4, 0))
    pieces = list(pieces.items())
    reference, counter = library(pieces, False), viterbi.Counter(pieces)
    for text in ["".join(draw.choice("ab éxz") for _ in range(draw.randrange(14))) for _ in range(400)]:
        assert counter.count(text)[0] == len(reference.encode(text, add_special_tokens=False).ids), (text, pieces)


def test_documents(spark):
    pieces = viterbi.vocabulary(PATH)
    reference = library(pieces, True)
    data = [(i, t, "x", None) for i, t in enumerate(texts()[:100])]
    data += [(None, None, None, None), (7, "same", "", ""), (7, "same", "", ""), (8, "long word " * 20000, "", "")]
    rows = viterbi.with_counts(spark.createDataFrame(data, DOCS).repartition(3), pieces).collect()
    want = sorted((str(d), len(t or ""), len(reference.encode(t or "").ids)) for d, t, *_ in data)
    assert sorted((str(r.doc_id), r.n_chars, r.n_tokens) for r in rows) == want
    assert viterbi.with_counts(spark.createDataFrame([], DOCS), pieces).count() == 0
