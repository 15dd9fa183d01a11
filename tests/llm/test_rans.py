import random
import zlib

import duckdb
import numpy as np
import oracle
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import rans

PATH = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, ids string, start string"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_words_remembered_equal_the_library(library):
    encoder = rans.PieceEncoder(PATH, most_words=50)
    draw = random.Random(4)
    parts = ["a", "the", " ", "  ", "\n", "\t", "'s", "don't", "é", "日本", "😀", "12", " ", "\x1c", "\u0085", "<|endoftext|>", "-", "_", "ﬁ", "​"]
    texts = ["".join(draw.choice(parts) + draw.choice(["", " "]) for _ in range(draw.randrange(30))) for _ in range(1500)]
    texts += [r[0] for r in duckdb.sql(f"SELECT text FROM '{oracle.FOLDER}/documents.parquet'").fetchall()]
    for start in range(0, len(texts), 40):
        some = texts[start : start + 40]
        for text, ids in zip(some, encoder.encode(some), strict=True):
            want = library.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids, encoder.kind).tolist() == want, text[:200]


def test_a_word_is_coded_once_whatever_stands_after_it(library):
    words = [f"{a}{b}{c}" for a in ("tha", "ondi", "Größ", "жи") for b in ("ner", "lith", "éau", "日本") for c in "abcde"]
    tails = [",", ".", "!", ".\n", "--", " ", "  ", "\n\n", ")", "###"]
    texts = [f"{tail} ".join(words) for tail in tails]
    encoder = rans.PieceEncoder(PATH)
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(ids, encoder.kind).tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(encoder.words) < 4 * len(words)  # before, one for each word and tail


def test_pieces_of_sure_characters_equal_the_library(library):
    encoder = rans.PieceEncoder(PATH)
    for c in [chr(i) for i in range(0x2100) if rans._SURE.fullmatch(chr(i))] + list("一龥ぁゖァヺ가힣"):
        text = f"a{c}b {c}1{c} {c}{c} {c}'s\n{c}! {c} \n {c}\t{c}. "
        assert rans._SURE.fullmatch(text)
        assert np.frombuffer(encoder.encode([text])[0], encoder.kind).tolist() == library.encode(text, add_special_tokens=False).ids, c


def test_pieces_are_cut_in_bytes_and_not_one_by_one(library, monkeypatch):
    draw = random.Random(6)
    parts = [*"  \n\t\r'''sstmdrvell.,-aZ09éß", "…", "—", "一", "가", "‰"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randrange(14))) for _ in range(6000)]
    data = b"".join(text.encode() + b"\0" for text in texts)
    starts = rans.cut(np.frombuffer(data, np.uint8)).tolist()
    want = [piece.encode() for text in texts for piece in [*rans._PIECE.findall(text), "\0"]]
    assert [data[low:high] for low, high in zip(starts, [*starts[1:], len(data)], strict=True)] == want
    monkeypatch.setattr(rans, "_PIECE", None)  # before, it made one string for each piece of a text
    encoder = rans.PieceEncoder(PATH, most_words=500)
    for start in range(0, len(texts), 100):
        some = texts[start : start + 100]
        for text, ids in zip(some, encoder.encode(some), strict=True):
            assert np.frombuffer(ids, encoder.kind).tolist() == library.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("n", [1, 63, 64, 1000, 70_000])
@pytest.mark.parametrize("distinct", [1, 7, 5000])
def test_round_trip(n, distinct):
    draw = np.random.default_rng(n + distinct)
    ids = np.minimum(draw.zipf(1.3, n), distinct).astype(np.uint32) * 3
    table = rans.Table.scaled(*np.unique(ids, return_counts=True), bits=14)
    assert int(table.frequencies.sum()) == 1 << table.bits
    payload = rans.encode_block([None, 5], [0, n], ids, table, lanes=128, every=16)
    block = rans.Block(payload, table)
    assert block.doc_ids == [None, 5] and block.lengths.tolist() == [0, n]
    assert (block.decode() == ids).all()
    for first, last in [(0, 1), (n // 2, n // 2 + 9), (n - 1, n), (n, n + 5)]:
        assert (block.decode(first, last) == ids[first:last]).all()


def test_damage_is_found():
    ids = np.arange(500, dtype=np.uint32) % 7
    table = rans.Table.scaled(*np.unique(ids, return_counts=True))
    payload = rans.encode_block([1], [500], ids, table, 4, 16)
    for at in (3, len(payload) // 2, len(payload) - 1):
        with pytest.raises(ValueError):
            rans.Block(payload[:at] + bytes([payload[at] ^ 1]) + payload[at + 1 :], table)
    with pytest.raises(ValueError):
        rans.Block(payload, rans.Table.scaled(np.array([0, 1]), np.array([3, 4])))


def test_documents(spark, library):
    data = [(i * 7 % 101, f"text {i} of Größe  {i % 9}\n", "x", None) for i in range(101)]
    data += [(None, "no id", "x", None), (500, None, "x", None), (501, "", "x", None), (502, "word " * 30000, "y", None)]
    data += [(600, "same", "", "")] * 40 + [(600, "other", "", "")]
    docs = spark.createDataFrame(data, DOCS).repartition(3)
    rows = rans.report(docs, PATH, block_tokens=300, lanes=8, every=4).collect()
    want = []
    for doc_id, text, *_ in data:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        want.append((-1 if doc_id is None else doc_id, zlib.crc32(np.array(ids, "<u4").tobytes()), len(ids)))
    want.sort()
    starts = np.concatenate([[0], np.cumsum([n for *_, n in want])])[:-1].tolist()
    got = sorted((r.start, -1 if r.doc_id is None else r.doc_id, r.ids_crc32, r.n_tokens) for r in rows)
    assert got == [(s, *w) for s, w in zip(starts, want, strict=True)]


def test_empty(spark):
    assert rans.report(spark.createDataFrame([], DOCS), PATH).count() == 0
