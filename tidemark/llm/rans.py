"""Token ids in binary blocks, coded by a static range asymmetric numeral system.

Token ids of all documents are counted once; the counts, scaled to a power of two, are the one frequency table
that all blocks share. A block holds whole documents in order, of about ``block_tokens`` ids, and is coded for
itself: its ids are dealt to lanes that advance together, each lane a coder of its own, all writing to one stream
of 32-bit words. A block carries its documents' ids and lengths, the lanes' states at its head and at checkpoints,
from which a reader can start in the middle, and a CRC-32 of its bytes.

On disk, blocks are rows (part, block, first, n_tokens, payload) of Parquet files, so that Spark splits, commits
and retries them; ``table`` beside them has the frequencies. Parts are ranges of doc_id, in order.

Block payload, little-endian: magic, then uint32 scale bits, lanes, checkpoint steps, tokens, documents, words,
CRC-32 of the frequency table; per document int64 id, uint8 null flag, uint32 tokens; per checkpoint uint32 word
offset and a uint64 state per lane (the first one is the head); the words as uint32; CRC-32 of all before it.

Defined cases: a null text counts as empty and has only the end id; a null doc_id sorts first; rows of one doc_id
are ordered by the CRC-32 of their ids, then their number, then by the place of their row; a very long
text is one block with what was waiting before it; other columns are ignored;
an empty table gives an empty file and an empty result.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from typing import ClassVar

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark import session
from tidemark.llm import scratch, texts

MAGIC = b"TMRANS01"
_HEAD = struct.Struct("<8s7I")
_LOW = np.uint64(1 << 31)  # lower bound of a lane's state
_32 = np.uint64(32)
#: Tokens of a part, about, where the session has fewer partitions than that takes.
_PART_TOKENS = 1 << 26


# ---- tokens


#: Letters, digits and white space of which it is certain what the pre-tokenizer's patterns take them for.
_LETTER = "A-Za-zÀ-ÖØ-öø-ɏА-я一-龥ぁ-ゖァ-ヺ가-힣"
_SURE = re.compile(f"[\\t\\n\\r -~{_LETTER}‐-‧‰-⁞]*")
_PIECE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[0-9]+| ?[^\s{_LETTER}0-9]+|\s+(?!\S)|\s+")
#: Kinds of the bytes of such texts: a byte beyond ASCII is of a letter, but for those of a character that begins with
#: 0xE2. Texts end with a zero.
_END, _WHITE, _WORD, _DIGIT, _OTHER = range(5)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[0] = _END
_KIND[[0x09, 0x0A, 0x0D, 0x20]] = _WHITE
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = _WORD
_KIND[0x30:0x3A] = _DIGIT
_KIND[0xE2] = _OTHER
_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}


def cut(data: np.ndarray) -> np.ndarray:
    """Starts of the pieces that ``_PIECE`` finds in texts of ``_SURE`` characters, and of the zero after each text."""
    kind = _KIND[data]
    at = np.flatnonzero(data == 0xE2)
    kind[at + 1] = kind[at + 2] = _OTHER
    end, white = kind == _END, kind == _WHITE
    change = kind[1:] != kind[:-1]
    head = end.copy()
    head[0] = True
    # A space goes with what it stands before; the last of other white space before that stands alone.
    head[1:] |= change & (data[:-1] != 0x20)
    head[:-1] |= white[:-1] & change & ~end[1:]
    # An apostrophe that begins a piece takes s, t, m, d, re, ve or ll, and nothing else.
    at = np.flatnonzero(head & (data == 0x27))
    after, later = data[at + 1], data[np.minimum(at + 2, len(data) - 1)]
    short = at[np.isin(after, [*b"stmd"])]
    long = at[((after == 0x72) | (after == 0x76)) & (later == 0x65) | (after == 0x6C) & (later == 0x6C)]
    head[short + 1] = head[long + 1] = False
    head[short + 2] = head[long + 3] = True
    return np.flatnonzero(head)


class PieceEncoder:
    """Ids of texts by the tokenizers library, remembering those of pieces.

    A byte-level pre-tokenizer cuts a text into pieces, and pieces are coded apart, so " word" has the same ids wherever
    it stands. In texts of ``_SURE`` characters the pieces are found in their bytes, as its pattern would; each different
    one is looked up once a call, and new ones go to the library's model alone. Other texts are cut where a space is
    followed by a visible character, which always begins a piece; of these words, those of other characters go through
    the whole tokenizer. Nothing but white space merges with a space after it, which is made sure of, so new pieces that
    begin with one are coded in a row. Texts with an added token in them are coded whole, and so are all texts of a
    tokenizer of another kind. Of twice ``most_words`` pieces and words, and those of one call, the ids are remembered;
    those not used for long go.
    """

    _BREAK = re.compile(r" (?=[!-~\w])")
    _SPACES = re.compile("(?:[ĠĉĊċČč]|Âł)+")  # as the vocabulary shows them; only these merge with a space after them
    _of: ClassVar[dict[str, PieceEncoder]] = {}

    def __init__(self, path: str, most_words: int = 150_000, longest: int = 48):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.most_words, self.longest = most_words, longest
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.kind = np.dtype("<u2" if max(vocabulary.values()) < 1 << 16 else "<u4")
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        rules = json.loads(self.tokenizer.to_str())
        self.apart = rules["normalizer"] is None and rules["pre_tokenizer"] == _BYTE_LEVEL
        self.apart = self.apart and not any(rules[name] for name in ("truncation", "padding"))
        self.model = self.tokenizer.model
        self.bare = Tokenizer(self.model)
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in rules["model"].get("merges", ())]
        self.apart = self.apart and not any(b[0] == "\u0120" and not self._SPACES.fullmatch(a) for a, b in pairs)
        self.heads = np.zeros(max(vocabulary.values()) + 1, bool)
        self.heads[[i for piece, i in vocabulary.items() if piece.startswith("\u0120")]] = True
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # the others follow at 256
        self.letters = np.arange(256, dtype="<u4")
        self.letters[sorted({*range(256)} - {*shown})] = np.arange(256, 512 - len(shown))
        self.words: dict[bytes | str, bytes] = {}
        self.older: dict[bytes | str, bytes] = {}
        self.end = np.zeros(1, self.kind).tobytes()

    @classmethod
    def of(cls, path: str) -> PieceEncoder:
        """The encoder of this Python worker, which outlives a task."""
        if path not in cls._of:
            cls._of[path] = cls(path)
        return cls._of[path]

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind)

    def _shown(self, piece: bytes) -> str:
        """The characters that stand for bytes in the vocabulary."""
        return self.letters[np.frombuffer(piece, np.uint8)].tobytes().decode("utf-32-le")

    def _piece(self, piece: bytes) -> bytes:
        """Ids of one piece, by the model alone."""
        return np.array([token.id for token in self.model.tokenize(self._shown(piece))], self.kind).tobytes()

    def _word(self, word: str) -> bytes:
        if _SURE.fullmatch(word):
            return b"".join([self._piece(piece.encode()) for piece in _PIECE.findall(word)])
        return self.ids(word).tobytes()

    def _pieces(self, pieces: list[bytes]) -> None:
        """Remember pieces. Nothing merges across a space, so those that begin with one are coded in a row."""
        spaced = [piece for piece in pieces if piece[0] == 0x20 and not piece.isspace()]
        rows = [spaced[start : start + 64] for start in range(0, len(spaced), 64)]
        rows += [[piece] for piece in pieces if piece[0] != 0x20 or piece.isspace()]
        for start in range(0, len(rows), 1024):
            part = rows[start : start + 1024]
            coded = self.bare.encode_batch_fast([self._shown(b"".join(some)) for some in part], add_special_tokens=False)
            for some, encoding in zip(part, coded, strict=True):
                ids = np.array(encoding.ids, self.kind)
                at = (np.flatnonzero(self.heads[ids]) * self.kind.itemsize).tolist() if len(some) > 1 else [0]
                if len(at) == len(some):
                    data = ids.tobytes()
                    self.words.update(zip(some, [data[low:high] for low, high in zip(at, [*at[1:], len(data)], strict=True)], strict=True))
                else:
                    self.words.update((piece, self._piece(piece)) for piece in some)

    @staticmethod
    def _split(data: pa.Array, ends: np.ndarray | None = None) -> list[bytes]:
        """The values of a binary array, or what lies between these of its places; Arrow's own way makes a scalar of each."""
        places = np.frombuffer(data.buffers()[1], np.int64)[: len(data) + 1]
        places = (places if ends is None else places[ends]).tolist()
        whole = (data.buffers()[2] or pa.py_buffer(b"")).to_pybytes()
        return [whole[low:high] for low, high in zip(places[:-1], places[1:], strict=True)]

    def _new(self, texts: Iterable) -> list:
        """Those of the texts that are not remembered; those remembered longer ago are taken over."""
        new = [text for text in texts if text not in self.words]
        again = {text: self.older[text] for text in new if text in self.older}
        self.words.update(again)
        return [text for text in new if text not in again]

    def _sure(self, texts: list[str]) -> tuple[list[bytes], list[bytes]]:
        """Ids of texts of ``_SURE`` characters, looked up once for each different piece, and the new pieces."""
        if not texts:
            return [], []
        data = np.frombuffer(b"".join([text.encode() + b"\0" for text in texts]), np.uint8)
        starts = cut(data)
        places = pa.py_buffer(np.append(starts, len(data)))
        found = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, places, pa.py_buffer(data)]).dictionary_encode()
        pieces = self._split(found.dictionary)
        self.words[b"\0"] = b""
        new = self._new(pieces)
        self._pieces(new)
        ids = pa.array([self.words[piece] for piece in pieces], pa.large_binary()).take(found.indices)
        return self._split(ids, np.append(0, np.flatnonzero(data[starts] == 0))), new

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as bytes."""
        out: list = [None] * len(texts)
        sure, others, words = [], [], set()
        for i, text in enumerate(texts):
            if not self.apart or any(token in text for token in self.added):
                out[i] = self.ids(text).tobytes()
            elif _SURE.fullmatch(text):
                sure.append(i)
            else:
                first, *rest = self._BREAK.split(text)
                others.append((i, [first, *[" " + word for word in rest]]))
                words.update(others[-1][1])
        ids, new = self._sure([texts[i] for i in sure])
        for i, some in zip(sure, ids, strict=True):
            out[i] = some
        more = self._new(words)
        self.words.update((word, self._word(word)) for word in more)
        for i, some in others:
            out[i] = b"".join(map(self.words.__getitem__, some))
        for text in (*new, *more):
            if len(text) > self.longest:
                del self.words[text]
        if len(self.words) > self.most_words:
            self.older, self.words = self.words, {}
        return out


def tokens(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, ids (with the end id), n_tokens, crc, row: one per document, in the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, place = PieceEncoder.of(tokenizer), TaskContext.get().partitionId() << 33
        for part, _, _ in texts.chunks(batches, 1, 4 << 20):
            ids = [x + encoder.end for x in encoder.encode([text or "" for text in part.column(1).to_pylist()])]
            crcs = [zlib.crc32(np.frombuffer(x, encoder.kind).astype("<u4")) for x in ids]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(ids, pa.binary()),
                    pa.array([len(x) // encoder.kind.itemsize for x in ids], pa.int64()),
                    pa.array(crcs, pa.int64()),
                    pa.array(range(place, place + len(ids)), pa.int64()),
                ],
                ["doc_id", "ids", "n_tokens", "crc", "row"],
            )
            place += len(ids)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return scratch.keep(
        rows.mapInArrow(run, "doc_id long, ids binary, n_tokens long, crc long, row long"), "tokens"
    )


def counts(rows: DataFrame, width: int) -> DataFrame:
    """id, n over all documents; counted per task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            data = b"".join(batch.column(0).to_pylist())
            found = np.bincount(np.frombuffer(data, f"<u{width}"), minlength=len(total))
            found[: len(total)] += total
            total = found
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    return rows.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


# ---- coding


class Table:
    """Frequencies that sum to 2^bits, at least 1 for every id that occurs."""

    def __init__(self, ids: np.ndarray, frequencies: np.ndarray, bits: int):
        self.bits, self.ids, self.frequencies = bits, ids, frequencies
        size = int(ids.max()) + 1 if len(ids) else 1
        self.frequency = np.zeros(size, np.uint64)
        self.frequency[ids] = frequencies
        self.start = np.zeros(size, np.uint64)
        self.start[ids] = np.cumsum(frequencies) - frequencies
        self.slots = np.repeat(ids, frequencies).astype(np.uint32)
        self.crc = zlib.crc32(ids.astype("<u4").tobytes() + frequencies.astype("<u4").tobytes())

    @classmethod
    def scaled(cls, ids: np.ndarray, n: np.ndarray, bits: int = 20) -> Table:
        order = np.argsort(ids)
        ids, n = ids[order], n[order].astype(np.int64)
        if not len(ids):
            return cls(ids.astype(np.int64), n, bits)
        bits = max(bits, int(np.ceil(np.log2(len(ids)))) + 1)
        whole = 1 << bits
        scaled = np.maximum(1, (n.astype(np.float64) * (whole / n.sum())).astype(np.int64))
        rest = whole - int(scaled.sum())
        # What rounding left over or took too much goes to the most frequent ids.
        for i in np.argsort(-scaled, kind="stable"):
            step = rest if rest > 0 else max(rest, 1 - int(scaled[i]))
            scaled[i] += step
            rest -= step
            if not rest:
                break
        return cls(ids.astype(np.int64), scaled, bits)


def encode_block(doc_ids: list, lengths: list[int], ids: np.ndarray, table: Table, lanes: int, every: int) -> bytes:
    n = len(ids)
    lanes = max(1, min(lanes, n // 64))
    bits = np.uint64(table.bits)
    states = np.full(lanes, _LOW, np.uint64)
    words, marks = [], []
    steps = -(-n // lanes)
    for step in range(steps - 1, -1, -1):
        now = ids[step * lanes : (step + 1) * lanes]
        x, frequency = states[: len(now)], table.frequency[now]
        full = x >= frequency << (np.uint64(63) - bits)
        words.append(x[full].astype(np.uint32))
        x = np.where(full, x >> _32, x)
        quotient = x // frequency
        states[: len(now)] = (quotient << bits) + (x - quotient * frequency) + table.start[now]
        if step % every == 0:
            marks.append((step, states.copy()))
    words.reverse()
    offsets = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
    stream = np.concatenate(words) if words else np.zeros(0, np.uint32)
    out = [
        _HEAD.pack(MAGIC, table.bits, lanes, every, n, len(doc_ids), len(stream), table.crc),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        np.array([d is None for d in doc_ids], "u1").tobytes(),
        np.array(lengths, "<u4").tobytes(),
    ]
    for step, state in reversed(marks):
        out += [np.array([offsets[step]], "<u4").tobytes(), state.astype("<u8").tobytes()]
    body = b"".join([*out, stream.astype("<u4").tobytes()])
    return body + struct.pack("<I", zlib.crc32(body))


class Block:
    """A checked payload; raises ValueError if it is damaged or of another table."""

    def __init__(self, payload: bytes, table: Table):
        if len(payload) < _HEAD.size + 4 or zlib.crc32(payload[:-4]) != struct.unpack("<I", payload[-4:])[0]:
            raise ValueError("block is damaged")
        magic, bits, self.lanes, self.every, self.n, n_docs, n_words, crc = _HEAD.unpack_from(payload)
        if magic != MAGIC or bits != table.bits or crc != table.crc:
            raise ValueError("block was not written with this table")
        self.table, at = table, _HEAD.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(payload, kind, count, at)
            at += out.nbytes
            return out

        doc_ids, absent = take("<i8", n_docs), take("u1", n_docs)
        self.doc_ids = [None if gone else d for d, gone in zip(doc_ids.tolist(), absent.tolist(), strict=True)]
        self.lengths = take("<u4", n_docs).astype(np.int64)
        self.steps = -(-self.n // self.lanes)
        self.marks = [
            (int(take("<u4", 1)[0]), take("<u8", self.lanes)) for _ in range(-(-self.steps // self.every))
        ]
        self.words = take("<u4", n_words)

    def decode(self, first: int = 0, last: int | None = None) -> np.ndarray:
        """The ids at [first, last), from the nearest checkpoint on."""
        last = self.n if last is None else min(last, self.n)
        if first >= last:
            return np.zeros(0, np.uint32)
        mark = first // self.lanes // self.every
        (at, states), step = self.marks[mark], mark * self.every
        states, table = states.copy(), self.table
        bits, mask = np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
        begin, out = step * self.lanes, []
        while step * self.lanes < last:
            x = states[: min(self.lanes, self.n - step * self.lanes)]
            low = x & mask
            now = table.slots[low]
            out.append(now)
            x = table.frequency[now] * (x >> bits) + low - table.start[now]
            short = np.flatnonzero(x < _LOW)
            x[short] = (x[short] << _32) | self.words[at : at + len(short)]
            at += len(short)
            states[: len(x)] = x
            step += 1
        return np.concatenate(out)[first - begin : last - begin]


# ---- files


def write(
    rows: DataFrame, path: str, width: int, block_tokens: int = 1 << 18, lanes: int = 1024, every: int = 128
) -> None:
    """Write the output of ``tokens`` in ascending doc_id order."""
    spark = rows.sparkSession
    counted = counts(rows, width).toArrow()  # at most one row per id of the vocabulary
    table = Table.scaled(counted["id"].to_numpy(), counted["n"].to_numpy())
    spark.createDataFrame(
        list(zip(table.ids.tolist(), table.frequencies.tolist(), strict=True)), "id long, frequency long"
    ).coalesce(1).write.parquet(f"{path}/table")
    shared = spark.sparkContext.broadcast((table.ids, table.frequencies, table.bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part = Table(*shared.value), TaskContext.get().partitionId()
        names = ["part", "block", "first", "n_tokens", "payload"]
        block = first = size = 0
        doc_ids: list = []
        lengths: list[int] = []
        waiting: list[bytes] = []

        def finished() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(waiting), f"<u{width}")
            payload = encode_block(doc_ids, lengths, ids, own, lanes, every)
            columns = [[part], [block], [first], [len(ids)]]
            return pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in columns), pa.array([payload], pa.binary())], names
            )

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                doc_ids.append(doc_id)
                lengths.append(len(ids) // width)
                waiting.append(ids)
                size += lengths[-1]
                if size >= block_tokens:
                    yield finished()
                    block, first, size = block + 1, first + size, 0
                    doc_ids, lengths, waiting = [], [], []
        if doc_ids:
            yield finished()

    order = ["doc_id", "crc", "n_tokens", "row"]
    parts = max(scratch.partitions(spark), int(counted["n"].to_numpy().sum()) // _PART_TOKENS + 1)
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    blocks = dealt.select("doc_id", "ids").mapInArrow(
        run, "part long, block long, first long, n_tokens long, payload binary"
    )
    # ids are coded already; packing them again would only cost time
    blocks.write.option("compression", "none").parquet(f"{path}/blocks")


def read_table(spark: SparkSession, path: str) -> Table:
    rows = spark.read.parquet(f"{path}/table").orderBy("id").toArrow()
    frequencies = rows["frequency"].to_numpy()
    bits = int(frequencies.sum()).bit_length() - 1 if len(frequencies) else 0
    return Table(rows["id"].to_numpy(), frequencies, bits)


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, ids (uint32), n_tokens, ids_crc32 of every document in the files."""
    table = read_table(spark, path)
    shared = spark.sparkContext.broadcast((table.ids, table.frequencies, table.bits))
    blocks = spark.read.parquet(f"{path}/blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        names = ["part", "doc_id", "first", "ids", "n_tokens", "ids_crc32"]
        for batch in batches:
            own = own or Table(*shared.value)
            for part, first, payload in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                block = Block(payload, own)
                ids = block.decode().astype("<u4")
                ends = np.cumsum(block.lengths)
                pieces = [ids[end - n : end] for end, n in zip(ends.tolist(), block.lengths.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * len(pieces), pa.int64()),
                        pa.array(block.doc_ids, pa.int64()),
                        pa.array(first + ends - block.lengths),
                        pa.array([p.tobytes() for p in pieces], pa.binary()),
                        pa.array(block.lengths),
                        pa.array([zlib.crc32(p) for p in pieces], pa.int64()),
                    ],
                    names,
                )

    schema = "part long, doc_id long, first long, ids binary, n_tokens long, ids_crc32 long"
    documents = blocks.select("part", "first", "payload").mapInArrow(run, schema)
    # One row per part: as many as the writer had partitions.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = blocks.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    starts = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    return documents.join(F.broadcast(starts), "part").select(
        "doc_id", (F.col("base") + F.col("first")).alias("start"), "ids", "n_tokens", "ids_crc32"
    )


def store(docs: DataFrame, tokenizer: str, path: str | None = None, **how) -> str:
    """Encode documents into files at ``path`` (by default in the shared folder) and name it."""
    path = path or session.scratch_dir(docs.sparkSession, "rans")
    width = PieceEncoder(tokenizer).kind.itemsize
    write(tokens(docs, tokenizer), path, width, **how)
    return path


def report(docs: DataFrame, tokenizer: str, **how) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    path = store(docs, tokenizer, **how)
    return read(docs.sparkSession, path).drop("ids")
