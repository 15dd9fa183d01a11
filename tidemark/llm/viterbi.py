"""Token counts of a unigram tokenizer without its tokens.

An Aho-Corasick automaton enumerates the vocabulary pieces inside a word; dynamic programming carries, per
place, the best score and the number of pieces on the way to it, but no way back. Ties go as in the tokenizers
library: candidates for an end are tried from the earliest start on and only a strictly better score replaces
one, and a character that is no piece itself is tried as unknown, at ten below the lowest score. Neighbouring
unknown characters fuse into one token, or into one per byte where the vocabulary has all byte pieces.

Text is split before each space, as that tokenizer's pre-tokenizer does, and a space is put in front if there is
none; so words are counted apart, and those already seen in the task are remembered.

Defined cases: null and empty texts have 0 tokens and score 0; rows are counted one by one, so repeated ones too;
very long texts and words are counted whole; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"


def vocabulary(model: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model file."""
    from sentencepiece import SentencePieceProcessor

    pieces = SentencePieceProcessor(model_file=model)
    return [(pieces.id_to_piece(i), pieces.get_score(i)) for i in range(pieces.get_piece_size())]


class Counter:
    def __init__(self, pieces: list[tuple[str, float]], most_words: int = 400_000, longest: int = 48):
        import ahocorasick

        scores: dict[str, float] = {}
        for piece, score in pieces:
            scores[piece] = score  # of equal pieces the last one counts
        self.automaton = ahocorasick.Automaton()
        for piece, score in scores.items():
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min((score for _, score in pieces), default=0.0) - 10.0
        self.by_bytes = all(f"<0x{byte:02X}>" in scores for byte in range(256))
        self.words: dict[str, tuple[int, float]] = {}
        self.most_words, self.longest = most_words, longest

    def best(self, word: str) -> tuple[int, float]:
        """Number of tokens and score of the best segmentation."""
        n = len(word)
        score, count, fused = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        matches: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        for last, match in self.automaton.iter(word):
            matches[last + 1].append(match)
        for end in range(1, n + 1):
            top, tokens, unknown, single = None, 0, False, False
            for length, own in sorted(matches[end], reverse=True):
                start = end - length
                candidate = own + score[start]
                if top is None or candidate > top:
                    top, tokens = candidate, count[start] + 1
                single |= length == 1
            if not single:
                candidate = self.unknown + score[end - 1]
                if top is None or candidate > top:
                    top, unknown = candidate, True
                    if self.by_bytes:
                        tokens = count[end - 1] + len(word[end - 1].encode())
                    else:
                        tokens = count[end - 1] + (not fused[end - 1])
            score[end], count[end], fused[end] = top, tokens, unknown
        return count[n], score[n]

    def word(self, word: str) -> tuple[int, float]:
        found = self.best(MARK + word)
        if len(word) <= self.longest:
            if len(self.words) >= self.most_words:
                self.words.clear()
            self.words[word] = found
        return found

    def count(self, text: str) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        words = text.replace(MARK, " ").split(" ")
        if not words[0]:
            del words[0]
        known, word = self.words.get, self.word
        found = [known(part) or word(part) for part in words]
        return sum([n for n, _ in found]), sum([score for _, score in found])


def with_counts(docs: DataFrame, pieces: list[tuple[str, float]], text: str = "text") -> DataFrame:
    """doc_id, n_chars, n_tokens, score for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(pieces)  # the vocabulary, of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                found = [counter.count(value or "") for value in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array([n for n, _ in found], pa.int64()),
                        pa.array([score for _, score in found], pa.float64()),
                    ],
                    ["doc_id", "n_chars", "n_tokens", "score"],
                )

    source = F.col(text).cast("string")
    rows = docs.select("doc_id", F.coalesce(F.length(source), F.lit(0)).cast("long").alias("n_chars"), source.alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_chars long, n_tokens long, score double")
