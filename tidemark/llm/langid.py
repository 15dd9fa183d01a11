"""Language identification by n-gram filters with one bit per language.

A bit-sliced Bloom filter holds, at every place, one bit per language, so one lookup gives all languages
whose profile contains an n-gram. A text's n-grams are counted per language; the counts are corrected by the
share of false positives that the filter's own fill predicts; the largest corrected count decides.

Profiles: the ``profile`` most frequent n-grams of each language that are not much rarer in it than in
another one, counted over a sample of about ``sample_docs`` labelled documents per language (all of them
where there are fewer). The filter has about ten places per n-gram, so the model's size is bounded by profile
times languages; it is gathered on the driver and sent to the tasks.

Defined cases: `und` for null texts, texts without a letter, and where nothing could be learned; a text with
letters but no known n-gram gets the most frequent learned language with score 0; ties go to the language
that sorts first; a null doc_id is not held out; a very long text is judged by all its
n-grams; other columns are ignored; equal rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm import texts

SIZE = 4  # bytes of an n-gram, so that a code is the n-gram itself
_HASHES = tuple(np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D))
# Letters in lower case, bytes of other alphabets as they are, all else a space.
_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def ngrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, whether each counts (a letter at its second byte), and the bounds of each text's codes."""
    n = len(offsets) - 1
    lengths = np.diff(offsets)
    # A space before each text and one after the last; the space of the next text ends a text.
    padded = np.full(len(data) + n + SIZE, 32, np.uint8)
    padded[np.arange(len(data)) + np.repeat(np.arange(1, n + 1), lengths)] = _FOLD[data]
    wide = padded.astype(np.uint32)
    last = len(padded) - SIZE + 1
    codes = wide[:last].copy()
    for i in range(1, SIZE):
        codes |= wide[i : i + last] << np.uint32(8 * i)
    heads = offsets + np.arange(n + 1)
    counts = padded[1 : last + 1] != 32
    # The last two n-grams of a text would reach into the next one.
    for back in (1, 2):
        at = heads[1:] - back
        counts[at[at >= heads[:-1]]] = False
    return codes, counts, heads


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for rows, data, offsets in texts.chunks(batches, 1):
        langs = rows.column(0).to_pylist()
        codes, counts, heads = ngrams(data, offsets)
        for lang in set(langs):
            own = np.zeros(len(codes), bool)
            for i, name in enumerate(langs):
                if name == lang:
                    own[heads[i] : heads[i + 1]] = True
            found, n = np.unique(codes[own & counts], return_counts=True)
            if lang in totals:
                found, back = np.unique(np.concatenate([totals[lang][0], found]), return_inverse=True)
                n = np.bincount(back, np.concatenate([totals[lang][1], n])).astype(np.int64)
            totals[lang] = (found, n)
    for lang, (found, n) in totals.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(found), pa.string()), pa.array(found.astype(np.int64)), pa.array(n.astype(np.int64))],
            ["lang", "code", "n"],
        )


@dataclass
class Model:
    langs: list[str]
    default: str
    planes: list[np.ndarray]  # per 64 languages, one bit each
    shift: int
    chance: np.ndarray  # of a false positive, per language


def learn(docs: DataFrame, sample_docs: int = 4000, profile: int = 40_000, least_ratio: float = 0.3) -> Model:
    """From the text and lang of rows that have both."""
    labelled = docs.where("text IS NOT NULL AND lang IS NOT NULL")
    sizes = labelled.groupBy("lang").count()
    draw = F.pmod(F.xxhash64("doc_id", "n_bytes"), F.lit(1 << 30)) / float(1 << 30)
    drawn = (
        labelled.withColumn("n_bytes", F.octet_length("text"))
        .join(F.broadcast(sizes), "lang")  # a row per language
        .where(draw * F.col("count") < sample_docs)
        .select("lang", "text")
    )
    counts = (
        drawn.mapInArrow(_counted, "lang string, code long, n long")
        .groupBy("lang", "code")
        .agg(F.sum("n").alias("n"))
        .withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("lang")))
        .withColumn("best", F.max("share").over(Window.partitionBy("code")))
        .where(F.col("share") >= F.col("best") * least_ratio)
    )
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    chosen = counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= profile)
    table = chosen.select("lang", "code").toArrow()  # at most profile rows per language
    frequent = {row["lang"]: row["count"] for row in sizes.collect()}
    langs = sorted(frequent)
    default = min(langs, key=lambda lang: (-frequent[lang], lang)) if langs else ""
    bits = max(10, int(np.ceil(np.log2(10 * max(1, table.num_rows)))))
    shift = 32 - min(bits, 30)
    place = {lang: i for i, lang in enumerate(langs)}
    own = np.array([place[lang] for lang in table["lang"].to_pylist()], np.int64)
    codes = table["code"].to_numpy().astype(np.uint32)
    planes, chance = [], []
    for first in range(0, len(langs), 64):
        plane = np.zeros(1 << (32 - shift), np.uint64)
        here = (own >= first) & (own < first + 64)
        masks = np.uint64(1) << (own[here] - first).astype(np.uint64)
        for factor in _HASHES:
            np.bitwise_or.at(plane, (codes[here] * factor) >> np.uint32(shift), masks)
        for i in range(min(64, len(langs) - first)):
            chance.append(float(np.mean((plane >> np.uint64(i)) & np.uint64(1))) ** len(_HASHES))
        width = next(w for w in (8, 16, 32, 64) if len(langs) - first <= w or w == 64)
        planes.append(plane.astype(f"u{width // 8}"))
    return Model(langs, default, planes, shift, np.array(chance))


def judge(model: Model, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the language and score of each text; -1 where no n-gram is known."""
    codes, counted, heads = ngrams(data, offsets)
    tops = heads[1:]

    def per_text(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return sums[tops] - sums[heads[:-1]]

    total = per_text(counted)
    places = [(codes * factor) >> np.uint32(model.shift) for factor in _HASHES]
    hits = []
    for plane in model.planes:
        masks = plane[places[0]] & plane[places[1]] & plane[places[2]]
        masks[~counted] = 0
        for i in range(min(64, len(model.langs) - 64 * (len(hits) // 64))):
            hits.append(per_text((masks >> masks.dtype.type(i)) & masks.dtype.type(1)))
    found = (np.array(hits) - total * model.chance[:, None]) / (1 - model.chance[:, None])
    best = np.argmax(found, axis=0)
    score = np.clip(found[best, np.arange(len(best))] / np.maximum(total, 1), 0, 1)
    return np.where(score > 0, best, -1), score


def predict(docs: DataFrame, model: Model, text: str = "text", pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """docs with the prediction and its score; columns of these names are replaced."""
    from pyspark.sql import types as T

    plain = docs.drop(pred, score)
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    rows = plain.select(
        F.struct(*[F.col(f"`{name}`") for name in plain.columns]).alias("row"),
        F.col(text).cast("string").alias("text"),
        letters.alias("letters"),
    )
    fields = T.StructType([rows.schema["row"], T.StructField(pred, T.StringType()), T.StructField(score, T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the profile size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = shared.value
        for part, data, offsets in texts.chunks(batches, 1):
            has = part.column(2).to_numpy(zero_copy_only=False)
            if learned.langs:
                best, value = judge(learned, data, offsets)
            else:
                best, value, has = np.full(len(has), -1), np.zeros(len(has)), np.zeros(len(has), bool)
            names = [
                "und" if not ok else learned.langs[i] if i >= 0 else learned.default
                for i, ok in zip(best.tolist(), has.tolist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(names, pa.string()), pa.array(np.where(has, value, 0.0))], ["row", pred, score]
            )

    done = rows.mapInArrow(run, fields)
    return done.select("row.*", pred, score)


def report(docs: DataFrame, **how) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row."""
    model = learn(docs.where(~held_out(F.col("doc_id"))), **how)
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return predict(rows, model).drop("text")
