"""Benchmark decontamination by a hash set of normalised test n-grams.

Words are runs of letters and digits after A-Z have been lower-cased. Every benchmark item gives its
windows of ``span`` consecutive words; a shorter item gives one window. The 64-bit codes of all windows are
the hash set. Each document is scanned in its own row: the code of each of its windows is looked up, and only
windows that are found leave the row, as text, to be verified against the benchmark's windows by an equi-join.

The set travels inside the expression while the benchmark has at most ``set_limit`` windows (the limit of
what is sent to each task; it is measured, not assumed). A larger benchmark meets the documents' window
codes in a shuffled semi-join instead, with the same result.

Defined cases: null or empty texts have no words and no hits; an item without words is ignored; items with
equal windows are all reported; an item_id that is null marks words but is not listed; document rows that
agree in every column are judged each for itself; a very long text is scanned whole;
other columns are ignored; an empty benchmark hits nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.once import with_once
from tidemark.llm import scratch

# All ASCII characters but digits and letters.
SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lowered(text: Column) -> Column:
    """A-Z only; lower() alone would also change other alphabets."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _LOWER)
    )


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(_lowered(text), F.lit("")), SEPARATOR), lambda word: word != "")


def _positions(length: str) -> str:
    """Every 1-based place where a window of this length fits."""
    return f"CASE WHEN n_words >= {length} THEN sequence(1, n_words - {length} + 1) ELSE array() END"


def benchmark_windows(benchmark: DataFrame, span: int) -> DataFrame:
    """length, code, window (words joined by a space), items (distinct ids)."""
    return (
        benchmark.select(F.col("item_id").cast("string"), words(F.col("text")).alias("words"))
        .withColumn("n_words", F.size("words"))
        .where("n_words > 0")
        .withColumn("length", F.least(F.col("n_words"), F.lit(span)))
        .select("item_id", "words", "length", F.explode(F.expr(_positions("length"))).alias("place"))
        .selectExpr("item_id", "length", "slice(words, place, length) AS window")
        .selectExpr(
            "item_id",
            "length",
            "xxhash64(transform(window, word -> xxhash64(word))) AS code",
            "array_join(window, ' ') AS window",
        )
        .groupBy("length", "code", "window")
        .agg(F.collect_set("item_id").alias("items"))
    )


def _scanned(docs: DataFrame, columns: list[str]) -> DataFrame:
    rows = with_once(docs.select(*columns, "text"), "words", words(F.col("text"))).drop("text")
    rows = rows.withColumn("n_words", F.size("words"))
    return with_once(rows, "codes", F.expr("transform(words, word -> xxhash64(word))"))


def _found(places: Column | str, length: int) -> str:
    return f"""transform({places}, place -> struct(place AS place, {length} AS length,
        array_join(slice(words, place, {length}), ' ') AS window))"""


def _by_set(rows: DataFrame, codes: dict[int, list[int]]) -> DataFrame:
    """Windows whose code is in the set, looked up where the row is."""
    found = [
        _found(
            f"""filter({_positions(str(length))}, place ->
                xxhash64(slice(codes, place, {length})) IN ({",".join(f"{code}L" for code in values)}))""".replace(
                "-9223372036854775808L", "(-9223372036854775807L - 1L)"
            ),
            length,
        )
        for length, values in sorted(codes.items())
    ]
    empty = "cast(array() AS array<struct<place: int, length: int, window: string>>)"
    return rows.withColumn("found", F.expr(f"concat({', '.join(found)})" if found else empty))


def _by_join(rows: DataFrame, windows: DataFrame, lengths: list[int]) -> DataFrame:
    """The same, for a set too large to be sent along: codes meet in a shuffle."""
    rows = scratch.keep(rows, "scanned")
    spread = " UNION ALL ".join(
        f"SELECT row, {length} AS length, place, xxhash64(slice(codes, place, {length})) AS code FROM "
        f"(SELECT row, codes, explode({_positions(str(length))}) AS place FROM {{rows}})"
        for length in lengths
    )
    hits = rows.sparkSession.sql(spread, rows=rows).join(
        windows.select("length", "code").distinct(), ["length", "code"], "left_semi"
    )
    places = hits.groupBy("row").agg(F.collect_list(F.struct("place", "length")).alias("places"))
    return (
        rows.join(places, "row", "left")
        .withColumn("places", F.expr("coalesce(places, array())"))
        .withColumn(
            "found",
            F.expr(
                """transform(places, at -> struct(at.place AS place, at.length AS length,
                   array_join(slice(words, at.place, at.length), ' ') AS window))"""
            ),
        )
    )


def judge(docs: DataFrame, benchmark: DataFrame, columns: list[str], span: int = 10, set_limit: int = 20_000) -> DataFrame:
    """Per row of ``docs``: the given columns, n_words, hits (sorted place, length; 1-based), items (sorted).

    No name in ``columns`` may be one of those added here.
    """
    windows = scratch.keep(benchmark_windows(benchmark, span), "windows")
    sizes = {row["length"]: row["n"] for row in windows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    rows = _scanned(docs.withColumn("row", F.monotonically_increasing_id()), ["row", *columns])
    if total <= set_limit:
        codes: dict[int, list[int]] = {}
        for row in windows.select("length", "code").distinct().collect():  # at most set_limit rows
            codes.setdefault(row["length"], []).append(row["code"])
        rows, right = _by_set(rows, codes), F.broadcast(windows)
    else:
        rows, right = _by_join(rows, windows, sorted(sizes)), windows
    spread = rows.select("row", *columns, "n_words", F.explode_outer("found").alias("at")).select(
        "row", *columns, "n_words", "at.place", "at.length", "at.window"
    )
    verified = spread.join(right.select("length", "window", "items"), ["length", "window"], "left")
    return (
        verified.groupBy("row", *columns, "n_words")
        .agg(
            F.array_sort(
                F.collect_list(F.expr("CASE WHEN items IS NOT NULL THEN struct(place, length) END"))
            ).alias("hits"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
        .drop("row")
    )


def hit_words(hits: Column) -> Column:
    """Number of words covered by sorted hits, which may overlap."""
    start = F.struct(F.lit(0).alias("reach"), F.lit(0).alias("total"))

    def cover(now: Column, hit: Column) -> Column:
        end = hit["place"] + hit["length"]
        return F.struct(
            F.greatest(now["reach"], end).alias("reach"),
            (now["total"] + F.greatest(F.lit(0), end - F.greatest(now["reach"], hit["place"]))).alias("total"),
        )

    return F.aggregate(hits, start, cover)["total"]


def report(docs: DataFrame, benchmark: DataFrame, span: int = 10, set_limit: int = 20_000) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return (
        judge(docs, benchmark, ["doc_id"], span, set_limit)
        .select(
            "doc_id",
            F.col("n_words").cast("long"),
            hit_words(F.col("hits")).cast("long").alias("n_hit"),
            F.size("items").cast("long").alias("n_items"),
            F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        )
        .withColumn("contaminated", F.col("n_hit") > 0)
    )


def clean(
    docs: DataFrame, benchmark: DataFrame, remove: str = "documents", span: int = 10, set_limit: int = 20_000
) -> DataFrame:
    """The documents without the contaminated ones, or with the hit words cut out of their texts.

    ``remove``: "documents" or "spans". A cut takes a word with the separators after it; texts
    without a hit are returned byte for byte. Columns and their order stay. Below ``set_limit`` the windows
    themselves travel along as well, so that no document is shuffled.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove must be 'documents' or 'spans'")
    whole = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("document"), F.col("text").alias("text")
    )
    windows = scratch.keep(benchmark_windows(benchmark, span), "windows")
    if windows.count() <= set_limit:
        codes: dict[int, list[int]] = {}
        texts = []
        for row in windows.select("length", "code", "window").collect():  # at most set_limit rows
            codes.setdefault(row["length"], []).append(row["code"])
            texts.append(row["window"])
        verified = F.filter("found", lambda at: at["window"].isin(texts))
        hits = F.array_sort(F.transform(verified, lambda at: F.struct(at["place"].alias("place"), at["length"].alias("length"))))
        judged = with_once(_by_set(_scanned(whole, ["document"]), codes), "hits", hits)
    else:
        judged = judge(whole, benchmark, ["document"], span, set_limit)
    if remove == "documents":
        return judged.where(F.size("hits") == 0).select("document.*")
    # word i with its separators is piece i; a text may begin with separators, which are a piece of their own
    ascii_part = r"\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F"
    pieces = F.expr(f"regexp_extract_all(document.text, '^[{ascii_part}]+|[^{ascii_part}]+[{ascii_part}]*', 0)")
    kept = F.expr(
        """array_join(filter(pieces, (piece, i) -> NOT exists(hits, hit ->
           i + 1 - offset >= hit.place AND i + 1 - offset < hit.place + hit.length)), '')"""
    )
    cut = (
        judged.withColumn("pieces", F.when(F.size("hits") > 0, pieces))
        .withColumn("offset", F.size("pieces") - F.col("n_words"))
        .withColumn("cut", F.when(F.size("hits") > 0, kept).otherwise(F.col("document.text")))
    )
    return cut.select(
        *[F.col("cut").alias(name) if name == "text" else F.col(f"document.`{name}`").alias(name) for name in docs.columns]
    )
