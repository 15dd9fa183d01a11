"""Looking up keyword and program documents for events.

No side is broadcast by hint. A side becomes a broadcast only when AQE has
measured it below the session's threshold; above it the join shuffles on the
lookup key and AQE splits the partition of a key that holds many events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.jsondoc import unwrap_id
from tidemark.functions.once import with_once
from tidemark.functions.times import epoch_ms
from tidemark.sources import schemas

MODES = ("documents_only", "with_event")


def with_lookup_keys(keywords: DataFrame) -> DataFrame:
    """Materialize the lookup fields of a keyword state table as columns.

    Keep them in the stored table: a filter on a column reaches the Parquet
    scan, a filter on a JSON path does not.
    """
    eligibility = F.col("k.eligibility")
    return with_once(keywords, "k", F.from_json("document", schemas.KEYWORD_KEYS)).select(
        *keywords.columns,
        eligibility["name"].alias("name"),
        unwrap_id(eligibility["program_id"]["_id"]).alias("program_id"),
        epoch_ms(eligibility["start_period"]["$date"]).alias("start_period"),
        epoch_ms(eligibility["end_period"]["$date"]).alias("end_period"),
    )


def keyword_programs(keywords: DataFrame, programs: DataFrame) -> DataFrame:
    """Keyword joined to its program: ``name, _id, keyword_doc, program_doc``."""
    k = with_lookup_keys(keywords).select("name", "_id", "program_id", F.col("document").alias("keyword_doc"))
    p = programs.select(F.col("_id").alias("program_id"), F.col("document").alias("program_doc"))
    return k.join(p, "program_id", "inner")


def first_per_name(keywords: DataFrame, programs: DataFrame) -> DataFrame:
    """One row per keyword name: the smallest keyword id that has a program.

    The program documents join after the choice, so only one per name moves.
    ``documents`` is the outgoing JSON text, made here once per name rather
    than once per event; the customer in it is always null.
    """
    k = with_lookup_keys(keywords).filter(F.col("name").isNotNull())
    with_program = k.join(programs.select(F.col("_id").alias("program_id")), "program_id", "left_semi")
    first = with_program.groupBy("name").agg(
        F.min_by(F.struct("_id", "program_id", F.col("document").alias("keyword_doc")), "_id").alias("k")
    )
    p = programs.select(F.col("_id").alias("program_id"), F.col("document").alias("program_doc"))
    both = (
        first.select("name", "k.*")
        .join(p, "program_id", "inner")
        .select("name", F.col("_id").alias("keyword_id"), "program_id", "keyword_doc", "program_doc")
    )
    documents = F.to_json(
        F.struct(
            F.parse_json("keyword_doc").alias("keyword"),
            F.parse_json("program_doc").alias("program"),
            F.lit(None).cast("string").alias("customer"),
        ),
        {"ignoreNullFields": "false"},
    )
    return with_once(both, "documents", documents)


def enrich(events: DataFrame, lookup: DataFrame, keyword: str = "keyword") -> DataFrame:
    """Left lookup by keyword name; a lookup row per name, so event rows stay one each."""
    return events.join(lookup.withColumnRenamed("name", keyword), keyword, "left")


def matched(enriched: DataFrame) -> DataFrame:
    """Only events whose keyword was found."""
    return enriched.filter(F.col("keyword_id").isNotNull())


def message(enriched: DataFrame, mode: str = "documents_only", event_columns: list[str] | None = None) -> DataFrame:
    """The outgoing record: JSON text of the documents, or also of the event itself."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if mode == "documents_only":
        return enriched.select(F.col("documents").alias("value"))
    event = F.to_json(F.struct(*(event_columns or [])), {"ignoreNullFields": "false"})
    rest = F.substring("documents", F.lit(2), F.length("documents"))
    return enriched.select(F.concat(F.lit('{"event":'), event, F.lit(","), rest).alias("value"))


def with_existence(events: DataFrame, keywords: DataFrame, keyword: str = "keyword") -> DataFrame:
    """Flag ``found``: is there any keyword document of that name?"""
    names = with_lookup_keys(keywords).select(F.col("name").alias(keyword)).distinct()
    flagged = events.join(names.withColumn("found", F.lit(True)), keyword, "left")
    return flagged.withColumn("found", F.coalesce("found", F.lit(False)))


def redeem_periods(events: DataFrame, keywords: DataFrame, keyword: str = "keyword") -> DataFrame:
    """Every keyword of that name with its period (left join), for events with an id."""
    periods = with_lookup_keys(keywords).select(F.col("name").alias(keyword), "start_period", "end_period")
    return events.filter(F.col("transaction_id").isNotNull()).join(periods, keyword, "left")


def keyed_message(rows: DataFrame, key: str, tombstone: Column | None = None) -> DataFrame:
    """JSON key and value; a null value tells the reader to drop the key."""
    value = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
    if tombstone is not None:
        value = F.when(~tombstone, value)
    return rows.select(F.to_json(F.struct(key)).alias("key"), value.alias("value"))
