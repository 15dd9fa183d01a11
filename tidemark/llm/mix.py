"""Mixing sources to target weights by iterative proportional fitting.

Documents are counted into cells (one per combination of margin values); token weights of the cells are raked
to the target share of each margin in turn, for a fixed number of sweeps. A document of a cell is then kept
with a probability in proportion to target over actual weight, the largest being 1, by a hash of its id.

Only the cell table is iterated over: each step sums it by one margin (combined before the shuffle), joins the
sums back and is written to the shared folder, so that the plan of a step stays small. Documents meet the
finished table once; it is sent to the tasks if it has at most ``sent_cells`` rows, by count.

With the largest ratio at 1, one rare cell far below its target thins all others. ``covered`` sets the scale so that
cells of this share of the weight have at most probability 1; documents of the others are repeated: all as often as
the whole part says, and once more by the draw. The cells keep their proportions, so targets hold as before.

Targets: shares per margin value, or, where none are given, the actual shares raised to ``alpha``.

Defined cases: null is a margin value of its own; a document without words has weight 0 and the probability of
its cell; a value without a target gets the share 0 and is not kept; cells of weight 0 have probability 0 if
other cells have weight, and 1 if none has; equal ids are drawn alike, so repeated rows stay or go together; a null
id is drawn as an empty text; very long texts are counted whole; an empty table gives an empty result; columns of ``docs`` may have any names not starting with two underscores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import scratch

MARGINS = ("source", "lang", "topic")


def words(text: Column) -> Column:
    """Number of words, the token weight of a document."""
    parts = F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+")
    # Only the first and the last part can be empty.
    first, last = F.get(parts, 0) == "", F.get(parts, F.size(parts) - 1) == ""
    return (F.size(parts) - first.cast("int") - (last & (F.size(parts) > 1)).cast("int")).cast("long")


def topic(text: Column) -> Column:
    """A topic by plain cues of the text."""
    text = F.coalesce(text, F.lit(""))
    return (
        F.when(F.contains(text, F.lit("icense")), "licence")
        .when(F.contains(text, F.lit("@")), "contact")
        .when(text.rlike("[0-9]"), "figures")
        .otherwise("prose")
    )


def rake(cells: DataFrame, margins: dict[str, str], targets: dict[str, dict], alpha: float, sweeps: int) -> DataFrame:
    """cells (margin columns, __n) -> with __w, whose shares by each margin approach the targets.

    ``margins``: column of the cell table -> name used in ``targets``.
    """
    spark = cells.sparkSession
    for column, name in margins.items():
        if name in targets:
            kind = cells.schema[column].dataType
            wanted = spark.createDataFrame(
                [(value, float(share)) for value, share in targets[name].items()], f"__v {kind.simpleString()}, __t double"
            )
        else:
            wanted = cells.groupBy(F.col(column).alias("__v")).agg(F.pow(F.sum("__n").cast("double"), F.lit(alpha)).alias("__t"))
        wanted = wanted.withColumnRenamed("__t", f"__t_{column}")
        cells = (
            cells.join(wanted, F.col(column).eqNullSafe(F.col("__v")), "left")
            .drop("__v")
            .withColumn(f"__t_{column}", F.coalesce(F.col(f"__t_{column}"), F.lit(0.0)))
        )
    cells = scratch.keep(cells.withColumn("__w", F.col("__n").cast("double")), "cells")
    for _ in range(sweeps):
        for column in margins:
            sums = cells.groupBy(F.col(column).alias("__v")).agg(F.sum("__w").alias("__s"))
            cells = scratch.keep(
                cells.join(sums, F.col(column).eqNullSafe(F.col("__v")))
                .drop("__v")
                .withColumn("__w", F.when(F.col("__s") > 0, F.col("__w") * F.col(f"__t_{column}") / F.col("__s")).otherwise(0.0))
                .drop("__s"),
                "cells",
            )
    return cells


def draw(doc_id: Column, seed: str) -> Column:
    """A number in [0, 1) from the id alone: 52 bits of an MD5."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)


def with_probability(
    docs: DataFrame,
    targets: dict[str, dict] | None = None,
    alpha: float = 0.8,
    sweeps: int = 8,
    sent_cells: int = 200_000,
    covered: float | None = None,
) -> DataFrame:
    """docs with __tokens, __probability (with ``covered`` the expected number of copies)."""
    margins = {f"__{name}": name for name in MARGINS}
    named = docs.withColumns(
        {
            "__source": F.col("source"),
            "__lang": F.col("lang"),
            "__topic": topic(F.col("text")),
            "__tokens": words(F.col("text")),
        }
    )
    counted = named.groupBy(*margins).agg(F.sum("__tokens").alias("__n"))
    cells = rake(scratch.keep(counted, "cells"), margins, targets or {}, alpha, sweeps)
    cells = cells.withColumn("__r", F.when(F.col("__n") > 0, F.col("__w") / F.col("__n")).otherwise(0.0))
    size, most = cells.agg(F.count("*"), F.max("__r")).first()
    if covered is not None and most:
        most = cells.agg(F.percentile("__r", covered, F.coalesce("__n", F.lit(0)))).first()[0] or most
    finished = cells.select(
        *[F.col(name).alias(f"{name}_") for name in margins],
        (F.col("__r") / most if most else F.lit(1.0)).alias("__probability"),
    )
    same = [F.col(name).eqNullSafe(F.col(f"{name}_")) for name in margins]
    joined = named.join(F.broadcast(finished) if size <= sent_cells else finished, same)
    return joined.drop(*margins, *[f"{name}_" for name in margins])


def sample(docs: DataFrame, seed: str = "mix", **how) -> DataFrame:
    """The documents that are kept, with their own columns; with ``covered`` some are repeated."""
    rows = with_probability(docs, **how)
    drawn, whole = draw(F.col("doc_id"), seed), F.floor("__probability")
    if how.get("covered") is None:
        rows = rows.where(drawn < F.col("__probability"))
    else:
        copies = (whole + (drawn < F.col("__probability") - whole).cast("long")).cast("int")
        rows = rows.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), copies)))
    return rows.select(*[F.col(f"`{name}`") for name in docs.columns])


def report(docs: DataFrame, seed: str = "mix", **how) -> DataFrame:
    """doc_id, n_tokens, probability (6 places), kept, for every row."""
    rows = with_probability(docs.select("doc_id", "text", "source", "lang"), **how)
    return rows.select(
        "doc_id",
        F.col("__tokens").alias("n_tokens"),
        F.round("__probability", 6).alias("probability"),
        (draw(F.col("doc_id"), seed) < F.col("__probability")).alias("kept"),
    )


def report_sql(seed: str = "mix", alpha: float = 0.8, sweeps: int = 8) -> str:
    """The same report, with the sweeps written out as nested windows."""
    fitted = """SELECT *, pow(sum(n) OVER (PARTITION BY source)::DOUBLE, {a}) AS t_source,
        pow(sum(n) OVER (PARTITION BY lang)::DOUBLE, {a}) AS t_lang,
        pow(sum(n) OVER (PARTITION BY topic)::DOUBLE, {a}) AS t_topic, n::DOUBLE AS w FROM cells""".format(a=alpha)
    for _ in range(sweeps):
        for name in MARGINS:
            share = f"sum(w) OVER (PARTITION BY {name})"
            fitted = f"SELECT * REPLACE (CASE WHEN {share} > 0 THEN w * t_{name} / {share} ELSE 0 END AS w) FROM ({fitted})"
    return rf"""
        WITH named AS (
            SELECT doc_id, source, lang,
                   CASE WHEN contains(coalesce(text, ''), 'icense') THEN 'licence'
                        WHEN contains(coalesce(text, ''), '@') THEN 'contact'
                        WHEN regexp_matches(coalesce(text, ''), '[0-9]') THEN 'figures' ELSE 'prose' END AS topic,
                   len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens
            FROM documents),
        cells AS (SELECT source, lang, topic, sum(n_tokens) AS n FROM named GROUP BY ALL),
        fitted AS ({fitted}),
        ratios AS (SELECT *, CASE WHEN n > 0 THEN w / n ELSE 0 END AS r FROM fitted),
        chances AS (SELECT source, lang, topic, CASE WHEN max(r) OVER () > 0 THEN r / max(r) OVER () ELSE 1 END AS p
                    FROM ratios)
        SELECT doc_id, n_tokens, round(p, 6) AS probability,
               ('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / pow(2, 52) < p AS kept
        FROM named JOIN chances ON named.source IS NOT DISTINCT FROM chances.source
            AND named.lang IS NOT DISTINCT FROM chances.lang AND named.topic = chances.topic"""
