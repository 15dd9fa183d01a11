"""Near-duplicates by a chosen-path similarity join.

A document is its set of distinct shingles (``shingle`` consecutive lower-cased words). Texts of one set are one
class; classes are linked where the sets' Jaccard similarity reaches ``percent`` (compared in integers).

Every class has ``POSITIONS`` minwise values, kept as bytes for branching and comparing. Each tree starts with one
position, and classes with one value there are a node. A node of more than ``small`` classes picks two positions, and
its classes branch by their values at each; one whose branches together keep ``_DENSE`` of its pairs, as in a dense family,
is not branched. So a pair that agrees in a share f of the positions is lost by a tree with at most (1 - f) / f, at any
depth: below a first node the chance e of being lost is the least root of e = (1 - f + f e)^2. Trees are independent;
all nodes are followed in all of them.

Nodes at the end are compared exhaustively in tasks, as blocks of at most ``_MEMBERS`` classes: which pairs agree in at
least ``_AGREE`` positions (expected at the threshold less five deviations) and have near enough sizes. Only a
spanning forest of these pairs leaves the task. Classes it connects are a group, and in a group all classes are
compared by their complete sets, again in blocks (see ``vertical``), so no link within a group is lost, and a dense
family whose members are alike but mostly below the threshold puts out no more rows than it has members and blocks.

Defined cases: null and blank texts have an empty set and are linked with nothing; fewer words than a shingle
are one shingle; a null doc_id takes part and is never the smallest unless the component has no other; rows that
agree in doc_id and set have the same result; a text longer than a block is a block of its own; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import random
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import components, scratch, texts, vertical

POSITIONS = 128
_FACTORS = np.random.Generator(np.random.PCG64(4)).integers(0, 1 << 63, POSITIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Positions in which a candidate pair agrees at least, for a threshold of 75%: 96 are expected there.
_AGREE = 72
#: Classes of a block that one task compares with those of another.
_MEMBERS = 512
#: A node whose branches keep at least this share of its pairs is compared as it is.
_DENSE = 0.9


def _key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def first_positions(trees: int) -> list[int]:
    """The position that each tree starts with; all different while there are enough."""
    order = random.Random(7).sample(range(POSITIONS), POSITIONS)
    return [order[tree % POSITIONS] for tree in range(trees)]


def sketches(docs: DataFrame, shingle: int, trees: int) -> DataFrame:
    """doc_id, text_code, n, key, roots (first node of each tree), sketch per row; key is null for empty sets."""
    firsts = first_positions(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "text_code", "n", "key", "roots", "sketch"]
        for rows, data, offsets in texts.chunks(batches, 2, 1 << 20):
            sets = texts.shingle_sets(data, offsets, shingle)
            sizes = np.array([len(s) for s in sets], np.int64)
            some = sizes > 0
            values = np.zeros((len(sets), POSITIONS), np.uint64)
            if some.any():
                together = np.concatenate(sets)
                heads = (np.cumsum(sizes) - sizes)[some]
                for i, factor in enumerate(_FACTORS):
                    values[some, i] = np.minimum.reduceat(together * factor, heads)
            mixed = texts.mixed(values)
            roots = texts.mixed(mixed[:, firsts] + np.arange(trees, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            sketch = np.ascontiguousarray((mixed >> np.uint64(56)).astype(np.uint8))
            arrays = [
                rows.column(0),
                rows.column(1),
                pa.array(sizes),
                pa.array([_key(s) if len(s) else None for s in sets], pa.binary()),
                pa.ListArray.from_arrays(
                    pa.array(np.arange(0, roots.size + 1, trees), pa.int32()), pa.array(roots.ravel().view(np.int64))
                ),
                pa.array([row.tobytes() for row in sketch], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names)

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("text_code"), text.alias("text"))
    schema = "doc_id long, text_code long, n long, key binary, roots array<long>, sketch binary"
    return scratch.keep(rows.mapInArrow(run, schema), "sketches")


def _leaves(classes: DataFrame, small: int) -> DataFrame:
    """node, size, id of all nodes at the ends of the trees that have two classes or more."""
    rows = classes.select(F.explode("roots").alias("node"), "id")
    sizes = rows.groupBy("node").agg(F.count("*").alias("size")).where("size > 1")
    live = scratch.keep(rows.join(sizes, "node").select("node", "size", "id"), "live")
    sketch = classes.select("id", "sketch")
    first, second = (F.xxhash64("node", F.lit(i)) for i in (0, 1))
    first = F.pmod(first, F.lit(POSITIONS)).cast("int")
    second = F.pmod(first + 1 + F.pmod(second, F.lit(POSITIONS - 1)), F.lit(POSITIONS)).cast("int")  # another one
    picked = [F.xxhash64("node", at, F.expr("sketch").substr(at + 1, F.lit(1))) for at in (first, second)]
    ends = []
    while True:
        ends.append(live.where(F.col("size") <= small))
        large = live.where(F.col("size") > small)
        left = large.count()
        if not left:
            return reduce(DataFrame.unionByName, ends)
        parts = 1 + left // 200_000  # no more files than the rows need
        picks = large.join(sketch, "id").select("node", "size", "id", *[p.alias(f"to_{i}") for i, p in enumerate(picked)])
        picks = scratch.keep(picks, "picks", parts)
        # Branches are counted per position, and rows are put out only for the nodes that branch.
        sums = [picks.groupBy("node", "size", F.col(f"to_{i}").alias("branch")).agg(F.count("*").alias("c")) for i in (0, 1)]
        counts = scratch.keep(reduce(DataFrame.unionByName, sums), "counts", parts)
        after = counts.groupBy("node", "size").agg(F.sum(F.col("c") * F.col("c")).alias("after"))
        dense = after.where(F.col("after") >= _DENSE * F.col("size") * F.col("size")).select("node")
        ends.append(large.join(dense, "node", "left_semi"))
        on = counts.where("c > 1").join(dense, "node", "left_anti").select("branch", F.col("c").alias("now"))
        branching = picks.join(dense, "node", "left_anti")
        live = branching.select("id", F.explode(F.array("to_0", "to_1")).alias("branch")).join(on, "branch")
        live = scratch.keep(live.select(F.col("branch").alias("node"), F.col("now").alias("size"), "id"), "live", parts)


def _agreeing(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which pairs of sketches agree in enough positions."""
    out = np.zeros((len(left), len(right)), bool)
    for start in range(0, len(left), 64):
        part = left[start : start + 64]
        out[start : start + 64] = (part[:, None, :] == right[None, :, :]).sum(axis=2, dtype=np.int16) >= _AGREE
    return out


def _near(nodes: DataFrame, names: list[str]) -> DataFrame:
    """id, lead: a spanning forest of the near pairs within one list of members, or between two."""

    def members(values: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids, ns, sketch = values.flatten()
        return ids.to_numpy(), ns.to_numpy(), np.frombuffer(b"".join(sketch.to_pylist()), np.uint8).reshape(-1, POSITIONS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found_ids, found_leads = [], []
            for row in range(len(batch)):
                sides = [members(batch.column(i)[row].values) for i in range(len(names))]
                (ids, ns, left), (others, ms, right) = sides[0], sides[-1]
                low, high = np.minimum(ns[:, None], ms[None, :]), np.maximum(ns[:, None], ms[None, :])
                linked = _agreeing(left, right) & (4 * low >= 3 * high)
                leads = vertical.forest(linked, ids, others)
                for own, lead in zip((ids, others), leads, strict=True):
                    moved = own != lead
                    found_ids.append(own[moved])
                    found_leads.append(lead[moved])
            if found_ids:
                columns = [pa.array(np.concatenate(x)) for x in (found_ids, found_leads)]
                yield pa.RecordBatch.from_arrays(columns, ["id", "lead"])

    return nodes.select(*names).mapInArrow(run, "id long, lead long")


def _groups(classes: DataFrame, small: int) -> DataFrame:
    """id, group of the classes that near pairs connect."""
    leaves = _leaves(classes, small).join(classes.select("id", "n", "sketch"), "id")
    member = F.struct("id", "n", "sketch")
    whole = leaves.where(F.col("size") <= _MEMBERS).groupBy("node").agg(F.collect_list(member).alias("one"))
    near = scratch.keep(_near(whole, ["one"]), "near")
    chunk = F.pmod(F.xxhash64("id"), F.ceil(F.col("size") / _MEMBERS)).alias("chunk")
    blocks = leaves.where(F.col("size") > _MEMBERS).groupBy("node", chunk).agg(F.collect_list(member).alias("one"))
    blocks = scratch.keep(blocks, "chunks")
    heads = blocks.select("node", "chunk")
    pairs = heads.join(heads.select("node", F.col("chunk").alias("to")), "node").where("chunk <= to")
    both = pairs.join(blocks.select("node", F.col("chunk").alias("to"), F.col("one").alias("other")), ["node", "to"])
    far = scratch.keep(_near(both.join(blocks, ["node", "chunk"]), ["one", "other"]), "far")
    labels = scratch.keep(components.label(near.unionByName(far), "id", "lead"), "groups")
    return labels.select("id", F.col("label").alias("group")).unionByName(
        labels.select(F.col("label").alias("id"), F.col("label").alias("group")).distinct()
    )


def groups(docs: DataFrame, shingle: int = 5, trees: int = 20, small: int = 512, percent: int = 75) -> DataFrame:
    """doc_id, text_code, n_shingles, component_id, component of every row; component is null for empty sets."""
    if percent < 75:
        raise ValueError("sketches are compared for similarities of 75% or more")
    rows = sketches(docs, shingle, trees)
    heads = rows.where("n > 0").groupBy("key").agg(
        F.min("doc_id").alias("least_id"), F.min(F.struct("text_code", "n", "roots", "sketch")).alias("one")
    )
    classes = scratch.keep(
        heads.select("key", "least_id", "one.*").withColumn("id", F.monotonically_increasing_id()), "classes"
    )
    grouped = classes.select("id", "key", "text_code").join(_groups(classes, small), "id")
    grouped = scratch.keep(grouped.select("key", "text_code", "group"), "grouped")
    sets = scratch.keep(vertical.whole_sets(docs, grouped.select("text_code").distinct(), shingle), "sets")
    linked = vertical.linked_within(sets, grouped.select("key", "group"), percent)
    named = scratch.keep(classes.select("id", "key", "least_id").join(linked.select("key", "label"), "key"), "named")
    least = named.groupBy("label").agg(F.min("least_id").alias("component_id"), F.min("id").alias("component"))
    moved = named.join(least, "label").select("key", F.col("component_id").alias("to_id"), F.col("component").alias("to"))
    component = classes.select("key", "id", "least_id").join(moved, "key", "left").select(
        "key",
        F.when(F.col("to").isNull(), F.col("least_id")).otherwise(F.col("to_id")).alias("component_id"),
        F.coalesce("to", "id").alias("component"),
    )
    component = scratch.keep(component, "components")
    columns = ["doc_id", "text_code", F.col("n").alias("n_shingles"), "component_id", "component"]
    full = rows.where("n > 0").join(component, "key").select(*columns)
    empty = rows.where("n = 0").withColumns({"component_id": F.col("doc_id"), "component": F.lit(None).cast("long")}).select(*columns)
    return full.unionByName(empty)


def report(docs: DataFrame, **how) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row."""
    return groups(docs, **how).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def deduplicated(docs: DataFrame, **how) -> DataFrame:
    """One row of each group, that with the smallest doc_id (nulls last), with its own columns.

    Rows without words are no copies of anything, but of rows equal in doc_id and text one stays.
    """
    names = ["absent", "i", "c"]

    def keyed(rows: DataFrame, code: Column, *more: Column) -> DataFrame:
        own = F.col("doc_id").cast("long")
        return rows.select(*more, own.isNull().alias("absent"), F.coalesce(own, F.lit(0)).alias("i"), code.alias("c"))

    found = scratch.keep(keyed(groups(docs, **how), F.col("text_code"), F.col("component")), "groups")
    stay = scratch.keep(found.where("component IS NOT NULL").groupBy("component").agg(F.min(F.struct(*names)).alias("stay")), "stay")
    dropped = found.join(stay, "component").where(F.struct(*names) != F.col("stay")).select(*names).distinct()
    repeated = scratch.keep(found.groupBy(*names).count().where("count > 1").select(*names), "repeated")
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row")
    out = keyed(docs, F.xxhash64(F.col("text").cast("string")), row)
    out = scratch.by_keys(out, scratch.keep(dropped, "dropped"), names, "left_anti")
    if not repeated.isEmpty():
        once = scratch.by_keys(out, repeated, names, "left_semi").dropDuplicates(names)
        out = scratch.by_keys(out, repeated, names, "left_anti").unionByName(once)
    return out.select("row.*")
