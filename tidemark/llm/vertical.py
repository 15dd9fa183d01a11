"""N-gram Jaccard join by vertical partitioning of the n-gram order.

A document is its set of distinct shingles (``shingle`` consecutive lower-cased words; 64-bit codes, which are also the
global order of the n-grams). Texts of one set are one class. Two classes link where 100 * intersection >=
percent * union; so either has at most (100 - percent)% of its shingles outside the other, and both together at most
(100 - percent) / (100 + percent) of the sum of their sizes.

1. The first quarter of the order is a fragment of its own: its n-grams that occur in one class only cannot be shared,
   and a class with more than (100 - percent)% of its size of them has no partner. Most texts end here, and only a
   quarter of all n-grams has been moved.
2. For the others, n-grams are counted. What one class alone holds is left out, the same bound is applied again, and
   the rarest n-grams of a class, one more than may be outside a partner, are its prefix: linked classes share one.
3. Classes that share prefix n-grams, directly or by way of others, are a group (links from each class to the
   least class of each n-gram, one per prefix n-gram, so no pairs). A group is cut into blocks of at most
   ``members`` classes, ordered by size and by s = (100 + percent) * (n-grams of its own) - (100 - percent) * size. Two
   blocks are compared unless their sizes or s (whose sum is at most 0 for a link) rule out every pair.
4. A pair of blocks is compared in one task, cut vertically: per fragment of the order the overlaps of all its
   segments are counted by one matrix product, and the partial counts are summed per pair; it ends early when no pair
   can still reach the threshold. Only a spanning forest of the links and each class's number of links leave the task,
   so a dense family puts out rows in proportion to its blocks, not to its pairs.

A third of all rows in one group of copies is one class. A third of all rows as different texts of one family costs
comparisons in proportion to the square of its classes, 512 * 512 per product, spread over tasks by pairs of blocks.
A hot n-gram is counted by partial sums and joined by a skewed join. No table of n-grams or links is collected.

Defined cases: null and blank texts have an empty set, are linked with nothing and are their own component; fewer words
than a shingle are one shingle; a null doc_id takes part and is never the smallest unless the component has no other;
rows that agree in doc_id and set have the same result; a text longer than a block is a block of its own; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import components, scratch, texts

#: Codes below this are the first fragment of the order.
_FIRST = np.uint64(1 << 62)
#: N-grams of a block at most, unless one class has more, and columns of one matrix product.
_BLOCK_CODES, _WIDE = 1 << 17, 2048


def _sets(data: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[list[np.ndarray], list[bytes | None]]:
    sets = texts.shingle_sets(data, offsets, shingle)
    return sets, [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.view(np.int64)))


def _fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, text_code, n, key, part (64 bits of the key), first (the codes of the first fragment) per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "text_code", "n", "key", "part", "first"]
        for rows, data, offsets in texts.chunks(batches, 2, 1 << 20):
            sets, keys = _sets(data, offsets, shingle)
            parts = [int.from_bytes(k[:8], "little", signed=True) if k else None for k in keys]
            arrays = [
                rows.column(0),
                rows.column(1),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(keys, pa.binary()),
                pa.array(parts, pa.int64()),
                _lists([s[: np.searchsorted(s, _FIRST)] for s in sets]),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names)

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("text_code"), text.alias("text"))
    schema = "doc_id long, text_code long, n long, key binary, part long, first array<long>"
    return scratch.keep(rows.mapInArrow(run, schema), "fingerprints")


def whole_sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """key, n, codes of the wanted classes, from one text of each."""
    text = F.col("text").cast("string")
    coded = docs.select(F.xxhash64(text).alias("text_code"), text.alias("text"))
    coded = scratch.by_keys(coded, wanted.select("text_code"), ["text_code"], "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()  # copies of a text in one task
        for _, data, offsets in texts.chunks(batches, 0, 1 << 20):
            new = []
            for codes, key in zip(*_sets(data, offsets, shingle), strict=True):
                if key is not None and key not in seen:
                    seen.add(key)
                    new.append((key, codes))
            if new:
                keys = pa.array([key for key, _ in new], pa.binary())
                yield pa.RecordBatch.from_arrays([keys, _lists([codes for _, codes in new])], ["key", "codes"])

    made = coded.select("text").mapInArrow(run, "key binary, codes array<long>")
    return made.groupBy("key").agg(F.first("codes").alias("codes"))


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """id, key, n, own (n-grams of no other class), codes (the others) and prefix, for classes that may have a partner."""
    postings = sets.select("key", F.explode("codes").alias("code"))
    shared = scratch.keep(postings.groupBy("code").agg(F.count("*").alias("df")).where("df > 1"), "shared")
    ordered = postings.join(shared, "code").groupBy("key").agg(F.array_sort(F.collect_list(F.struct("df", "code"))).alias("grams"))
    rows = sets.select("key", F.size("codes").alias("n")).join(ordered, "key").withColumn("own", F.col("n") - F.size("grams"))
    rows = rows.where(100 * F.col("own") <= (100 - percent) * F.col("n"))
    outside = F.floor((100 - percent) * F.col("n") / 100)
    codes = F.transform("grams", lambda gram: gram["code"])
    out = rows.select(
        F.monotonically_increasing_id().alias("id"),
        "key",
        F.col("n").cast("long"),
        F.col("own").cast("long"),
        F.array_sort(codes).alias("codes"),
        F.slice(codes, 1, (outside + 1 - F.col("own")).cast("int")).alias("prefix"),
    )
    return scratch.keep(out, "prefixes")


def _groups(prefixes: DataFrame) -> DataFrame:
    """id, group of the classes that share prefix n-grams with others."""
    grams = prefixes.select("id", F.explode("prefix").alias("code"))
    heads = grams.groupBy("code").agg(F.min("id").alias("head"), F.count("*").alias("k")).where("k > 1")
    links = grams.join(heads, "code").where("id != head").select(F.col("id").alias("a"), F.col("head").alias("b")).distinct()
    labels = components.label(links)
    return labels.select("id", F.col("label").alias("group")).unionByName(
        labels.select(F.col("label").alias("id"), F.col("label").alias("group")).distinct()
    )


def _blocks(members: DataFrame, percent: int, size: int) -> DataFrame:
    """Members of a group packed in order of size level and s: block, group, level, their ranges, and the sets."""
    level = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent))
    s = (100 + percent) * F.col("own") - (100 - percent) * F.col("n")
    rows = members.select("group", level.alias("level"), s.alias("s"), "n", "id", "codes")
    ordered = rows.repartitionByRange("group", "level", "s", "id").sortWithinPartitions("group", "level", "s", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        types = [pa.int64()] * 6 + [pa.list_(pa.int64())] * 3 + [pa.binary()]
        names = ["block", "group", "level", "least_n", "most_n", "least_s", "ids", "ns", "counts", "codes"]
        now: list[tuple] = []
        total = 0

        def packed() -> pa.RecordBatch:
            nonlocal block, total
            groups, levels, scores, ns, ids, codes = zip(*now, strict=True)
            row = [block, groups[0], levels[0], min(ns), max(ns), min(scores), list(ids), list(ns), [len(c) for c in codes]]
            blob = np.concatenate(codes).tobytes()
            now.clear()
            block, total = block + 1, 0
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip([*row, blob], types, strict=True)], names)

        for batch in batches:
            plain = [column.to_pylist() for column in batch.columns[:5]]
            lists = batch.column(5)
            values, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
            for i, row in enumerate(zip(*plain, strict=True)):
                codes = values[offsets[i] : offsets[i + 1]].copy()
                if now and (row[:2] != now[0][:2] or len(now) >= size or total + len(codes) > _BLOCK_CODES):
                    yield packed()
                now.append((*row, codes))
                total += len(codes)
        if now:
            yield packed()

    schema = (
        "block long, group long, level long, least_n long, most_n long, least_s long,"
        " ids array<long>, ns array<long>, counts array<long>, codes binary"
    )
    return scratch.keep(ordered.mapInArrow(run, schema), "blocks")


def _pairs(blocks: DataFrame, percent: int) -> DataFrame:
    """Pairs of blocks of a group, a <= b, that may hold a link."""
    heads = blocks.select("block", "group", "level", "least_n", "most_n", "least_s")
    near = heads.select(
        *[F.col(name).alias(f"b_{name}") for name in ("block", "least_n", "most_n", "least_s")],
        "group",
        F.explode(F.sequence(F.col("level") - 2, F.col("level") + 2)).alias("level"),
    )
    sizes = (100 * F.col("b_most_n") >= percent * F.col("least_n")) & (100 * F.col("most_n") >= percent * F.col("b_least_n"))
    return heads.join(near, ["group", "level"]).where(
        (F.col("block") <= F.col("b_block")) & sizes & (F.col("least_s") + F.col("b_least_s") <= 0)
    ).select(F.col("block").alias("a"), F.col("b_block").alias("b"))


def _matrix(codes: np.ndarray, counts: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each n-gram of a block that is among ``grams`` (sorted), by column."""
    rows = np.repeat(np.arange(len(counts)), counts)
    columns = np.minimum(np.searchsorted(grams, codes), max(len(grams) - 1, 0))
    hit = grams[columns] == codes if len(grams) else np.zeros(len(codes), bool)
    rows, columns = rows[hit], columns[hit]
    order = np.argsort(columns, kind="stable")
    return rows[order], columns[order]


def links_between(a: tuple, b: tuple, same: bool, percent: int) -> np.ndarray:
    """Which members of the two blocks (ns, counts, codes) link: the sum of partial overlaps per pair, by fragments."""
    ns_a, counts_a, codes_a = a
    ns_b, counts_b, codes_b = b
    need = -(-percent * (ns_a[:, None] + ns_b[None, :]) // (100 + percent))  # least overlap of a link
    grams = np.unique(codes_a)
    if same:
        grams = grams[np.diff(np.searchsorted(np.sort(codes_a), np.append(grams, np.iinfo(np.int64).max))) > 1]
    else:
        grams = np.intersect1d(grams, codes_b)
    rows_a, columns_a = _matrix(codes_a, counts_a, grams)
    rows_b, columns_b = _matrix(codes_b, counts_b, grams)
    overlap = np.zeros(need.shape, np.int64)
    left_a, left_b = np.bincount(rows_a, minlength=len(ns_a)), np.bincount(rows_b, minlength=len(ns_b))
    for start in range(0, len(grams), _WIDE):
        width = min(_WIDE, len(grams) - start)
        segments = []
        for rows, columns, n, left in ((rows_a, columns_a, len(ns_a), left_a), (rows_b, columns_b, len(ns_b), left_b)):
            low, high = np.searchsorted(columns, [start, start + width])
            dense = np.zeros((n, width), np.float32)
            dense[rows[low:high], columns[low:high] - start] = 1
            left -= np.bincount(rows[low:high], minlength=n)
            segments.append(dense)
        overlap += (segments[0] @ segments[1].T).astype(np.int64)
        if not (overlap + np.minimum(left_a[:, None], left_b[None, :]) >= need).any():
            break
    linked = overlap >= need
    if same:
        np.fill_diagonal(linked, False)
    return linked


def forest(linked: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per member of both blocks the least id it is connected with by these links."""
    most = np.iinfo(np.int64).max
    lead_a, lead_b = ids_a.copy(), ids_b.copy()
    rows, columns = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
    part = linked[np.ix_(rows, columns)]
    while part.size:
        before = lead_a[rows].sum() + lead_b[columns].sum(), lead_a[rows].min(initial=0)
        lead_a[rows] = np.minimum(lead_a[rows], np.where(part, lead_b[columns][None, :], most).min(axis=1))
        lead_b[columns] = np.minimum(lead_b[columns], np.where(part, lead_a[rows][:, None], most).min(axis=0))
        if before == (lead_a[rows].sum() + lead_b[columns].sum(), lead_a[rows].min(initial=0)):
            break
    return lead_a, lead_b


def _compared(blocks: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """id, lead (a linked class, or itself), links (classes it links with) per member and pair of blocks with links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                sides = []
                for at in (2, 6):
                    ids, ns, counts = (x.values.to_numpy() for x in row[at : at + 3])
                    sides.append((ids, (ns, counts, np.frombuffer(row[at + 3].as_buffer(), np.int64))))
                same = row[0].as_py() == row[1].as_py()
                linked = links_between(sides[0][1], sides[1][1], same, percent)
                if not linked.any():
                    continue
                ids_a, ids_b = sides[0][0], sides[1][0]
                if same:
                    lead, links = forest(linked, ids_a, ids_a), linked.sum(axis=1)
                    ids, lead = ids_a, np.minimum(*lead)
                else:
                    ids, lead = np.concatenate([ids_a, ids_b]), np.concatenate(forest(linked, ids_a, ids_b))
                    links = np.concatenate([linked.sum(axis=1), linked.sum(axis=0)])
                some = links > 0
                yield pa.RecordBatch.from_arrays([pa.array(x[some]) for x in (ids, lead, links)], ["id", "lead", "links"])

    def side(name: str) -> DataFrame:
        return blocks.select(F.col("block").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in ("ids", "ns", "counts", "codes")])

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    columns = ["a", "b", *[f"{x}_{c}" for x in "ab" for c in ("ids", "ns", "counts", "codes")]]
    return scratch.keep(both.select(*columns).mapInArrow(run, "id long, lead long, links long"), "links")


def linked_within(sets: DataFrame, grouped: DataFrame, percent: int, members: int = 512) -> DataFrame:
    """key, label, n_links of the classes of ``sets`` (key, codes) that link with another of their group (key, group)."""
    prefixes = _prefixes(sets, percent)
    return _linked(prefixes, prefixes.join(grouped, "key"), percent, members)


def _linked(prefixes: DataFrame, grouped: DataFrame, percent: int, members: int) -> DataFrame:
    blocks = _blocks(grouped, percent, members)
    pairs = scratch.keep(_pairs(blocks, percent), "pairs")
    links = _compared(blocks, pairs, percent)
    labels = components.label(links, "id", "lead")
    counts = links.groupBy("id").agg(F.sum("links").alias("n_links"))
    linked = prefixes.select("id", "key").join(counts, "id").join(labels, "id", "left")
    return scratch.keep(linked.select("key", F.coalesce("label", "id").alias("label"), "n_links"), "linked")


def components_of(docs: DataFrame, shingle: int = 3, percent: int = 90, members: int = 512) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links (different sets that the row's set links with) of every row."""
    rows = _fingerprints(docs, shingle)
    classes = rows.where("n > 0").groupBy("key", "part", "n").agg(
        F.min("doc_id").alias("least_id"), F.min("text_code").alias("text_code")
    )
    classes = scratch.keep(classes, "classes")
    alone = (
        rows.where("n > 0").select("part", F.explode("first").alias("code"))
        .groupBy("code").agg(F.min("part").alias("part"), F.max("part").alias("other"))
        .where("part = other").groupBy("part").agg(F.count("*").alias("own"))
    )
    may = classes.where((100 - percent) * F.col("n") >= percent).join(alone, "part", "left")
    may = may.where(100 * F.coalesce("own", F.lit(0)) <= (100 - percent) * F.col("n"))
    wanted = scratch.keep(may.select("key", "text_code"), "wanted")
    # A text of several rows may be wanted for one class only, so other sets of these texts are not made.
    sets = scratch.keep(whole_sets(docs, wanted, shingle), "sets")
    prefixes = _prefixes(sets, percent)
    grouped = scratch.keep(_groups(prefixes), "grouped")
    linked = _linked(prefixes, prefixes.join(grouped, "id"), percent, members).join(classes.select("key", "least_id"), "key")
    least = linked.groupBy("label").agg(F.min("least_id").alias("component_id"))
    found = linked.join(least, "label").select("key", "component_id", "n_links")
    of_class = scratch.keep(classes.select("key", "least_id").join(found, "key", "left"), "components")
    component = F.coalesce("component_id", "least_id").alias("component_id")
    full = rows.where("n > 0").select("doc_id", "n", "key").join(of_class, "key").select(
        "doc_id", F.col("n").alias("n_shingles"), component, F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")
    )
    empty = rows.where("n = 0").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links")
    )
    return full.unionByName(empty)
