"""Hard negatives by a multiway hyperplane tree with distance ranges (GNAT).

Vectors are rows of integers. A node of the tree has split points; a row goes to the child of the nearest one. For
every child and split point the node stores the range of distances from the point to the rows below the child, and for
every child the range of squared norms. An anchor looks for rows whose inner product with it lies in a window; with
the norms of a child this is an annulus round the anchor, and a child is left out if for any split point the range
that the triangle inequality allows for the annulus misses the stored one. Leaves that are left are compared exactly, so
the result is exact whatever the tree is like.

The split points are fitted on a sample of at most ``SAMPLE`` rows (those of the least hash); every row is then placed
and counts in the ranges. Rows of a leaf are dealt into blocks of about ``BLOCK``, anchors bound for a leaf into
blocks of about ``QUERIES``, and one task compares two blocks by a matrix product. So a leaf with a third of all rows is
many blocks, and nothing is gathered beyond a block; what a task puts out is at most the wanted number per window.

An anchor first visits its own leaf; the worst of the wanted rows found there is its window's lower end for the whole
tree. Positives are found first, then for each positive its window of negatives, likewise in two visits.

Defined cases: rows with a null id, label or vector, or a null or non-finite component take no part; of rows equal in
vec_id the least (label, vector) counts; shorter vectors are followed by zeros (an empty one is all zeros); ties go to the
smaller vec_id; scores are long integers and must fit; a positive of negative score has no window; other columns are
ignored; an empty table, or one without anchors, gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import scratch

#: Rows the split points are fitted on, split points of a node, and sampled rows that are not split further.
SAMPLE, FAN, LEAST = 2048, 8, 48
BLOCK, QUERIES = 1024, 256
_TOP = (1 << 63) - 1


def _distances(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    squares = (rows * rows).sum(axis=1)[:, None] + (points * points).sum(axis=1)[None, :] - 2 * (rows @ points.T)
    return np.sqrt(np.maximum(squares, 0))


class Tree:
    """Split points of all nodes; a child is a node (>= 0) or a leaf (-1 - number)."""

    def __init__(self, sample: np.ndarray):
        self.points: list[np.ndarray] = []
        self.children: list[list[int]] = []
        self.leaves = 0
        self.ranges: list[np.ndarray] = []  # per node: child, point, (least, most) distance
        self.norms: list[np.ndarray] = []  # per node: child, (least, most) squared norm
        if self._split(sample) < 0:
            self.points.append(sample[:1] if len(sample) else np.zeros((1, sample.shape[1])))
            self.children.append([-1])

    def _split(self, rows: np.ndarray) -> int:
        points = rows[:1]
        if len(rows) > LEAST:  # the next point is the row farthest from all before it
            nearest = _distances(rows, points)[:, 0]
            while len(points) < FAN and nearest.max() > 0:
                points = np.vstack([points, rows[np.argmax(nearest)]])
                nearest = np.minimum(nearest, _distances(rows, points[-1:])[:, 0])
        if len(points) < 2:
            self.leaves += 1
            return -self.leaves
        node = len(self.points)
        self.points.append(points)
        self.children.append([])
        at = _distances(rows, points).argmin(axis=1)
        self.children[node] = [self._split(rows[at == child]) for child in range(len(points))]
        return node

    def place(self, rows: np.ndarray, visit=None) -> np.ndarray:
        """The leaf of each row; ``visit(node, child, distances, rows)`` sees what passes."""
        leaf = np.zeros(len(rows), np.int64)
        todo = [(0, np.arange(len(rows)))]
        while todo:
            node, which = todo.pop()
            distances = _distances(rows[which], self.points[node])
            at = distances.argmin(axis=1)
            for child, target in enumerate(self.children[node]):
                below = at == child
                if not below.any():
                    continue
                if visit:
                    visit(node, child, distances[below], rows[which[below]])
                if target < 0:
                    leaf[which[below]] = -1 - target
                else:
                    todo.append((target, which[below]))
        return leaf

    def reach(self, rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) pairs for which a member of the leaf may score between low and high with the row."""
        squares = (rows * rows).sum(axis=1)
        found_rows, found_leaves = [], []
        todo = [(0, np.arange(len(rows)))]
        while todo:
            node, which = todo.pop()
            distances = _distances(rows[which], self.points[node])
            for child, target in enumerate(self.children[node]):
                least, most = self.ranges[node][child].T
                if not least[0] <= most[0]:
                    continue  # no row below
                norms = self.norms[node][child]
                outer = squares[which] + norms[1] - 2 * low[which]
                slack = 1e-6 + 1e-9 * (squares[which] + norms[1] + np.minimum(np.abs(high[which]), 1e18))
                inner = np.maximum(squares[which] + norms[0] - 2 * high[which] - slack, 0)
                far, near = np.sqrt(np.maximum(outer + slack, 0)), np.sqrt(inner)
                margin = 1e-6 * (1 + distances + far[:, None])
                alive = (outer + slack >= 0) & (low[which] <= high[which])
                # From a split point at distance d, rows of the annulus lie between max(d - far, near - d) and d + far.
                alive &= (distances + far[:, None] + margin >= least).all(axis=1)
                alive &= (np.maximum(distances - far[:, None], near[:, None] - distances) - margin <= most).all(axis=1)
                if not alive.any():
                    continue
                if target < 0:
                    found_rows.append(which[alive])
                    found_leaves.append(np.full(int(alive.sum()), -1 - target))
                else:
                    todo.append((target, which[alive]))
        if not found_rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(found_rows), np.concatenate(found_leaves)


def _vectors(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def prepared(rows: DataFrame, label: Column | None = None, scale: float = 256.0) -> DataFrame:
    """vec_id, label, v (integers, all of one length) of the rows that take part, one per vec_id."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    taken = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & sound)
    taken = taken.select(
        F.col("vec_id").cast("long"), (F.col("label") if label is None else label).cast("long").alias("label"), whole.alias("v")
    )
    one = taken.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("one")).select("vec_id", "one.*")
    kept = scratch.keep(one, "vectors")
    dims, low, high = kept.agg(F.max(F.size("v")), F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    dims, reach = max(dims or 1, 1), max(-(low or 0), high or 0)
    # Vectors travel to every leaf they have to visit, so in the narrowest type that holds all of them.
    kind = next(name for name, bits in (("smallint", 15), ("int", 31), ("bigint", 64)) if reach < 1 << bits)
    zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("v"))
    padded = kept.withColumn("v", F.concat("v", zeros).cast(f"array<{kind}>"))
    return padded.withMetadata("v", {"dims": dims, "kind": kind})


class Index:
    """The tree and the blocks of all rows of ``vectors`` (from ``prepared``)."""

    def __init__(self, vectors: DataFrame):
        self.vectors = vectors
        self.dims, self.kind = (vectors.schema["v"].metadata[name] for name in ("dims", "kind"))
        # The sample is of bounded size: SAMPLE rows.
        sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").collect()
        self.tree = Tree(np.array([row.v for row in sample], np.float64).reshape(-1, self.dims))
        self._measure()
        self.blocks = self._packed(vectors)

    def _measure(self) -> None:
        """Ranges over all rows, and the number of rows of each leaf."""
        tree, dims = self.tree, self.dims

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            spans: dict[tuple, list] = {}

            def note(key: tuple, least: float, most: float, n: int) -> None:
                span = spans.setdefault(key, [least, most, 0])
                span[0], span[1], span[2] = min(span[0], least), max(span[1], most), span[2] + n

            def visit(node: int, child: int, distances: np.ndarray, rows: np.ndarray) -> None:
                for point in range(distances.shape[1]):
                    note((node, child, point), distances[:, point].min(), distances[:, point].max(), len(rows))
                squares = (rows * rows).sum(axis=1)
                note((node, child, -1), squares.min(), squares.max(), len(rows))

            for batch in batches:
                if len(batch):
                    tree.place(_vectors(batch.column(0), dims).astype(np.float64), visit)
            if spans:
                columns = list(zip(*[(*key, *span) for key, span in spans.items()], strict=True))
                types = [pa.int64()] * 3 + [pa.float64()] * 2 + [pa.int64()]
                names = ["node", "child", "point", "least", "most", "n"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        spans = self.vectors.select("v").mapInArrow(run, "node long, child long, point long, least double, most double, n long")
        spans = spans.groupBy("node", "child", "point").agg(F.min("least").alias("least"), F.max("most").alias("most"), F.sum("n").alias("n"))
        tree.ranges = [np.tile([np.inf, -np.inf], (len(p), len(p), 1)) for p in tree.points]
        tree.norms = [np.zeros((len(p), 2)) for p in tree.points]
        self.sizes = [0] * max(tree.leaves, 1)
        for row in spans.collect():  # one row per node, child and split point: bounded by the sample
            if row.point >= 0:
                tree.ranges[row.node][row.child, row.point] = row.least, row.most
                continue
            tree.norms[row.node][row.child] = row.least, row.most
            target = tree.children[row.node][row.child]
            if target < 0:
                self.sizes[-1 - target] = row.n

    def _packed(self, vectors: DataFrame) -> DataFrame:
        tree, dims = self.tree, self.dims

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                leaf = tree.place(_vectors(batch.column(2), dims).astype(np.float64))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], ["vec_id", "label", "v", "leaf"])

        placed = vectors.select("vec_id", "label", "v").mapInArrow(run, f"vec_id long, label long, v array<{self.kind}>, leaf long")
        return scratch.keep(_dealt(placed, self.sizes, BLOCK, "vec_id", ["vec_id", "label", "v"], "block"), "blocks")

    def routed(self, queries: DataFrame, everywhere: bool) -> DataFrame:
        """The queries (anchor, label, v, tags, lows, highs) with each leaf they have to visit, or their own leaf only."""
        tree, dims = self.tree, self.dims

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = _vectors(batch.column(2), dims).astype(np.float64)
                if not everywhere:
                    which, leaves = np.arange(len(rows)), tree.place(rows)
                else:
                    # A query's windows are taken together: from the lowest end to the highest.
                    lows, highs = batch.column(4), batch.column(5)
                    at = np.asarray(lows.offsets)[:-1] - np.asarray(lows.offsets)[0]
                    low = np.minimum.reduceat(lows.flatten().to_numpy(), at).astype(np.float64)
                    high = np.maximum.reduceat(highs.flatten().to_numpy(), at).astype(np.float64)
                    which, leaves = tree.reach(rows, low, high)
                out = batch.take(pa.array(which))
                yield pa.RecordBatch.from_arrays([*out.columns, pa.array(leaves)], [*_QUERY, "leaf"])

        schema = f"anchor long, label long, v array<{self.kind}>, tags array<long>, lows array<long>, highs array<long>, leaf long"
        return queries.select(*_QUERY).mapInArrow(run, schema)

    def search(self, queries: DataFrame, same: bool, want: int, everywhere: bool = True) -> DataFrame:
        """anchor, tag, rank, vec_id, score: the ``want`` best rows of the same label, or of others, in each window."""
        routed = scratch.keep(self.routed(queries, everywhere), "routed")
        sizes = [0] * len(self.sizes)
        for row in routed.groupBy("leaf").count().collect():  # one row per leaf
            sizes[row["leaf"]] = row["count"]
        asked = scratch.keep(_dealt(routed, sizes, QUERIES, "anchor", list(_QUERY), "asked"), "asked")
        pairs = asked.select("leaf", "asked").join(self.blocks.select("leaf", "block"), "leaf")
        both = pairs.join(asked.select("leaf", "asked", F.col("rows").alias("queries")), ["leaf", "asked"])
        both = both.join(self.blocks, ["leaf", "block"]).select("queries", "rows")
        dims = self.dims

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(len(batch)):
                    queries, rows = (batch.column(c)[i].values.flatten() for c in (0, 1))
                    found = _best(queries, rows, dims, same, want)
                    if found:
                        columns = [pa.array(column, pa.int64()) for column in zip(*found, strict=True)]
                        yield pa.RecordBatch.from_arrays(columns, ["anchor", "tag", "vec_id", "score"])

        found = both.mapInArrow(run, "anchor long, tag long, vec_id long, score long")
        order = Window.partitionBy("anchor", "tag").orderBy(F.col("score").desc(), "vec_id")
        best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= want)
        return scratch.keep(best, "best")


_QUERY = ("anchor", "label", "v", "tags", "lows", "highs")


def _dealt(rows: DataFrame, sizes: list[int], size: int, key: str, columns: list[str], name: str) -> DataFrame:
    """Rows of a leaf dealt by hash into blocks of about ``size``: leaf, block, rows (sorted)."""
    blocks = F.array(*[F.lit(max(1, -(-n // size))) for n in sizes])
    block = F.pmod(F.xxhash64(key), F.element_at(blocks, (F.col("leaf") + 1).cast("int"))).alias(name)
    return rows.groupBy("leaf", block).agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("rows"))


def _best(queries: list[pa.Array], rows: list[pa.Array], dims: int, same: bool, want: int) -> list[tuple]:
    """The best rows of one block for each window of each query: (anchor, tag, vec_id, score)."""
    anchors, labels = queries[0].to_numpy(), queries[1].to_numpy()
    ids, kinds = rows[0].to_numpy(), rows[1].to_numpy()
    left, right = _vectors(queries[2], dims), _vectors(rows[2], dims)
    left_wide, right_wide = left.astype(np.float64), right.astype(np.float64)
    if np.abs(left_wide).max(initial=0) * np.abs(right_wide).max(initial=0) * dims < 2**53:
        scores = (left_wide @ right_wide.T).astype(np.int64)
    else:
        scores = left.astype(np.int64) @ right.T.astype(np.int64)
    fits = labels[:, None] == kinds[None, :]
    if not same:
        fits = ~fits
    fits &= anchors[:, None] != ids[None, :]
    tags, lows, highs = (column.flatten().to_numpy() for column in queries[3:6])
    ends = np.cumsum([len(x) for x in queries[3].to_pylist()])
    out = []
    for q, end in enumerate(ends):
        start = ends[q - 1] if q else 0
        own = scores[q]
        usable = fits[q] & (own >= lows[start:end].min()) & (own <= highs[start:end].max())
        which = np.flatnonzero(usable)
        if not len(which):
            continue
        which = which[np.lexsort((ids[which], -own[which]))]
        values = own[which]
        for w in range(start, end):
            inside = which[(values >= lows[w]) & (values <= highs[w])][:want]
            out += [(anchors[q], tags[w], ids[x], own[x]) for x in inside]
    return out


def _narrowed(queries: DataFrame, found: DataFrame, want: int) -> DataFrame:
    """Queries whose windows begin at the worst of ``want`` rows found already (one row per anchor and tag)."""
    worst = found.where(F.col("rank") == want).select("anchor", "tag", F.col("score").alias("at_least"))
    return queries.join(worst, ["anchor", "tag"], "left").withColumn("low", F.greatest("low", "at_least")).drop("at_least")


def _gathered(anchors: DataFrame, windows: DataFrame) -> DataFrame:
    """Query rows from anchors (anchor, label, v) and their few windows (anchor, tag, low, high)."""
    lists = windows.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("tag", "low", "high"))).alias("w"))
    return anchors.join(lists, "anchor").select(
        "anchor", "label", "v", F.col("w.tag").alias("tags"), F.col("w.low").alias("lows"), F.col("w.high").alias("highs")
    )


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95
) -> DataFrame:
    """Per anchor and positive the best negatives whose score is ``least`` to ``most`` percent of the positive's.

    Columns: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    """
    index = Index(vectors)
    anchors = scratch.keep(vectors.where(is_anchor).select(F.col("vec_id").alias("anchor"), "label", "v"), "anchors")
    whole = anchors.select("anchor", F.lit(0).cast("long").alias("tag"), F.lit(-_TOP).alias("low"), F.lit(_TOP).alias("high"))
    seen = index.search(_gathered(anchors, whole), True, positives, everywhere=False)
    near = index.search(_gathered(anchors, _narrowed(whole, seen, positives)), True, positives)
    windows = near.select(
        "anchor",
        F.col("vec_id").alias("tag"),
        F.expr(f"-(-{least} * score div 100) + if(-{least} * score % 100 < 0, 1, 0)").alias("low"),
        F.expr(f"{most} * score div 100 - if({most} * score % 100 < 0, 1, 0)").alias("high"),
        F.col("score").alias("positive_score"),
    )
    windows = scratch.keep(windows.where("low <= high"), "windows")
    seen = index.search(_gathered(anchors, windows), False, negatives, everywhere=False)
    found = index.search(_gathered(anchors, _narrowed(windows, seen, negatives)), False, negatives)
    return found.join(windows.select("anchor", "tag", "positive_score"), ["anchor", "tag"]).select(
        F.col("anchor").alias("anchor_id"),
        F.col("tag").alias("positive_id"),
        "rank",
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
