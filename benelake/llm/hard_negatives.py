"""Hard negatives for contrastive training, by an exact search in a multiway
hyperplane tree over all rows.

Vectors are whole numbers (a scale times each component, rounded down), scores
their inner products. With one more component, sqrt(M^2 - |x|^2) for the
largest norm M, all rows x have the same norm, so the Euclidean distance to a
query (whose extra component is 0) falls as the score rises, and a window of
scores is an annulus of distances.

A node of the tree has up to ``FANOUT`` split points; a row goes to the nearest.
The points are fitted on a bounded sample, but every row is indexed, and each
split point stores the range of its distances to all rows below each sibling.
A sibling is left out for a query where, by the triangle inequality, some split
point's range to it does not meet the query's annulus. What is left are leaves,
in which all scores are computed exactly. Leaves are dealt out in blocks of
rows and batches of queries, so a leaf that holds a third of all rows, or that
all queries visit, is spread over many tasks.

Rows of equal vector and label are one entry with its least ids: no result
lists more of them, so no result is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from benelake.llm.tables import written

FANOUT = 16
#: Split points are fitted on about so many entries, at most twice as many.
SAMPLE = 20_000
#: Entries of a leaf that the depth of the tree aims at.
LEAF = 4_096
#: Entries of a leaf, and queries, that one task compares.
BLOCK_ROWS = 8_192
BATCH = 4_096

_LEAST, _MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
_QUERY = "anchor long, anchor_id long, label long, vector array<int>, low array<long>, high array<long>"


def _matrix(lists: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of a list column as int64, shorter ones padded with zeros."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
        lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
    out = np.zeros((len(lists), width), np.int64)
    sizes = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(lists)), sizes)
    out[rows, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact where they fit in a long."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2.0**52:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


class Tree:
    """Split points of a complete tree: node 0 is the root, child j of node k
    is ``k * fanout + 1 + j``, the last level are leaves."""

    def __init__(self, sample: np.ndarray, square: float, depth: int):
        self.depth, self.square, self.fanout = depth, square, FANOUT
        self.nodes = sum(self.fanout**i for i in range(depth))
        self.points = np.zeros((self.nodes, self.fanout, sample.shape[1]))
        self.extra = np.zeros((self.nodes, self.fanout))
        self.there = np.zeros((self.nodes, self.fanout), bool)
        self.low = np.full((self.nodes, self.fanout, self.fanout), np.inf)
        self.high = np.full((self.nodes, self.fanout, self.fanout), -np.inf)
        members = {0: sample.astype(np.float64)}
        for node in range(self.nodes):
            own = members.pop(node, sample[:0])
            if not len(own):  # no sample below: all rows go on to the first child
                own = self.points[(node - 1) // self.fanout, (node - 1) % self.fanout][None, :] if node else np.zeros((1, sample.shape[1]))
            chosen = self._spread(own)
            self.points[node, : len(chosen)] = chosen
            self.extra[node, : len(chosen)] = self._extra(chosen)
            self.there[node, : len(chosen)] = True
            nearest = self._distances(own, self._extra(own), node).argmin(axis=1)
            for j in range(len(chosen)):
                members[node * self.fanout + 1 + j] = own[nearest == j]

    def _extra(self, rows: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.square - np.square(rows.astype(np.float64)).sum(axis=1), 0))

    def _spread(self, rows: np.ndarray) -> np.ndarray:
        """Points far from each other: of some candidates, always the one that
        is farthest from those chosen."""
        some = np.unique(rows[np.linspace(0, len(rows) - 1, min(len(rows), 8 * self.fanout)).astype(int)], axis=0)
        extra = self._extra(some)
        gap = np.full(len(some), np.inf)
        chosen = [0]
        while len(chosen) < min(self.fanout, len(some)):
            i = chosen[-1]
            gap = np.minimum(gap, 2 * self.square - 2 * (some @ some[i] + extra * extra[i]))
            gap[chosen] = -np.inf
            chosen.append(int(gap.argmax()))
        return some[chosen]

    def _distances(self, rows: np.ndarray, extra: np.ndarray, node: int) -> np.ndarray:
        """Of rows (or, with no extra component, queries) to a node's points."""
        own = np.square(rows).sum(axis=1) + np.square(extra)
        square = own[:, None] + self.square - 2 * (rows @ self.points[node].T + extra[:, None] * self.extra[node])
        return np.where(self.there[node], np.sqrt(np.maximum(square, 0)), np.inf)

    def leaves(self, rows: np.ndarray, query: bool = False, ranges: bool = False) -> np.ndarray:
        """The leaf of each row; with ``ranges`` the rows widen the stored ranges."""
        rows = rows.astype(np.float64)
        extra = np.zeros(len(rows)) if query else self._extra(rows)
        at = np.zeros(len(rows), np.int64)
        for _ in range(self.depth):
            for node in np.unique(at).tolist():
                own = np.flatnonzero(at == node)
                found = self._distances(rows[own], extra[own], node)
                child = found.argmin(axis=1)
                at[own] = node * self.fanout + 1 + child
                if ranges:
                    for j in np.unique(child).tolist():
                        part = found[child == j]
                        self.low[node, :, j] = np.minimum(self.low[node, :, j], part.min(axis=0))
                        self.high[node, :, j] = np.maximum(self.high[node, :, j], part.max(axis=0))
        return at - self.nodes

    def visits(self, queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, leaf) of all leaves that may hold a score in one of the
        query's windows from ``low`` to ``high`` (queries x windows)."""
        queries = queries.astype(np.float64)
        own = np.square(queries).sum(axis=1)[:, None] + self.square
        near, far = (np.sqrt(np.maximum(own - 2 * x.astype(np.float64), 0)) for x in (high, low))
        slack = 1e-6 * np.sqrt(own) + 1e-9  # rounding must not leave out a leaf
        some = low <= high
        front = [(0, np.flatnonzero(some.any(axis=1)))]
        for _ in range(self.depth):
            below = []
            for node, who in front:
                alive = np.zeros((len(who), self.fanout), bool)
                d = self._distances(queries[who], np.zeros(len(who)), node)
                for w in range(low.shape[1]):
                    r1, r2, e = near[who, w, None], far[who, w, None], slack[who]
                    least, most = np.maximum(d - r2, r1 - d) - e, d + r2 + e
                    meets = (self.high[node] >= least[:, :, None]) & (self.low[node] <= most[:, :, None])
                    alive |= meets[:, self.there[node]].all(axis=1) & some[who, w, None]
                alive &= np.isfinite(self.low[node][self.there[node]]).all(axis=0)  # no rows, no visit
                below += [(node * self.fanout + 1 + j, who[alive[:, j]]) for j in range(self.fanout) if alive[:, j].any()]
            front = below
        if not front:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([who for _, who in front]), np.concatenate([np.full(len(who), node - self.nodes) for node, who in front])


def _entries(rows: DataFrame, most: int) -> DataFrame:
    """(label, vector, ids): the ``most`` least ids of each label and vector."""
    order = Window.partitionBy("vector", "label").orderBy("id")
    least = rows.distinct().withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)
    return least.groupBy("vector", "label").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def build_index(entries: DataFrame) -> tuple[DataFrame, Tree, int]:
    """The entries with their leaf, written; the tree with its ranges; the
    length of the longest vector."""
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    n, width, most = entries.agg(F.count("*"), F.max(F.size("vector")), F.max(square)).first()
    width = max(1, width or 0)
    depth = 1
    while FANOUT**depth * LEAF < n and FANOUT ** (depth + 1) <= SAMPLE:
        depth += 1
    share = int(min(1.0, SAMPLE / max(1, n)) * (1 << 30))
    sample = entries.where(F.pmod(F.xxhash64("vector"), F.lit(1 << 30)) < share).select("vector").limit(2 * SAMPLE).toArrow()
    rows = _matrix(sample["vector"], width)
    tree = Tree(rows[np.lexsort(rows.T)], most or 0.0, depth)

    def assign(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            leaf = tree.leaves(_matrix(batch.column(0), width))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int64())], names=["vector", "label", "ids", "leaf"])

    def widen(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            tree.leaves(_matrix(batch.column(0), width), ranges=True)
        found = np.nonzero(np.isfinite(tree.low))
        kinds = [pa.array(x, pa.int32()) for x in found] + [pa.array(tree.low[found]), pa.array(tree.high[found])]
        yield pa.RecordBatch.from_arrays(kinds, names=["node", "point", "child", "low", "high"])
        tree.low.fill(np.inf)
        tree.high.fill(-np.inf)

    index = written(entries.select("vector", "label", "ids").mapInArrow(assign, "vector array<int>, label long, ids array<long>, leaf long"))
    # at most FANOUT ** 2 rows a node, and the sample bounds the nodes
    ranges = index.select("vector").mapInArrow(widen, "node int, point int, child int, low double, high double")
    ranges = ranges.groupBy("node", "point", "child").agg(F.min("low"), F.max("high")).toArrow()
    node, point, child, low, high = (ranges.column(i).to_numpy() for i in range(5))
    tree.low[node, point, child], tree.high[node, point, child] = low, high
    return index, tree, width


def _search(index: DataFrame, tree: Tree, width: int, queries: DataFrame, compare, own_leaf: bool = False) -> DataFrame:
    """(anchor, which, score, id): what ``compare`` finds for the queries in
    each block of each leaf that they visit, ``own_leaf``: only the nearest."""

    def route(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for a in range(0, batch.num_rows, BATCH):
                part = batch.slice(a, BATCH)
                vectors = _matrix(part.column(3), width)
                if own_leaf:
                    who, leaf = np.arange(len(vectors)), tree.leaves(vectors, query=True)
                else:
                    who, leaf = tree.visits(vectors, _windows(part.column(4), _MOST), _windows(part.column(5), _LEAST))
                if len(who):
                    yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int64()), *part.take(pa.array(who)).columns], names=["leaf", *part.schema.names])

    routed = written(queries.mapInArrow(route, f"leaf long, {_QUERY}"))
    size = index.groupBy("leaf").agg(F.count("*").alias("rows")).join(routed.groupBy("leaf").agg(F.count("*").alias("visits")), "leaf")
    blocks = size.select("leaf", F.ceil(F.col("rows") / BLOCK_ROWS).alias("blocks"), F.ceil(F.col("visits") / BATCH).alias("batches"))
    blocks = F.broadcast(blocks)  # a row a leaf at most, and the sample bounds the leaves
    one = lambda n, *by: F.pmod(F.xxhash64(*by), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = index.join(blocks, "leaf").withColumn("block", one("blocks", "vector", "label")).withColumn("batch", every("batches"))
    right = routed.join(blocks, "leaf").withColumn("batch", one("batches", "anchor")).withColumn("block", every("blocks"))

    def block(key, rows, asked):
        if not rows.num_rows or not asked.num_rows:
            return pa.table({"anchor": pa.array([], pa.int64()), "which": pa.array([], pa.int32()), "score": pa.array([], pa.int64()), "id": pa.array([], pa.int64())})
        return compare(_Rows(rows, width), asked, width)

    keys = ["leaf", "block", "batch"]
    left, right = left.drop("blocks", "batches"), right.drop("blocks", "batches")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(block, "anchor long, which int, score long, id long")


def _windows(column, fill: int) -> np.ndarray:
    """Bounds of each query, filled up to a common number: queries x windows."""
    values = column.to_pylist()
    out = np.full((len(values), max(map(len, values), default=0)), fill)
    for i, x in enumerate(values):
        out[i, : len(x)] = x
    return out


class _Rows:
    """Entries of a block in order of their labels."""

    def __init__(self, rows: pa.Table, width: int):
        rows = rows.sort_by("label")
        self.labels = rows["label"].to_numpy()
        self.vectors = _matrix(rows["vector"], width)
        lists = rows["ids"].combine_chunks()
        lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
        self.ids, self.n_ids = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
        self.at = np.cumsum(self.n_ids) - self.n_ids

    def best(self, anchor, anchor_id, which, who, row, score, most) -> pa.Table:
        """Of candidate entries ``row`` for the queries ``who``: their ids other
        than the anchor's, the ``most`` with the highest scores, least ids first."""
        times = self.n_ids[row]
        who, score = np.repeat(who, times), np.repeat(score, times)
        ids = self.ids[np.repeat(self.at[row] - (np.cumsum(times) - times), times) + np.arange(times.sum())]
        other = ids != anchor_id[who]
        who, score, ids = who[other], score[other], ids[other]
        order = np.lexsort((ids, -score, who))
        who, score, ids = who[order], score[order], ids[order]
        first = np.searchsorted(who, who)
        kept = np.arange(len(who)) - first < most
        who, score, ids = who[kept], score[kept], ids[kept]
        return pa.table({"anchor": anchor[who], "which": which[who].astype(np.int32), "score": score, "id": ids})


def _top(found: np.ndarray, fits: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, entry) of the ``most`` highest scores that fit, ties included."""
    held = np.where(fits, found, _LEAST)
    k = min(most, held.shape[1])
    least = np.partition(held, held.shape[1] - k, axis=1)[:, held.shape[1] - k]
    return np.nonzero(fits & (held >= least[:, None]))


def _same_label(most: int):
    """The ``most`` best entries of the anchor's label."""

    def compare(rows: _Rows, asked: pa.Table, width: int) -> pa.Table:
        anchor, anchor_id, label = (asked[c].to_numpy() for c in ("anchor", "anchor_id", "label"))
        vectors, low = _matrix(asked["vector"], width), _windows(asked["low"], _LEAST)[:, 0]
        alone = rows.n_ids == 1
        found = []
        for x in np.unique(label).tolist():
            a, b = np.searchsorted(rows.labels, (x, x + 1))
            for part in _parts(np.flatnonzero(label == x), b - a):
                score = scores(vectors[part], rows.vectors[a:b])
                itself = alone[a:b] & (rows.ids[rows.at[a:b]] == anchor_id[part][:, None])
                who, row = _top(score, (score >= low[part][:, None]) & ~itself, most)
                found.append((part[who], row + a, score[who, row]))
        return rows.best(anchor, anchor_id, np.zeros(len(anchor)), *_joined(found), most)

    return compare


def _other_label(most: int):
    """The ``most`` best entries of other labels in each window of an anchor."""

    def compare(rows: _Rows, asked: pa.Table, width: int) -> pa.Table:
        anchor, anchor_id, label = (asked[c].to_numpy() for c in ("anchor", "anchor_id", "label"))
        vectors, low, high = _matrix(asked["vector"], width), _windows(asked["low"], _MOST), _windows(asked["high"], _LEAST)
        count = np.array([len(x) for x in asked["low"].to_pylist()])
        of = np.repeat(np.arange(len(anchor)), count)  # a query for each window
        which = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
        found = []
        for part in _parts(np.arange(len(of)), len(rows.labels)):
            queries, back = np.unique(of[part], return_inverse=True)
            score = scores(vectors[queries], rows.vectors)[back]
            who = of[part]
            fits = (rows.labels != label[who][:, None]) & (score >= low[who, which[part]][:, None]) & (score <= high[who, which[part]][:, None])
            q, row = _top(score, fits, most)
            found.append((part[q], row, score[q, row]))
        return rows.best(anchor[of], anchor_id[of], which, *_joined(found), most)

    return compare


def _joined(found: list[tuple[np.ndarray, ...]]) -> list[np.ndarray]:
    return [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 3


def _parts(who: np.ndarray, rows: int, most: int = 2_000_000) -> Iterator[np.ndarray]:
    """Queries of which ``most`` scores are held at a time."""
    step = max(1, most // max(1, rows))
    if rows:
        for a in range(0, len(who), step):
            yield who[a : a + step]


def _ranked(found: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("anchor", "which").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def mine_hard_negatives(df: DataFrame, id_column: str, label: Column, vector: str, is_anchor: Column, positives: int = 5, negatives: int = 5, least_percent: int = 80, scale: int = 256) -> DataFrame:
    """For each anchor (``is_anchor``) its ``positives`` best other rows of the
    same label, and for each of those the ``negatives`` best rows of another
    label whose score is at least ``least_percent`` percent of the positive's
    and at most the positive's. Returns anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score; ties go to the smaller id.

    Rows without id, label or vector, or with a null or non-finite component
    (or one beyond an int when scaled), take no part. A vector is as if padded
    with zeros to the longest. Rows equal in id, label and vector count once;
    another row of the anchor's id isn't another row. No anchors: no rows."""
    x = F.col(f"`{vector}`")
    odd = lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double") * scale) >= float(1 << 31))
    rows = df.where(F.col(f"`{id_column}`").isNotNull() & label.isNotNull() & x.isNotNull() & ~F.exists(x, odd))
    scaled = F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("int"))
    rows = rows.select(F.col(f"`{id_column}`").cast("long").alias("id"), label.cast("long").alias("label"), scaled.alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"))
    entries = written(_entries(rows.drop("is_anchor"), max(positives + 1, negatives)))
    index, tree, width = build_index(entries)
    anchors = rows.where("is_anchor").select("id", "label", "vector").distinct()
    anchors = written(anchors.select(F.monotonically_increasing_id().alias("anchor"), F.col("id").alias("anchor_id"), "label", "vector"))

    def asked(low: Column, high: Column) -> list[Column]:
        return [F.col(c) for c in ("anchor", "anchor_id", "label", "vector")] + [low.alias("low"), high.alias("high")]

    # a first look at the nearest leaf bounds the scores of the positives from below
    first = _search(index, tree, width, anchors.select(*asked(F.array(F.lit(_LEAST)), F.array(F.lit(_MOST)))), _same_label(positives), own_leaf=True)
    bound = _ranked(first, positives).where(F.col("rank") == positives).select("anchor", F.col("score").alias("bound"))
    bounded = anchors.join(bound, "anchor", "left").select(*asked(F.array(F.coalesce("bound", F.lit(_LEAST))), F.array(F.lit(_MOST))))
    best = written(_ranked(_search(index, tree, width, bounded, _same_label(positives)), positives).select("anchor", "rank", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))
    least = F.ceil(F.col("positive_score").cast("decimal(20,0)") * least_percent / 100).cast("long")
    windows = best.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", least.alias("low"), F.col("positive_score").alias("high")))).alias("windows"))
    queries = anchors.join(windows, "anchor").select(*asked(F.col("windows.low"), F.col("windows.high")))
    found = _ranked(_search(index, tree, width, queries, _other_label(negatives)), negatives)
    found = found.select("anchor", (F.col("which") + 1).alias("of_rank"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    of = best.select("anchor", F.col("rank").alias("of_rank"), "positive_id", "positive_score")
    joined = found.join(of, ["anchor", "of_rank"]).join(anchors.select("anchor", "anchor_id"), "anchor")
    return joined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
