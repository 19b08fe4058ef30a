"""Hard negatives: a cover tree over norm-augmented candidates bounds inner products; what it cannot rule out is verified exactly.

* Augmenting: with M the largest norm, a candidate x becomes (x, sqrt(M^2 - |x|^2)), a point on the sphere of radius M; an anchor q
  becomes (q, 0). Inner products stay as they are, and the largest one belongs to the smallest angle.
* Tree: the centres of each level are candidates picked farthest first among a node's rows, so that they lie apart from each other and cover the
  node ever more closely. The tree is fitted on ``FIT_ROWS`` vectors (in order of a hash of the id); then **every** row
  descends to its leaf, and the covering radius of each node on the way is the largest angle to any row that passed it: the bounds hold for all rows.
* Descent: an anchor at angle t from a centre whose covering radius is p has inner products between |q| M cos(t + p) and
  |q| M cos(t - p) with all rows below. A priority queue gives the nodes best bound first, and a node outside of what is looked for is skipped
  with all below it.
* Positives first: the best ``PROBE`` leaves of each anchor are verified, and the score of the last positive found bounds the leaves left. The same again for the
  negatives: nodes that meet none of the anchor's score windows are skipped; once a window has all its negatives in the best leaves, so are those
  below the last of them. Leaves are verified by integer inner products, so the result is exact whatever the tree looks like.

Scale: one pass assigns and writes the rows by leaf; an anchor is sent to a leaf's blocks of at most ``BLOCK`` rows (so a leaf with a third of all rows, say
copies, is many tasks), and a leaf's anchors come in parts of ``PART``; each (part, block) sends back a few rows per anchor, and a ranking keeps the
first of them. The tree (about ``FIT_ROWS`` / ``LEAF_ROWS`` nodes times a small factor) is the only thing that every task gets. The rows that reach the driver
are the sample and one radius per node.

Defined cases: rows with a null id, label or vector, with null or non-finite components, with components beyond 2^24 after scaling, or whose vector has another
length than the most common one (the shorter of equally common ones) take no part; of rows with an equal vec_id the one with the smallest
label and then vector does. Ties go to the smaller vec_id. Zero vectors take part; a positive score of 0 allows negatives of score 0, one below 0 allows
none. Anchors without positives, positives without negatives, and empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarterdeck.llm.common import batch_of, staged, table

SCALE = 256
LARGEST = float(1 << 24)
FIT_ROWS, BRANCH, LEAF_ROWS, SHRINK = 20_000, 8, 500, 1.3
PROBE = 2
BLOCK, PART, AT_ONCE = 8192, 2048, 64
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95  # per cent of the positive's score
SLACK = 1e-9
NONE = np.iinfo(np.int64).min


def labelled_rows(vectors: DataFrame, label: Column, scale: int = SCALE) -> DataFrame:
    """vec_id, label, x (array of int) of the rows that take part, written once to the shared folder."""
    v = F.col("v")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("v"))
    fits = F.forall(v, lambda c: F.coalesce(F.abs(c) < F.lit(LARGEST / scale), F.lit(False)))  # NaN is larger than any number
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0) & fits)
    x = F.transform(v, lambda c: F.floor(c * F.lit(float(scale))).cast("int"))
    widths = rows.groupBy(F.size("v").alias("width")).count().orderBy(F.desc("count"), "width").limit(1).collect()
    rows = rows.where(F.size("v") == (widths[0]["width"] if widths else 0))
    least = rows.groupBy("vec_id").agg(F.min(F.struct("label", x.alias("x"))).alias("row"))
    return staged(least.select("vec_id", "row.label", "row.x"), "labelled-vectors")


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


class CoverTree:
    """Centres, children and covering radii (angles) of every node; node 0 is the root."""

    def __init__(self, sample: np.ndarray, norm: float, seed: int = 3):
        self.norm = norm
        self.centres: list[np.ndarray] = []
        self.children: list[list[int]] = []
        self.rng = np.random.default_rng(seed)
        points = np.unique(self.augmented(sample), axis=0)
        self._node(points, points[np.argmax(points @ points.mean(axis=0))])
        self.table = np.array(self.centres)
        self.radius = np.full(len(self.centres), -1.0)  # of a node without rows

    def augmented(self, rows: np.ndarray) -> np.ndarray:
        height = np.sqrt(np.maximum(self.norm**2 - (rows * rows).sum(axis=1), 0.0))
        return np.column_stack([rows, height])

    def angles(self, points: np.ndarray, centres: np.ndarray) -> np.ndarray:
        return np.arccos(np.clip(points @ centres.T / self.norm**2, -1.0, 1.0))

    def _node(self, points: np.ndarray, centre: np.ndarray) -> int:
        me = len(self.centres)
        self.centres.append(centre)
        self.children.append([])
        if len(points) >= 2 * LEAF_ROWS:
            near = self.angles(points, centre[None])[:, 0]
            limit, picked, own = near.max() / SHRINK, [centre], np.zeros(len(points), np.int64)
            while len(picked) < BRANCH and near.max() > limit:  # farthest first
                picked.append(points[near.argmax()])
                far = self.angles(points, picked[-1][None])[:, 0]
                own[far < near] = len(picked) - 1
                near = np.minimum(near, far)
            if len(picked) > 1:
                self.children[me] = [self._node(points[own == i], c) for i, c in enumerate(picked)]
        return me

    def descend(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leaf of every row, and the largest angle that each node has to a row that passes it (-1: none does)."""
        points, leaf = self.augmented(rows), np.zeros(len(rows), np.int32)
        widest = np.full(len(self.centres), -1.0)
        todo = [(0, np.arange(len(rows)))]
        while todo:
            node, part = todo.pop()
            if not len(part):
                continue
            widest[node] = max(widest[node], self.angles(points[part], self.table[node][None]).max())
            kids = self.children[node]
            if not kids:
                leaf[part] = node
                continue
            own = np.argmax(points[part] @ self.table[kids].T, axis=1)
            todo += [(kid, part[own == i]) for i, kid in enumerate(kids)]
        return leaf, widest

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest inner product that each query (row) can have with a row below each node (column)."""
        sizes = np.sqrt((queries * queries).sum(axis=1))[:, None]
        products = queries @ self.table[:, :-1].T  # the last component of an augmented query is 0
        angle = np.arccos(np.clip(products / np.maximum(sizes * self.norm, 1e-300), -1.0, 1.0))
        reach, slack = np.maximum(self.radius, 0.0)[None], SLACK * sizes * self.norm + SLACK
        low = sizes * self.norm * np.cos(np.minimum(angle + reach, np.pi)) - slack
        high = sizes * self.norm * np.cos(np.maximum(angle - reach, 0.0)) + slack
        # Angles lose digits near 0; half a unit more covers that, and whole-number scores stay apart.
        return low - 0.5, high + 0.5

    def best_first(self, high: np.ndarray, wanted: Callable[[int], bool], most: int | None = None) -> list[int]:
        """Leaves in order of their largest possible product; nodes that are not ``wanted`` are skipped with all below them."""
        heap, out = [(-high[0], 0)], []
        while heap and (most is None or len(out) < most):
            _, node = heapq.heappop(heap)
            if self.radius[node] < 0 or not wanted(node):
                continue
            if self.children[node]:
                for kid in self.children[node]:
                    heapq.heappush(heap, (-high[kid], kid))
            else:
                out.append(node)
        return out


def fit(rows: DataFrame) -> CoverTree | None:
    """The tree of a bounded sample of the rows; covering radii are still to come."""
    squares = F.aggregate("x", F.lit(0).cast("long"), lambda a, c: a + c.cast("long") * c.cast("long"))
    largest = rows.agg(F.max(squares)).first()[0]
    if largest is None:
        return None
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(FIT_ROWS).select("x").toArrow()
    return CoverTree(matrix(sample.column("x")), float(np.sqrt(max(largest, 1))) * (1 + 1e-12))


def plant(rows: DataFrame, tree: CoverTree) -> DataFrame:
    """leaf, vec_id, label, x of every row, written to the shared folder; sets the tree's covering radii from all rows."""
    held = rows.sparkSession.sparkContext.broadcast(tree)
    kinds = pa.schema([("leaf", pa.int32()), ("vec_id", pa.int64()), ("label", pa.int64()), ("x", pa.list_(pa.int32())), ("widest", pa.list_(pa.float64()))])

    def run(batches):
        for b in batches:
            if b.num_rows:
                leaf, widest = held.value.descend(matrix(b.column(2)))
                yield batch_of(kinds, (leaf, b.column(0), b.column(1), b.column(2), pa.array([widest.tolist(), *[None] * (b.num_rows - 1)], pa.list_(pa.float64()))))

    planted = staged(rows.select("vec_id", "label", "x").mapInArrow(run, "leaf int, vec_id long, label long, x array<int>, widest array<double>"), "cover-tree")
    # One array of radii per Arrow batch; their maximum by node.
    radii = planted.where(F.col("widest").isNotNull()).select(F.posexplode("widest").alias("node", "angle")).groupBy("node").agg(F.max("angle").alias("angle"))
    for r in radii.collect():
        tree.radius[r["node"]] = r["angle"] + SLACK if r["angle"] >= 0 else -1.0
    return planted.drop("widest")


def best(scores: np.ndarray, places: np.ndarray, k: int) -> np.ndarray:
    """The k of ``places`` with the largest scores, ties to the earlier place."""
    if len(places) > 4 * k:
        s = scores[places]
        places = places[s >= np.partition(s, len(s) - k)[len(s) - k]]
    return places[np.argsort(-scores[places], kind="stable")[:k]]


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer inner products: by doubles where these hold every sum, else by integers."""
    largest = (np.abs(queries).max() if queries.size else 0) * (np.abs(rows).max() if rows.size else 0) * max(1, rows.shape[1])
    if largest < 2**53:
        return (queries @ rows.T).astype(np.int64)
    return queries.astype(np.int64) @ rows.astype(np.int64).T


#: What an anchor carries: its positives found so far (best first), and per positive the score its last negative has to beat.
ASK = "anchor_id long, label long, x array<int>, positive_ids array<long>, positive_scores array<long>, floors array<long>"


def windows(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest negative score that each positive score allows."""
    return -((-LOW * scores) // 100), (HIGH * scores) // 100


def visit(anchors: DataFrame, planted: DataFrame, tree: CoverTree, negatives: bool, probe: bool) -> DataFrame:
    """anchor_id, place, score, vec_id: the best rows that anchors meet in the leaves of their descent.

    ``place`` is -1 for positives, else the place of the positive whose window the row fits. With ``probe`` the first ``PROBE``
    leaves are visited, without it all others that the results of the probe leave open.
    """
    held = anchors.sparkSession.sparkContext.broadcast(tree)
    kinds = pa.schema([("leaf", pa.int32()), ("row", pa.int32())])

    def leaves(labels, queries, scores, floors):
        t = held.value
        low, high = t.bounds(queries)
        for i in range(len(queries)):
            known = np.array(scores[i] or [], np.int64)
            least, most = (windows(known) if negatives else (np.zeros(0, np.int64), np.zeros(0, np.int64)))
            if negatives:
                if not len(known):
                    continue

                def open_to(least):
                    return lambda node, lo=low[i], hi=high[i], most=most: bool(((hi[node] >= least) & (lo[node] <= most)).any())

                first = t.best_first(high[i], open_to(least), PROBE)
                found = first if probe else t.best_first(high[i], open_to(np.maximum(least, np.array(floors[i], np.int64))))
            else:
                first = t.best_first(high[i], lambda node: True, PROBE)
                floor = known[-1] if len(known) == POSITIVES else NONE
                found = first if probe else t.best_first(high[i], lambda node, hi=high[i], floor=floor: hi[node] >= floor)
            for leaf in found if probe else [x for x in found if x not in first]:
                yield leaf, i

    def walk(batches):
        for b in batches:
            if b.num_rows:
                pairs = list(leaves(b.column(1), matrix(b.column(2)), b.column(4).to_pylist(), b.column(5).to_pylist()))
                at = pa.array([i for _, i in pairs], pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in pairs], pa.int32()), *[c.take(at) for c in b.columns]], ["leaf", *b.schema.names])

    # A leaf's rows come in blocks, its anchors in parts; how many is a table with a row per leaf.
    asked = staged(anchors.mapInArrow(walk, f"leaf int, {ASK}"), "cover-tree-asks")

    def sized(table: DataFrame) -> DataFrame:
        for name, side, size in (("blocks", planted, BLOCK), ("parts", asked, PART)):
            number = side.groupBy("leaf").count().select("leaf", F.ceil(F.col("count") / size).cast("int").alias(name))
            table = table.join(F.broadcast(number), "leaf")
        return table

    def dealt(of: str, among: str) -> Column:
        return F.pmod(F.xxhash64(of), F.col(among)).cast("int")

    def every(among: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(among) - 1))

    asked = sized(asked).withColumn("part", dealt("anchor_id", "parts")).withColumn("block", every("blocks"))
    rows = sized(planted).withColumn("block", dealt("vec_id", "blocks")).withColumn("part", every("parts"))
    out = pa.schema([("anchor_id", pa.int64()), ("place", pa.int32()), ("score", pa.int64()), ("vec_id", pa.int64())])

    def verify(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if left.num_rows and right.num_rows:
            order = np.argsort(right.column("vec_id").to_numpy())
            ids, labels = right.column("vec_id").to_numpy()[order], right.column("label").to_numpy()[order]
            data, asking = matrix(right.column("x"))[order], matrix(left.column("x"))
            own, mine = left.column("anchor_id").to_numpy(), left.column("label").to_numpy()
            known, floors = left.column("positive_scores").to_pylist(), left.column("floors").to_pylist()
            for start in range(0, len(own), AT_ONCE):
                for i, scores in enumerate(products(asking[start : start + AT_ONCE], data), start):
                    if not negatives:
                        picks = [(-1, best(scores, np.flatnonzero((labels == mine[i]) & (ids != own[i])), POSITIVES))]
                    else:
                        least, most = windows(np.array(known[i], np.int64))
                        least = np.maximum(least, np.array(floors[i], np.int64))
                        other = np.flatnonzero((labels != mine[i]) & (scores >= least.min()) & (scores <= most.max()))
                        s = scores[other]
                        picks = [(k, best(scores, other[(s >= a) & (s <= z)], NEGATIVES)) for k, (a, z) in enumerate(zip(least, most, strict=True))]
                    found += [(np.full(len(p), own[i]), np.full(len(p), k, np.int32), scores[p], ids[p]) for k, p in picks if len(p)]
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [[], [], [], []]
        return pa.Table.from_batches([batch_of(out, columns)])

    by = ["leaf", "block", "part"]
    met = asked.groupBy(by).cogroup(rows.groupBy(by)).applyInArrow(verify, "anchor_id long, place int, score long, vec_id long")
    return first_of(met, NEGATIVES if negatives else POSITIVES)


def first_of(met: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def with_positives(anchors: DataFrame, met: DataFrame) -> DataFrame:
    """The anchors with the positives found for them, best first."""
    row = F.struct((-F.col("score")).alias("worse"), "vec_id")
    lists = met.groupBy("anchor_id").agg(F.array_sort(F.collect_list(row)).alias("found"))  # at most POSITIVES each
    found = F.coalesce(F.col("found"), F.array().cast("array<struct<worse:bigint,vec_id:bigint>>"))
    lists_of = anchors.join(lists, "anchor_id", "left").withColumn("found", found)
    return staged(lists_of.select("anchor_id", "label", "x", *carried("found")), "cover-tree-anchors")


def carried(found: str) -> list[Column]:
    return [
        F.transform(found, lambda p: p["vec_id"]).alias("positive_ids"),
        F.transform(found, lambda p: -p["worse"]).alias("positive_scores"),
        F.transform(found, lambda p: F.lit(NONE)).alias("floors"),
    ]


def with_floors(anchors: DataFrame, met: DataFrame) -> DataFrame:
    """The anchors with, for each positive that has all its negatives, the score of the last one."""
    last = met.where(F.col("rank") == NEGATIVES).groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("place", "score"))).alias("last"))
    floor = F.transform("positive_ids", lambda p, i: F.coalesce(F.col("last")[i], F.lit(NONE)))
    return staged(anchors.drop("floors").join(last, "anchor_id", "left").withColumn("floors", floor).drop("last"), "cover-tree-floors")


def mine(vectors: DataFrame, is_anchor: Column, label: Column) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the rows that ``is_anchor`` (of vec_id) marks."""
    spark = vectors.sparkSession
    rows = labelled_rows(vectors, label)
    tree = fit(rows)
    if tree is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    planted = plant(rows, tree)
    asked = planted.where(is_anchor).select(F.col("vec_id").alias("anchor_id"), "label", "x")
    nothing = [F.array().cast("array<bigint>").alias(name) for name in ("positive_ids", "positive_scores", "floors")]
    near = staged(visit(asked.select("*", *nothing), planted, tree, negatives=False, probe=True), "positives").drop("rank")
    far = visit(with_positives(asked, near), planted, tree, negatives=False, probe=False).drop("rank")
    anchors = with_positives(asked, first_of(near.unionByName(far), POSITIVES))
    near = staged(visit(anchors, planted, tree, negatives=True, probe=True), "negatives")
    far = visit(with_floors(anchors, near), planted, tree, negatives=True, probe=False)
    found = first_of(near.drop("rank").unionByName(far.drop("rank")), NEGATIVES)
    place = F.col("place")
    return anchors.join(found, "anchor_id").select(
        "anchor_id",
        F.col("positive_ids")[place].alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        F.col("positive_scores")[place].alias("positive_score"),
        F.col("score").alias("negative_score"),
    )


def op13_cover_tree_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label)


ORACLE_SQL = """
WITH taking_part AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND list_bool_and(list_transform(embedding, lambda c: c IS NOT NULL AND isfinite(c)))
), scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, CAST(list_inner_product(a.x, r.x) AS BIGINT) AS score
  FROM taking_part a JOIN taking_part r ON a.vec_id <> r.vec_id
  WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, vec_id, score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), ranked AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank
  FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id
  WHERE NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3
"""
