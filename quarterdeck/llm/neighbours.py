"""Nearest neighbours by inner product: a hierarchical k-means tree with best-bin-first traversal.

* The tree is fitted on a bounded sample (``FIT_ROWS`` vectors, in order of a hash of the id): k-means with ``BRANCH``
  children per node until a node holds fewer than ``LEAF_ROWS`` sample rows. Its size depends on the sample alone.
* Every vector is indexed: it descends the tree to its leaf (one pass, no shuffle) and is written with its leaf.
* A query walks the tree best bin first: a priority queue of nodes ordered by the inner product with the node's
  centre gives the leaves in the order in which they are worth a visit.
* How many leaves a query visits is calibrated: ``CALIBRATION`` queries are searched exactly against all rows
  in blocks, and visits are widened until ``TARGET`` of their true neighbours lie in visited leaves. If no width short of all
  leaves reaches that, all are visited, which is exact.

Search: (query, leaf) pairs meet the index by leaf in blocks of at most ``BLOCK`` vectors each, so a leaf with a third of
all rows is many blocks; each block yields its own best ``k`` per query, and a ranking over these few rows gives the result.
Scores are double-precision inner products of the original vectors; a copy's ties go to the smaller vec_id in every step.

Bounds: the tree (at most ``FIT_ROWS`` / ``LEAF_ROWS`` leaves or so) and the calibration queries are broadcast; the stated
query set is a table like any other.

Defined cases: vectors that are null, zero, of another length than the most common one, or hold a null or non-finite
component take no part, nor do null vec_ids; of rows with an equal vec_id the smallest vector takes part; a table
without usable vectors gives no rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarterdeck.llm.common import batch_of, staged

FIT_ROWS, BRANCH, LEAF_ROWS, ROUNDS = 20_000, 8, 250, 12
CALIBRATION, TARGET = 200, 0.98
BLOCK = 4096


class Tree:
    """Centres and children of every node; node 0 is the root."""

    def __init__(self, sample: np.ndarray, seed: int = 5):
        self.centres: list[np.ndarray] = [sample.mean(axis=0)]
        self.children: list[list[int]] = [[]]
        self.leaf_of: dict[int, int] = {}
        self.rng = np.random.default_rng(seed)
        self._grow(0, sample)
        self.stack = {n: np.array([self.centres[c] for c in cs]) for n, cs in enumerate(self.children) if cs}

    def _grow(self, node: int, rows: np.ndarray) -> None:
        groups = self._split(rows) if len(rows) >= 2 * LEAF_ROWS else []
        if len(groups) < 2:
            self.leaf_of[node] = len(self.leaf_of)
            return
        for part, centre in groups:
            child = len(self.centres)
            self.centres.append(centre)
            self.children.append([])
            self.children[node].append(child)
            self._grow(child, rows[part])

    def _split(self, rows: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        distinct = np.unique(rows, axis=0)
        if len(distinct) < 2:
            return []
        centres = distinct[self.rng.choice(len(distinct), min(BRANCH, len(distinct)), replace=False)]
        for _ in range(ROUNDS):
            own = nearest(rows, centres)
            centres = np.array([rows[own == c].mean(axis=0) for c in range(len(centres)) if (own == c).any()])
        own = nearest(rows, centres)
        return [(np.flatnonzero(own == c), centres[c]) for c in range(len(centres)) if (own == c).any()]

    @property
    def leaves(self) -> int:
        return len(self.leaf_of)

    def assign(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of every row, by descent to the nearest centre."""
        out = np.zeros(len(rows), np.int32)
        todo = [(0, np.arange(len(rows)))]
        while todo:
            node, part = todo.pop()
            if not len(part):
                continue
            if node in self.leaf_of:
                out[part] = self.leaf_of[node]
                continue
            own = nearest(rows[part], self.stack[node])
            todo += [(child, part[own == c]) for c, child in enumerate(self.children[node])]
        return out

    def best_bins(self, query: np.ndarray, most: int) -> list[int]:
        """The first ``most`` leaves of a best-bin-first walk."""
        heap, found = [(0.0, 0)], []
        while heap and len(found) < most:
            _, node = heapq.heappop(heap)
            if node in self.leaf_of:
                found.append(self.leaf_of[node])
                continue
            for child, near in zip(self.children[node], (self.stack[node] @ query).tolist(), strict=True):
                heapq.heappush(heap, (-near, child))
        return found


def nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres * centres).sum(axis=1) - 2 * (rows @ centres.T), axis=1)


def usable(table: DataFrame) -> DataFrame:
    """vec_id and vector (array of double) of the rows that take part."""
    v = F.col("vector")
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = rows.where(F.col("vec_id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0.0))
    widths = rows.groupBy(F.size(v).alias("width")).count().orderBy(F.desc("count"), "width").limit(1).collect()
    rows = rows.where(F.size(v) == (widths[0]["width"] if widths else 0))
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def sample_matrix(rows: DataFrame, n: int) -> np.ndarray:
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(n).collect()
    return np.array([r["vector"] for r in picked], np.float64)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        kept = np.flatnonzero(scores >= edge)
        return kept[np.lexsort((ids[kept], -scores[kept]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def inner(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products added up component by component, so that equal vectors score alike in any block."""
    return np.einsum("ij,j->i", rows, query)


def index(rows: DataFrame, tree: Tree) -> DataFrame:
    """leaf, vec_id, vector of every row, written to the shared folder."""
    held = rows.sparkSession.sparkContext.broadcast(tree)
    kinds = pa.schema([("leaf", pa.int32()), ("vec_id", pa.int64()), ("vector", pa.list_(pa.float64()))])

    def run(batches):
        for b in batches:
            if b.num_rows:
                yield batch_of(kinds, (held.value.assign(matrix(b.column(1))), b.column(0), b.column(1)))

    return staged(rows.mapInArrow(run, "leaf int, vec_id long, vector array<double>"), "vector-index")


def true_neighbours(indexed: DataFrame, queries: np.ndarray, ids: np.ndarray, k: int) -> DataFrame:
    """query (its place), score, vec_id and leaf of the exact neighbours of a bounded set of queries, in blocks of all rows."""
    held = indexed.sparkSession.sparkContext.broadcast((queries, ids))
    kinds = pa.schema([("query", pa.int32()), ("score", pa.float64()), ("vec_id", pa.int64()), ("leaf", pa.int32())])

    def run(batches):
        q, own = held.value
        for b in batches:
            rows, keys, leaf = matrix(b.column(2)), b.column(1).to_numpy(), b.column(0).to_numpy()
            if not len(rows):
                continue
            got = []
            for i in range(len(q)):
                s = inner(rows, q[i])
                s[keys == own[i]] = -np.inf
                top = best(s, keys, k)
                top = top[s[top] > -np.inf]
                got.append((np.full(len(top), i, np.int32), s[top], keys[top], leaf[top]))
            yield batch_of(kinds, [np.concatenate(x) for x in zip(*got, strict=True)])

    every = indexed.mapInArrow(run, "query int, score double, vec_id long, leaf int")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def calibrate(indexed: DataFrame, queries: DataFrame, tree: Tree, k: int, target: float = TARGET) -> int:
    """The fewest visited leaves that hold ``target`` of the calibration queries' true neighbours."""
    picked = queries.orderBy(F.xxhash64("vec_id", F.lit(1)), "vec_id").limit(CALIBRATION).collect()
    if not picked:
        return tree.leaves
    vectors = np.array([r["vector"] for r in picked], np.float64)
    found = true_neighbours(indexed, vectors, np.array([r["vec_id"] for r in picked]), k).select("query", "leaf").collect()
    place = [{leaf: i for i, leaf in enumerate(tree.best_bins(q, tree.leaves))} for q in vectors]
    needed = np.sort([place[r["query"]][r["leaf"]] + 1 for r in found])
    return int(needed[min(len(needed) - 1, int(np.ceil(target * len(needed))))]) if len(needed) else tree.leaves


def search(table: DataFrame, is_query: Column, k: int = 20, target: float = TARGET) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row that ``is_query`` (of vec_id) marks."""
    spark = table.sparkSession
    rows = staged(usable(table), "vectors")
    sample = sample_matrix(rows, FIT_ROWS)
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    tree = Tree(sample)
    indexed = index(rows, tree)
    queries = rows.where(is_query)
    visits = calibrate(indexed, queries, tree, k, target)
    held = spark.sparkContext.broadcast(tree)
    kinds = pa.schema([("query_id", pa.int64()), ("query", pa.list_(pa.float64())), ("leaf", pa.int32())])

    def walk(batches):
        for b in batches:
            for row, key, q in zip(matrix(b.column(1)) if b.num_rows else (), b.column(0).to_pylist(), b.column(1), strict=True):
                bins = held.value.best_bins(row, visits)
                yield batch_of(kinds, ([key] * len(bins), pa.array([q.as_py()] * len(bins), pa.list_(pa.float64())), bins))

    # Index blocks: about BLOCK rows of one leaf, however many the leaf has; the number of blocks per leaf is a small table.
    blocks = indexed.groupBy("leaf").count().select("leaf", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    held_blocks = F.broadcast(blocks)  # a row per leaf of the bounded tree
    stored = indexed.join(held_blocks, "leaf").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
    asked = queries.mapInArrow(walk, "query_id long, query array<double>, leaf int").join(held_blocks, "leaf")
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # A leaf's queries come in parts too, so that no group holds all of a hot leaf's.
    part = F.pmod(F.xxhash64("query_id"), F.lit(1 << 16)).cast("int")
    asks = asked.groupBy("leaf", "block").count().withColumn("parts", F.ceil(F.col("count") / BLOCK).cast("int")).drop("count")
    asked = asked.join(asks, ["leaf", "block"]).withColumn("part", part % F.col("parts"))
    stored = stored.join(asks, ["leaf", "block"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    asked = asked.select("leaf", "block", "part", "query_id", "query")
    stored = stored.select("leaf", "block", "part", "vec_id", "vector")
    out = pa.schema([("query_id", pa.int64()), ("score", pa.float64()), ("vec_id", pa.int64())])

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, found = right.column("vec_id").to_numpy(), []
        order = np.argsort(ids)
        ids = ids[order]
        data = matrix(right.column("vector").combine_chunks())[order] if len(ids) else np.zeros((0, 0))
        asking = matrix(left.column("query").combine_chunks()) if left.num_rows else np.zeros((0, 0))
        for key, q in zip(left.column("query_id").to_pylist(), asking, strict=True):
            if not len(ids):
                break
            s = inner(data, q)
            s[ids == key] = -np.inf
            top = best(s, ids, k)
            top = top[s[top] > -np.inf]
            found.append((np.full(len(top), key, np.int64), s[top], ids[top]))
        columns = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [[], [], []]
        return pa.Table.from_batches([batch_of(out, columns)])

    by = ["leaf", "block", "part"]
    got = asked.groupBy(by).cogroup(stored.groupBy(by)).applyInArrow(score, "query_id long, score double, vec_id long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = got.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op3_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return search(table, F.col("vec_id") % 20 == 0)
