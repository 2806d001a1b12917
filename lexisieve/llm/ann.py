"""Approximate nearest neighbours: a forest of random-projection trees, one queue, exact reranking.

A tree splits by the plane halfway between two random vectors. The forest is fitted on a
bounded sample of distinct vectors (``FIT_ROWS``, those with the least hashes) and every
vector is indexed, one row for each tree. A query walks all trees through one priority
queue: next comes the node whose path has the largest least margin. Leaves are taken until
they hold ``max(min_candidates, share of all vectors)`` distinct vectors, as the sample's
vectors in them tell. Every vector of the leaves taken is scored in double precision by
inner product.

Equal vectors are one index entry with its ``k + 1`` least ids, which is all of them that
can be among ``k`` nearest; equal queries are searched once. The sample's vectors in a
query's leaves give it a score that its ``k`` nearest reach, so only entries that
reach it leave a leaf. A leaf is cut into blocks of about ``BLOCK`` entries and its queries
into teams of about ``ASKED``, by hash; a block and a team are one matrix product.

Defined results: vectors that are null, empty, zero, or hold a null or non-finite number
take no part, nor do those of another length than most; a query does not find its own id;
ties go to the smaller id; with fewer candidates than ``k`` all are returned; repeated
rows count once; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexisieve.operators.skew import join_by_weight
from lexisieve.session import materialize

TREES, FIT_ROWS, LEAF, LEAST_SAMPLE_LEAF, BLOCK, ASKED = 24, 20_000, 768, 24, 4096, 1024


@dataclass
class Forest:
    """Planes of all trees; a child ``c >= 0`` is a plane, ``~c`` a leaf. ``roots`` likewise."""

    normals: np.ndarray
    offsets: np.ndarray
    children: np.ndarray  # (planes, 2): far side, near side
    roots: list[int]
    n_leaves: int
    rows_of: list[np.ndarray]  # the sample's vectors in each leaf

    def margins(self, vectors: np.ndarray) -> np.ndarray:
        return vectors @ self.normals.T + self.offsets

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree."""
        near = (self.margins(vectors) > 0).astype(np.int64)
        at = np.tile(np.array(self.roots), (len(vectors), 1))
        rows = np.arange(len(vectors))
        for tree in range(len(self.roots)):
            while True:
                inner = np.flatnonzero(at[:, tree] >= 0)
                if not len(inner):
                    break
                plane = at[inner, tree]
                at[inner, tree] = self.children[plane, near[rows[inner], plane]]
        return ~at

    def search(self, margins: np.ndarray, n_sample: int, share: float) -> tuple[list[int], np.ndarray]:
        """Leaves for one query, best first, until they hold ``share`` of the sample's vectors; and which."""
        queue = [(-np.inf, root) for root in self.roots]
        heapq.heapify(queue)
        found, held, taken = [], 0, np.zeros(n_sample, bool)
        while queue and (share >= 1 or held < share * n_sample):
            cost, node = heapq.heappop(queue)
            if node < 0:
                found.append(~node)
                rows = self.rows_of[~node]
                held += len(rows) - int(taken[rows].sum())
                taken[rows] = True
                continue
            margin = margins[node]
            far, near = self.children[node]
            heapq.heappush(queue, (max(cost, -margin), int(near)))
            heapq.heappush(queue, (max(cost, margin), int(far)))
        return found, taken


def bound(vector: np.ndarray, near: np.ndarray, k: int) -> float:
    """The ``k``-th best score among ``near``; -inf for fewer."""
    return float(np.partition(near @ vector, -k)[-k]) if len(near) >= k else -np.inf


def fit_forest(sample: np.ndarray, trees: int, leaf: int, seed: int = 7) -> Forest:
    rng = np.random.default_rng(seed)
    normals, offsets, children, rows_of = [], [], [], []

    def grow(rows: np.ndarray) -> int:
        if len(rows) > leaf:
            for _ in range(8):
                a, b = sample[rng.choice(rows, 2, replace=False)]
                length = np.linalg.norm(a - b)
                if length == 0:
                    continue
                normal = (a - b) / length
                offset = -(normal @ (a + b)) / 2
                near = sample[rows] @ normal + offset > 0
                if 0.1 < near.mean() < 0.9:
                    plane = len(normals)
                    normals.append(normal)
                    offsets.append(offset)
                    children.append([0, 0])
                    children[plane] = [grow(rows[~near]), grow(rows[near])]
                    return plane
        rows_of.append(rows)
        return ~(len(rows_of) - 1)

    roots = [grow(np.arange(len(sample))) for _ in range(trees)]
    width = sample.shape[1]
    return Forest(
        np.array(normals).reshape(-1, width), np.array(offsets), np.array(children).reshape(-1, 2),
        roots, len(rows_of), rows_of,
    )


def usable(vector: Column) -> Column:
    """Not null or empty, every number finite, not all zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return (F.size(vector) > 0) & F.forall(vector, finite) & F.exists(vector, lambda x: x != 0)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_list()).astype(np.float64)


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    trees: int = TREES,
    share: float = 0.6,
    min_candidates: int = 4000,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` best found of ``vectors`` for each of ``queries``."""
    spark = vectors.sparkSession

    # 32-bit vectors travel as such; all arithmetic is in double precision
    kind = "array<float>" if dict(vectors.dtypes)[vector_col] == "array<float>" else "array<double>"

    def given(df: DataFrame) -> DataFrame:
        vector = F.col(vector_col).cast(kind)
        return df.select(F.col(id_col).cast("bigint").alias("id"), vector.alias("v")).filter(
            F.col("id").isNotNull() & usable(F.col("v"))
        )

    lengths = given(vectors).groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    same = F.size("v") == lengths[0]["d"]
    inside = Window.partitionBy("v").orderBy("id")
    entries = materialize(
        given(vectors)
        .filter(same)
        .dropDuplicates(["id", "v"])
        .withColumn("_place", F.row_number().over(inside))
        .filter(F.col("_place") <= k + 1)
        .groupBy("v")
        .agg(F.sort_array(F.collect_list("id")).alias("ids"))
    )
    n = entries.count()
    sample = _matrix(
        entries.orderBy(F.xxhash64(F.col("ids")[0]), F.col("ids")[0]).limit(FIT_ROWS).select("v").toPandas()["v"]
    )
    forest = fit_forest(sample, trees, max(LEAST_SAMPLE_LEAF, LEAF * len(sample) // n))

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for at in range(0, len(rows), 1000):
                part = rows.iloc[at : at + 1000]
                yield part.assign(leaves=list(forest.leaves(_matrix(part["v"])).astype("int32")))

    indexed = materialize(entries.mapInPandas(index, f"v {kind}, ids array<bigint>, leaves array<int>"))
    by_leaf = indexed.select("v", "ids", F.explode("leaves").alias("leaf"))
    counts = np.zeros(forest.n_leaves, np.int64)
    for row in by_leaf.groupBy("leaf").count().collect():  # as many rows as the forest has leaves
        counts[row["leaf"]] = row["count"]
    blocks = F.get(F.array(*[F.lit(max(int(-(-c // BLOCK)), 1)) for c in counts]), "leaf")
    wanted = max(min_candidates / n, share)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for at in range(0, len(rows), 200):
                part = rows.iloc[at : at + 200]
                vectors = _matrix(part["v"])
                found = [forest.search(m, len(sample), wanted) for m in forest.margins(vectors)]
                least = [bound(v, sample[taken], k + 1) for v, (_, taken) in zip(vectors, found)]
                yield part.assign(leaves=[leaves for leaves, _ in found], least=least)

    asked = materialize(given(queries).filter(same).dropDuplicates(["id", "v"]))
    distinct = asked.groupBy("v").agg(F.min("id").alias("asker"), F.count("*").alias("askers"))
    searched = materialize(
        distinct.mapInPandas(search, f"v {kind}, asker bigint, askers bigint, leaves array<int>, least double")
    )
    loads = np.zeros(forest.n_leaves, np.int64)
    for row in searched.select(F.explode("leaves").alias("leaf")).groupBy("leaf").count().collect():
        loads[row["leaf"]] = row["count"]
    teams = F.get(F.array(*[F.lit(max(int(-(-c // ASKED)), 1)) for c in loads]), "leaf")

    def up_to(count: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), count - 1))

    # vectors are copied for their leaves on the JVM's side
    placed = by_leaf.withColumn("block", F.pmod(F.xxhash64(F.col("ids")[0]), blocks).cast("int")).withColumn(
        "team", up_to(teams)
    )
    probes = (
        searched.select("asker", "v", "least", F.explode("leaves").alias("leaf"))
        .withColumn("team", F.pmod(F.xxhash64("asker"), teams).cast("int"))
        .withColumn("block", up_to(blocks))
    )

    def rerank(theirs: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        """The entries of a block that reach a query's bound, with their exact scores."""
        out = []
        if len(theirs) and len(held):
            vectors, entries, ids = _matrix(theirs["v"]), _matrix(held["v"]), held["ids"].to_list()
            query, entry = np.nonzero(vectors @ entries.T >= theirs["least"].to_numpy()[:, None] - 1e-9)
            costs = -(entries[entry] * vectors[query]).sum(axis=1)
            askers = theirs["asker"].to_numpy()[query]
            out = [(a, ids[e][0], cost, ids[e]) for a, e, cost in zip(askers, entry, costs)]
        return pd.DataFrame(out, columns=["asker", "entry", "cost", "ids"])

    keys = ("leaf", "block", "team")
    scored = (
        probes.groupBy(*keys)
        .cogroup(placed.groupBy(*keys))
        .applyInPandas(rerank, "asker bigint, entry bigint, cost double, ids array<bigint>")
    )
    # an entry comes once from each tree
    entries_once = scored.groupBy("asker", "entry").agg(F.first("cost").alias("cost"), F.first("ids").alias("ids"))
    order = Window.partitionBy("asker").orderBy("cost", "vec_id")
    best = (
        entries_once.select("asker", "cost", F.explode("ids").alias("vec_id"))
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= k + 1)  # one of them may be the query itself
        .groupBy("asker")
        .agg(F.array_sort(F.collect_list(F.struct("cost", "vec_id"))).alias("best"))
    )
    # many rows may ask with one vector
    answered = join_by_weight(asked, searched.select("v", "asker", "askers"), ["v"], "askers", F.col("id"))
    answers = searched.select("asker", "askers").join(best, "asker")
    told = join_by_weight(answered.select("id", "asker"), answers, ["asker"], "askers", F.col("id"))
    others = F.filter("best", lambda x: x["vec_id"] != F.col("id"))
    return told.select(
        F.col("id").alias("query_id"), F.posexplode(F.slice(others, 1, k)).alias("at", "x")
    ).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.cost")).alias("score")
    )
