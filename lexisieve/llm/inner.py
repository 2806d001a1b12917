"""Exact top-k search by inner product: norm-sorted vectors, rotated partial sums, residual bounds.

Vectors are sorted into bands by length (``BANDS``), longest first, and each band is
cut into cells of about ``BLOCK`` vectors by a hash of the id, however many are equal. A
query first meets about ``HEAD`` vectors of the longest bands, which gives the least score it
can end with; bands whose longest vector cannot reach that score (Cauchy-Schwarz) never see the
query, and queries that reach the same bands travel in groups of about ``ASKED``. So the
copies that are shuffled are one row for each cell and group that have to meet.

In a cell vectors are taken by descending length. The rotation puts the directions that hold
most of the vectors' lengths first (the eigenvectors of their second moments, which is their
SVD), so a partial sum over the first directions and the product of the lengths of the two
rests bound a score from above. Only pairs whose bounds reach the query's ``k``-th score are
multiplied out, from the vectors as they were given. Scores of integer vectors are exact
below 2**53; a bound only drops a pair that lies below the score by more than rounding.

The driver holds the second moments (width x width numbers), the head and a few numbers for
each band.

Defined results: vectors that are null or hold a null or non-finite number take no part; a
shorter vector counts as if zeros followed; zero and empty vectors score 0; rows without id
take no part; of rows with one id the smallest vector counts, so repeated rows count once;
a query does not find its own id; ties go to the smaller id; with fewer candidates than
``k`` all are returned; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexisieve.session import materialize

HEAD, BLOCK, ASKED, STEP = 4096, 4096, 1024, 512
#: Shares of the vectors that are shorter than a band's shortest; the longest bands are small.
BANDS = [1 - 1 / 1024, 1 - 1 / 256, 1 - 1 / 64, *(i / 16 for i in range(15, 0, -1))]
LOTS, ROUNDING = 1 << 20, 1e-9
RESULT = "query_id bigint, rank int, vec_id bigint, score double"


def whole(vector: Column, factor: float = 256.0) -> Column:
    """``floor(factor * x)`` of each component, as doubles; beyond 2**53 all doubles are whole."""

    def floored(x: Column) -> Column:
        scaled = x.cast("double") * factor
        return F.when(F.abs(scaled) < 2.0**53, F.floor(scaled).cast("double")).otherwise(scaled)

    return F.transform(vector, floored)


def _given(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (
        df.select(F.col(id_col).cast("bigint").alias("id"), v.alias("v"))
        .filter(F.col("id").isNotNull() & F.col("v").isNotNull() & F.coalesce(fine, F.lit(False)))
        .groupBy("id")
        .agg(F.min("v").alias("v"))
        .withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))
    )


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of a list column, zeros behind short ones."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    lengths = np.diff(column.offsets.to_numpy())
    if (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(column), width))
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def rotation(moments: np.ndarray) -> np.ndarray:
    """Orthogonal directions as columns, those that hold most of the lengths first."""
    return np.linalg.eigh(moments)[1][:, ::-1]


def _moments(vectors: DataFrame, width: int) -> np.ndarray:
    """Sum of ``v v'`` over all vectors, added up in Spark."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            rows = _matrix(batch.column("v"), width)
            total += rows.T @ rows
        i, j = np.triu_indices(width)
        yield pa.record_batch([pa.array(i), pa.array(j), pa.array(total[i, j])], names=["i", "j", "x"])

    sums = vectors.select("v").mapInArrow(partial, "i bigint, j bigint, x double").groupBy("i", "j").agg(F.sum("x").alias("x"))
    out = np.zeros((width, width))
    for row in sums.collect():  # width * (width + 1) / 2 numbers
        out[row["i"], row["j"]] = out[row["j"], row["i"]] = row["x"]
    return out


@dataclass
class Side:
    """Vectors of a cell with their lengths, and those of what a partial sum leaves out."""

    ids: np.ndarray
    vectors: np.ndarray
    norms: np.ndarray
    turned: np.ndarray
    rests: tuple[np.ndarray, ...]

    @classmethod
    def of(cls, table: pa.Table, basis: np.ndarray, widths: tuple[int, ...]) -> Side:
        vectors = _matrix(table.column("v"), len(basis))
        turned = vectors @ basis
        rests = tuple(np.linalg.norm(turned[:, w:], axis=1) for w in widths)
        return cls(table.column("id").to_numpy(), vectors, table.column("norm").to_numpy(), turned, rests)


def keep_best(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's ``k`` best entries, best first, ties to the smaller id."""
    order = np.lexsort((ids, -scores, query))
    sorted_query = query[order]
    starts = np.flatnonzero(np.r_[True, sorted_query[1:] != sorted_query[:-1]]) if len(order) else np.zeros(0, int)
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
    return order[rank < k]


def search_cell(asked: Side, held: Side, least: np.ndarray, widths: tuple[int, ...], k: int):
    """``(place of query, id, score)`` of each query's ``k`` best of a cell, if they reach ``least``."""
    least = least.copy()
    order = np.argsort(-held.norms, kind="stable")
    query, ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    first, second = widths
    for at in range(0, len(order), STEP):
        block = order[at : at + STEP]
        active = np.flatnonzero(asked.norms * held.norms[block[0]] * (1 + ROUNDING) >= least)
        if not len(active):
            break
        slack = ROUNDING * (1 + np.outer(asked.norms[active], held.norms[block]))
        partial = asked.turned[active, :first] @ held.turned[block, :first].T
        bound = partial + np.outer(asked.rests[0][active], held.rests[0][block]) + slack
        alive = bound >= least[active, None]
        if alive.mean() > 0.25:  # one matrix product is cheaper than so many pairs
            exact = asked.vectors[active] @ held.vectors[block].T
            q, c = np.nonzero(alive & (exact >= least[active, None]))
            exact = exact[q, c]
        else:
            q, c = np.nonzero(alive)
            nearer = partial[q, c] + np.einsum(
                "ij,ij->i", asked.turned[active[q], first:second], held.turned[block[c], first:second]
            )
            bound = nearer + asked.rests[1][active[q]] * held.rests[1][block[c]] + slack[q, c]
            reach = bound >= least[active[q]]
            q, c = q[reach], c[reach]
            exact = np.einsum("ij,ij->i", asked.vectors[active[q]], held.vectors[block[c]])
        q, c = active[q], block[c]
        fits = (exact >= least[q]) & (asked.ids[q] != held.ids[c])
        if not fits.any():
            continue
        query, ids = np.r_[query, q[fits]], np.r_[ids, held.ids[c[fits]]]
        scores = np.r_[scores, exact[fits]]
        best = keep_best(query, ids, scores, k)
        query, ids, scores = query[best], ids[best], scores[best]
        counts = np.bincount(query, minlength=len(least))
        full = np.flatnonzero(counts >= k)
        ends = np.cumsum(counts)[full] - 1  # entries are sorted by query, best first
        least[full] = np.maximum(least[full], scores[ends])
    return query, ids, scores


def _numbers(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def top_inner_products(
    vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` of ``vectors`` with the largest inner products.

    ``queries`` are rows of the same kind; a query does not find its own id.
    """
    spark = vectors.sparkSession
    given = materialize(_given(vectors, id_col, vector_col))
    shape = given.agg(
        F.count("*").alias("n"),
        F.max(F.size("v")).alias("width"),
        F.percentile_approx("norm", BANDS, 10_000).alias("edges"),
    ).first()
    if not shape["n"]:
        return spark.createDataFrame([], RESULT)
    width = max(shape["width"], 1)
    basis = rotation(_moments(given, width))
    widths = (max(width // 4, 1), max(width // 2, 1))

    # bands by length, longest first, and their cells
    edges = sorted(set(shape["edges"][:: max(len(BANDS) * BLOCK // shape["n"], 1)]), reverse=True)
    band = sum((F.when(F.col("norm") < edge, 1).otherwise(0) for edge in edges), F.lit(0))
    longest, held = np.zeros(len(edges) + 1), np.zeros(len(edges) + 1, int)
    for row in given.groupBy(band.alias("band")).agg(F.count("*").alias("n"), F.max("norm").alias("longest")).collect():
        longest[row["band"]], held[row["band"]] = row["longest"], row["n"]
    cells = -(-held // BLOCK)
    cell_ends = np.cumsum(cells)

    # the least score that each query can end with, and how many bands can reach it
    lots = np.clip(HEAD - (np.cumsum(held) - held), 0, held) * LOTS // np.maximum(held, 1)
    drawn = F.pmod(F.xxhash64(F.lit("head"), "id"), F.lit(LOTS)) < F.get(_numbers(map(int, lots)), band)
    head = given.filter(drawn).select("id", "v").toArrow()
    head_ids, head_vectors = head.column("id").to_numpy(), _matrix(head.column("v"), width)

    def meet_head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for at in range(0, len(whole_batch), ASKED):
                batch = whole_batch.slice(at, ASKED)
                ids, norms = batch.column("id").to_numpy(), batch.column("norm").to_numpy()
                scores = _matrix(batch.column("v"), width) @ head_vectors.T
                scores[ids[:, None] == head_ids] = -np.inf
                least = np.full(len(ids), -np.inf)
                if len(head_ids) >= k:
                    least = np.partition(scores, -k, axis=1)[:, -k]
                reach = (np.outer(norms, longest) * (1 + ROUNDING) >= least[:, None]) & (held > 0)
                bands = np.where(reach, np.arange(1, len(longest) + 1), 0).max(axis=1)
                yield pa.record_batch(
                    [*batch.columns, pa.array(least), pa.array(bands.astype("int32"))],
                    names=["id", "v", "norm", "least", "bands"],
                )

    asked = materialize(
        _given(queries, id_col, vector_col).mapInArrow(
            meet_head, "id bigint, v array<double>, norm double, least double, bands int"
        )
    )
    groups = np.zeros(len(longest) + 1, int)
    for row in asked.groupBy("bands").count().collect():
        groups[row["bands"]] = -(-row["count"] // ASKED)
    # groups that reach most bands come first, so those that meet a band are 0, 1, ...
    group_ends = np.cumsum(groups[::-1])[::-1]
    group_starts = group_ends - groups

    def dealt(starts, sizes, place: Column) -> Column:
        size = F.get(_numbers(max(int(s), 1) for s in sizes), place)
        return F.get(_numbers(int(s) for s in starts), place) + F.pmod(F.xxhash64("id"), size).cast("int")

    def up_to(count: Column) -> Column:
        return F.explode(F.when(count > 0, F.sequence(F.lit(0), count - 1)))

    bands = F.col("bands")
    probes = asked.withColumn("team", dealt(group_starts, groups, bands)).withColumn(
        "cell", up_to(F.get(_numbers([0, *map(int, cell_ends)]), bands))
    )
    copies = (
        given.withColumn("band", band)
        .withColumn("cell", dealt(cell_ends - cells, cells, F.col("band")))
        .withColumn("team", up_to(F.get(_numbers(int(e) for e in group_ends[1:]), F.col("band"))))
        .drop("band")
    )

    def meet(theirs: pa.Table, ours: pa.Table) -> pa.Table:
        query, ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        if len(theirs) and len(ours):
            ask = Side.of(theirs, basis, widths)
            least = theirs.column("least").to_numpy()
            query, ids, scores = search_cell(ask, Side.of(ours, basis, widths), least, widths, k)
            query = ask.ids[query]
        return pa.table({"query_id": query, "vec_id": ids, "score": scores})

    found = (
        probes.select("team", "cell", "id", "v", "norm", "least")
        .groupBy("team", "cell")
        .cogroup(copies.select("team", "cell", "id", "v", "norm").groupBy("team", "cell"))
        .applyInArrow(meet, "query_id bigint, vec_id bigint, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
