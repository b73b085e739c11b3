"""Exact top-k inner products by pivot-table elimination.

Every vector keeps its distances to many pivots, worked out once. For a query q and a
candidate x, |d(q, p) - d(x, p)| of each pivot p is a lower bound on d(q, x), and with both
norms an upper bound on their inner product. The pivots here are points of one norm in
orthogonal directions, so that the distances tell a vector's place in their span and its
distance from that span: the greatest lower bound that all pivots allow together is
sqrt(|place(q) - place(x)|^2 + (rest(q) - rest(x))^2), never below the best single one.
Candidates are evaluated in the order of that bound, until the k-th best score found exceeds
every bound that is left.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCALE = 256
_EXACT = float(1 << 52)  # doubles hold whole numbers below without loss
_LONG = (1 << 63) - 1
_ROUNDING = 1e-8  # of a squared norm: more than distances lose by rounding
_BLOCK_BYTES = 32 << 20


@dataclass(frozen=True)
class TopKConfig:
    k: int = 5
    every: int = 50  # rows whose id this divides are the queries
    pivots: int = 48
    candidate_rows: int = 8_192  # of a block
    query_rows: int = 1_024  # of a block
    first_look: int = 64  # candidates evaluated before the bound is looked at


def usable(vector: Column) -> Column:
    """Neither null nor holding null, NaN or infinity. An empty vector is usable."""
    finite = F.forall(
        vector,
        lambda x: F.coalesce(
            ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)
        ),
    )
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """floor(256 x) as doubles, rows padded with zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    starts = np.asarray(vectors.offsets)
    values = np.asarray(vectors.values.cast(pa.float64()))[starts[0] : starts[-1]]
    lengths = np.diff(starts)
    out = np.zeros((len(vectors), width))
    if len(values):
        row = np.repeat(np.arange(len(vectors)), lengths)
        place = np.arange(len(values)) - np.repeat(starts[:-1] - starts[0], lengths)
        with np.errstate(over="ignore"):
            out[row, place] = np.clip(np.floor(values * SCALE), -1e300, 1e300)
    return out


def _distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    scale = max(1.0, float(np.abs(rows).max(initial=0)), float(np.abs(pivots).max(initial=0)))
    a, b = rows / scale, pivots / scale
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T
    return np.sqrt(np.maximum(square, 0)) * scale


def orthogonal(rows: np.ndarray) -> np.ndarray:
    """Pivots in the span of the rows: orthogonal, each of the largest norm among the rows.

    Rows that add no direction of their own (or next to none) give no pivot.
    """
    scale = float(np.abs(rows).max(initial=0))
    found: list[np.ndarray] = []
    longest = 0.0
    for row in rows / scale if scale else rows[:0]:
        norm = float(np.sqrt(row @ row))
        longest = max(longest, norm)
        rest = row.copy()
        for _ in range(2):  # once more, for what rounding left
            for axis in found:
                rest -= (rest @ axis) * axis
        length = float(np.sqrt(rest @ rest))
        if length > 1e-6 * max(longest, norm):
            found.append(rest / length)
    return np.array(found).reshape(-1, rows.shape[1]) * (longest * scale)


def places(squares: np.ndarray, table: np.ndarray, norm: float) -> np.ndarray:
    """From squared norms and distances to orthogonal pivots of one norm: the place in the
    pivots' span, and last the distance from it, rounded up."""
    out = np.empty((len(table), table.shape[1] + 1))
    with np.errstate(over="ignore", invalid="ignore"):
        if table.shape[1]:
            out[:, :-1] = (squares[:, None] + norm * norm - table * table) / (2 * norm)
        rest = squares - (out[:, :-1] ** 2).sum(axis=1)
        out[:, -1] = np.sqrt(np.maximum(rest, 0) + _ROUNDING * squares)
    return out


def _scores(rows: np.ndarray, query: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products as whole numbers; beyond 64 bits the nearest such number."""
    if exact:
        return (rows @ query).astype(np.int64)
    whole = [int(x) for x in query]
    found = [sum(int(a) * b for a, b in zip(row, whole, strict=True)) for row in rows]
    return np.array([max(-_LONG, min(_LONG, s)) for s in found], np.int64)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def search(
    query: np.ndarray,
    query_id: int,
    to_pivots: np.ndarray,
    ids: np.ndarray,
    rows: np.ndarray,
    squares: np.ndarray,
    table: np.ndarray,
    config: TopKConfig,
    bound: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray, int]:
    """Ids and scores of the best k candidates, and how many were evaluated.

    ``bound``: upper bounds on the scores from all pivots together; without, the best single
    pivot bounds each.
    """
    exact = max(
        float(np.abs(rows).max(initial=0)), float(np.abs(query).max(initial=0))
    ) ** 2 * max(1, query.size) < _EXACT
    own = float(query @ query)
    if exact:
        if bound is None:
            low = np.abs(table - to_pivots).max(axis=1, initial=0.0)
            bound = (own + squares - low * low) / 2
        bound = bound + 1.0 + _ROUNDING * (own + squares)
    else:  # numbers too large to bound in doubles: evaluate all
        bound = np.full(len(ids), np.inf)
    order = np.argsort(-bound, kind="stable")
    order = order[ids[order] != query_id]
    best_ids, best_scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    falling = -bound[order]
    at, step, end = 0, config.first_look, len(order)
    while at < end:
        chunk = order[at : min(at + step, end)]
        all_ids = np.concatenate([best_ids, ids[chunk]])
        all_scores = np.concatenate([best_scores, _scores(rows[chunk], query, exact)])
        best = _best(all_ids, all_scores, config.k)
        best_ids, best_scores = all_ids[best], all_scores[best]
        at, step = at + len(chunk), step * 2
        if len(best_scores) == config.k:  # the rest is bounded below the k-th best score
            end = int(np.searchsorted(falling, -float(best_scores[-1]), side="right"))
    return best_ids, best_scores, at


def top_k(vectors: DataFrame, config: TopKConfig = TopKConfig()) -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of each query row.

    ``vectors`` has vec_id and embedding. Components become floor(256 x); shorter vectors count
    as padded with zeros. Vectors that are null or hold null, NaN or infinity, and rows
    without an id, take no part; a row is no candidate for its own id. Scores are exact (beyond
    64 bits the nearest bigint); ties go to the smaller id. Rows that repeat an id are
    candidates each, and queries under one id share one list. Fewer candidates than k: all.

    Queries meet all candidates in blocks of bounded size. A block pair is one group; it
    returns k rows a query, and the lists of a query are merged. Of equal rows only k are kept,
    as more never rank, so that no block holds a large group of them.
    """
    spark = vectors.sparkSession
    rows = vectors.filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    is_query = F.col("vec_id") % config.every == 0
    n, n_queries, width = rows.agg(
        F.count("*"), F.count_if(is_query), F.coalesce(F.max(F.size("vector")), F.lit(0))
    ).first()
    width = max(1, width)
    chosen = rows.orderBy(F.xxhash64(F.lit("pivot"), "vec_id"), "vec_id").limit(config.pivots)
    pivots = _matrix(
        pa.array([r["vector"] for r in chosen.collect()], pa.list_(pa.float64())), width
    )
    pivots = orthogonal(pivots)
    norm = float(np.sqrt(pivots[0] @ pivots[0])) if len(pivots) else 0.0
    shipped = spark.sparkContext.broadcast(pivots)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix = _matrix(batch.column("vector"), width)
            table = _distances(matrix, shipped.value)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    pa.array([x.tobytes() for x in matrix], pa.binary()),
                    pa.array([x.tobytes() for x in table], pa.binary()),
                ],
                names=["vec_id", "vector", "distances"],
            )

    ranking = (
        rows.groupBy("vec_id", "vector")
        .agg(F.count("*").alias("_n"))
        .select(
            "vec_id", "vector", F.explode(F.sequence(F.lit(1), F.least("_n", F.lit(config.k))))
        )
        .select("vec_id", "vector")
    )
    table = ranking.mapInArrow(measure, "vec_id bigint, vector binary, distances binary")
    block_rows = max(256, min(config.candidate_rows, _BLOCK_BYTES // (8 * width)))
    n_blocks = max(1, -(-n // block_rows))
    n_query_blocks = max(1, -(-n_queries // min(block_rows, config.query_rows)))
    block = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(n_blocks)).cast("int")
    query_block = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(n_query_blocks)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    columns = ["block", "query_block", "asks", "vec_id", "vector", "distances"]
    candidates = table.withColumns(
        {"block": block, "query_block": every(n_query_blocks), "asks": F.lit(False)}
    )
    queries = table.filter(is_query).withColumns(
        {"query_block": query_block, "block": every(n_blocks), "asks": F.lit(True)}
    )
    met = candidates.select(*columns).unionByName(queries.select(*columns))

    def answer(group: pa.Table) -> pa.Table:
        asks = np.asarray(group["asks"].combine_chunks())
        ids = np.asarray(group["vec_id"].combine_chunks())

        def stacked(name: str, wide: int) -> np.ndarray:
            joined = b"".join(group[name].to_pylist())
            return np.frombuffer(joined, np.float64).reshape(-1, wide)

        vector = stacked("vector", width)
        distances = stacked("distances", len(shipped.value))
        own_ids, own, own_table = ids[~asks], vector[~asks], distances[~asks]
        all_squares = (vector * vector).sum(1)
        placed = places(all_squares, distances, norm)
        squares, own_placed = all_squares[~asks], placed[~asks]
        found: list[tuple[np.ndarray, ...]] = []
        for i in np.flatnonzero(asks):
            bound = own_placed @ placed[i]
            best, score, _ = search(
                vector[i], ids[i], distances[i], own_ids, own, squares, own_table, config, bound
            )
            found.append((np.full(len(best), ids[i]), best, score))
        joined = [np.concatenate(x) for x in zip(*found, strict=True)] or [np.zeros(0)] * 3
        return pa.table(
            {
                name: pa.array(np.asarray(x, np.int64))
                for name, x in zip(("query_id", "vec_id", "score"), joined, strict=True)
            }
        )

    lists = met.groupBy("block", "query_block").applyInArrow(
        answer, "query_id bigint, vec_id bigint, score bigint"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = lists.withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= config.k).select("query_id", "rank", "vec_id", "score")
