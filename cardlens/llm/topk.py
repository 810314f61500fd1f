"""Exact top-k by inner product with bounds from segment statistics, coarse to fine.

A vector is cut into segments; each segment's mean and deviation bound what it can add
to an inner product (the deviations by Cauchy-Schwarz), which is a lower bound of the
distance.  Levels go from few wide segments to pairs of components; each looks only at
what the one before left, and what is left in the end is computed exactly.  Queries meet
all vectors block by block: queries are sent round in passes of bounded size, the vectors
stay where they are read, and a task carries each query's k best on from block to block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardlens.workspace import scratch_path, snapshot

QUERY_BLOCK = 1024
VECTOR_BLOCK = 4096
# bytes of query blocks that one pass broadcasts
PASS_BYTES = 32 << 20
COARSEST = 4
PROBES = 4  # times k: pairs computed at once at every level, for a threshold
FINER = 2  # each level has so many times the segments of the one before
QUERIES_AT_ONCE = 256
# pairs whose numbers are gathered at a time
PAIRS_AT_ONCE = 1 << 16


def scaled_blocks(batches: Iterator[pa.RecordBatch], rows: int, scale: float) -> Iterator[pa.RecordBatch]:
    """Blocks of whole-number vectors of one length; vectors with a null or non-finite component are left out."""
    for batch in batches:
        ids, vectors = batch.column(0).to_pylist(), batch.column(1)
        by_length: dict[int, tuple[list, list]] = {}
        for key, start, end in zip(ids, vectors.offsets.to_pylist(), vectors.offsets.to_pylist()[1:]):
            if key is not None and end > start:
                own = by_length.setdefault(end - start, ([], []))
                own[0].append(key)
                own[1].append(start)
        flat = vectors.values.cast(pa.float64())
        values = np.floor(scale * flat.fill_null(np.nan).to_numpy(zero_copy_only=False))
        for length, (keys, starts) in by_length.items():
            matrix = values[np.array(starts)[:, None] + np.arange(length)]
            good = np.isfinite(matrix).all(1)
            keys, matrix = np.array(keys, np.int64)[good], matrix[good]
            for i in range(0, len(keys), rows):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([length], pa.int32()), pa.array([keys[i : i + rows].tobytes()], pa.binary()), pa.array([matrix[i : i + rows].tobytes()], pa.binary())],
                    ["length", "ids", "numbers"],
                )


def statistics(matrix: np.ndarray, segments: int) -> np.ndarray:
    """Per segment, mean and deviation scaled so that the product of two rows bounds the vectors' product."""
    parts = np.array_split(np.arange(matrix.shape[1]), min(segments, matrix.shape[1]))
    columns = []
    for part in parts:
        own, root = matrix[:, part], np.sqrt(len(part))
        columns += [own.mean(1) * root, own.std(1) * root]
    return np.stack(columns, 1)


def levels(length: int) -> list[int]:
    """Numbers of segments, coarse to fine; the finest segments hold two or three components."""
    return [COARSEST * FINER**i for i in range(length.bit_length()) if COARSEST * FINER**i * 2 <= length]


def products(a: np.ndarray, b: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of the rows ``left`` of ``a`` and ``right`` of ``b``."""
    made = [np.einsum("pd,pd->p", a[left[i : i + PAIRS_AT_ONCE]], b[right[i : i + PAIRS_AT_ONCE]]) for i in range(0, len(left), PAIRS_AT_ONCE)]
    return np.concatenate(made) if made else np.empty(0, a.dtype)


def pairwise(a: np.ndarray, b: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Inner products of the pairs marked in ``left``, row by row; by columns that hold one where marks are dense."""
    rows, columns = np.nonzero(left)
    if len(rows) * 10 < left.size:
        return products(a, b, rows, columns)
    used = np.flatnonzero(left.any(0))
    return (a @ b[used].T)[left[:, used]]


def promising(own: np.ndarray, x: np.ndarray, bound: np.ndarray, k: int) -> np.ndarray:
    """Per query, the k-th best score among some pairs of the highest bounds: nothing below it is among the k best."""
    if len(x) < k:
        return np.full((len(own), 1), -np.inf)
    some = min(PROBES * k, len(x))
    most = np.argpartition(bound, -some, axis=1)[:, -some:]
    exact = np.einsum("qd,qkd->qk", own, x[most]).astype(np.float64)
    exact[np.isneginf(np.take_along_axis(bound, most, 1))] = -np.inf
    return np.partition(exact, -k, axis=1)[:, -k, None]


def best_of_block(q_ids: np.ndarray, q: np.ndarray, x_ids: np.ndarray, x: np.ndarray, best: np.ndarray, counts: dict[int, list[int]]) -> tuple[np.ndarray, ...]:
    """``query_id, vec_id, score`` of whatever a block of vectors can add to each query's best; its own row is left out.

    ``best`` has each query's best scores so far, highest first, and is brought up to date.  ``counts`` gets, by the
    level's segments, how many pairs came to it and how many it left.
    """
    k, steps = best.shape[1], levels(q.shape[1])
    largest = max(np.abs(q).max(initial=0), np.abs(x).max(initial=0))
    exact_type = np.float64 if largest**2 * x.shape[1] < 2**53 else np.int64
    x_levels, x = [statistics(x, s) for s in steps], x.astype(exact_type)
    out = []
    for start in range(0, len(q_ids), QUERIES_AT_ONCE):
        ids, own, so_far = q_ids[start : start + QUERIES_AT_ONCE], q[start : start + QUERIES_AT_ONCE], best[start : start + QUERIES_AT_ONCE]
        # what rounding may do to a bound
        slack = 1e-6 * (1 + np.abs(own).sum(1, keepdims=True) * (1 + largest))
        q_levels, own = [statistics(own, s) for s in steps], own.astype(exact_type)
        left = ids[:, None] != x_ids[None, :]
        least = so_far[:, -1:]
        for segments, mine, theirs in zip(steps, q_levels, x_levels):
            count = counts.setdefault(segments, [0, 0])
            count[0] += np.count_nonzero(left)
            bound = np.full(left.shape, -np.inf)
            bound[left] = pairwise(mine, theirs, left)
            least = np.maximum(least, promising(own, x, bound, k))
            left &= bound >= least - 2 * slack
            count[1] += np.count_nonzero(left)
        score = pairwise(own, x, left)
        a, b = np.nonzero(left)
        order = np.lexsort((x_ids[b], -score, a))
        a, b, score = a[order], b[order], score[order]
        place = np.arange(len(a)) - np.searchsorted(a, np.arange(len(ids)))[a]
        # what only equals the last of the best so far may still win by its id
        top = (place < k) & (score >= so_far[a, -1])
        a, b, score, place = a[top], b[top], score[top], place[top]
        here = np.full(so_far.shape, -np.inf)
        here[a, place] = score
        so_far[:] = -np.sort(-np.concatenate([so_far, here], 1), 1)[:, :k]
        out.append((ids[a], x_ids[b], score.astype(np.int64)))
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (np.empty(0, np.int64),) * 3


def _searched(vectors: DataFrame, queries: DataFrame, k: int, scale: float, id_col: str, vector_col: str, report: bool) -> DataFrame:
    """What every task found (``query_id, vec_id, score``), or how many pairs each level met and left (``segments, met, left``)."""
    spark, schema = vectors.sparkSession, "length int, ids binary, numbers binary"

    def blocks(df: DataFrame, rows: int) -> DataFrame:
        pair = df.select(F.col(id_col).cast("long"), F.col(vector_col).cast("array<double>")).filter(F.col(vector_col).isNotNull())
        return pair.mapInArrow(lambda batches: scaled_blocks(batches, rows, scale), schema)

    count = queries.count()
    asked = snapshot(blocks(queries.repartition(max(1, -(-count // QUERY_BLOCK))), QUERY_BLOCK).withColumn("pass", F.monotonically_increasing_id()))
    numbered = asked.withColumn("_bytes", F.length("ids") + F.length("numbers")).select("pass", "_bytes")
    passes, room = [], 0
    for row in numbered.orderBy("pass").toLocalIterator():  # one small row per block of queries
        if not passes or room + row["_bytes"] > PASS_BYTES:
            passes.append([row["pass"], row["pass"]])
            room = 0
        room += row["_bytes"]
        passes[-1][1] = row["pass"]
    passes = passes or [[0, 0]]
    mine = blocks(vectors, VECTOR_BLOCK)
    names = ["segments", "met", "left"] if report else ["query_id", "vec_id", "score"]
    kinds = ", ".join(f"{n} bigint" for n in names)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, np.ndarray] = {}  # k numbers a query of this pass
        counts: dict[int, list[int]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                ids = [np.frombuffer(row[c], np.int64) for c in ("q_ids", "ids")]
                own = [np.frombuffer(row[c], np.float64).reshape(-1, row["length"]) for c in ("q_numbers", "numbers")]
                known = best.setdefault(row["pass"], np.full((len(ids[0]), k), -np.inf))
                found = best_of_block(ids[0], own[0], ids[1], own[1], known, counts)
                if not report:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names)
        if report:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*[(s, *c) for s, c in counts.items()])] or [pa.array([], pa.int64())] * 3, names)

    def one(first: int, last: int) -> DataFrame:
        some = asked.filter(F.col("pass").between(first, last)).select("pass", "length", F.col("ids").alias("q_ids"), F.col("numbers").alias("q_numbers"))
        return mine.join(F.broadcast(some), "length").mapInArrow(search, kinds)

    if len(passes) == 1:
        return one(*passes[0])
    # every pass is written, so the plan stays as small as that of one
    folder = scratch_path(spark, "passes")
    for first, last in passes:
        snapshot(one(first, last), f"{folder}/first={first}")
    return spark.read.schema(kinds).parquet(folder).select(*names)


def pruning(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """How well the bounds work on these vectors: ``segments, met, left``, the pairs that came to each level and those it left.

    A task without a block adds nothing; empty tables give an empty result.
    """
    found = _searched(vectors, queries, k, scale, id_col, vector_col, report=True)
    return found.groupBy("segments").agg(F.sum("met").alias("met"), F.sum("left").alias("left"))


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 5, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """The ``k`` rows with the highest inner product for every query: ``query_id, rank, vec_id, score``.

    Components become floor(scale * x) in doubles; scores are whole numbers (beyond 2^63 undefined).  A row is no
    candidate for a query with its own id.  Rows whose id or vector is null or empty, or holds a null or a
    non-finite component, take no part; vectors of different lengths never meet.  Ties go to the smaller id; of
    rows repeated with one id each counts.  Empty tables give an empty result; other columns are not looked at.
    """
    found = _searched(vectors, queries, k, scale, id_col, vector_col, report=False)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
