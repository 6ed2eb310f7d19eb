"""Exact top-k inner products by a uniform threshold in three phases.

Vectors become integers, ``floor(scale * x)``, and lie in blocks of rows; the dimensions are cut into
slices, and each slice of a block is one holder of local scores.

1. Every holder names its best ``k`` entries for each query. The ``k``-th best total among all that were
   named is a cutoff that no answer can be below.
2. The cutoffs go to all blocks. Local scores are counted from the lowest one of their slice, so that all
   are at least zero; whoever reaches the cutoff has a slice that reaches the cutoff divided by the number
   of slices, and those entries are collected. An entry whose slices, missing ones taken at that share,
   cannot add up to the cutoff is dropped.
3. The rest are scored exactly and the best ``k`` of each query stay.

Queries are a stated share of the rows and are compared with all rows in blocks, whose matrices are the only
thing held in memory; what moves afterwards is at most ``k`` rows for a query and block. Results are the same
for every block and slice size.

Rows without an id, and vectors that are null or hold null or non-finite components, take no part. Only
vectors of one length are compared. A row is no answer to a query of its id, so repeated rows of a query's id
are not either. Repeated rows of another id count singly. Ties go to the smaller id. Scores are exact as long
as they fit a long; components beyond 2^62 count as 2^62.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmart.llm.tables import in_tasks, written

BLOCK = "block long, dim int, ids binary, numbers binary"
FOUND = "query_id long, vec_id long, score long"
QUERIES_AT_ONCE = 128


def _blocks(scale: float, rows: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        waiting: dict[int, list] = {}

        def emit(dim: int, taken: list):
            nonlocal number
            number += 1
            ids = np.concatenate([x[0] for x in taken]).astype("<i8")
            numbers = np.concatenate([x[1] for x in taken]).astype("<i8")
            return pa.RecordBatch.from_pydict(
                {"block": [number], "dim": pa.array([dim], pa.int32()), "ids": [ids.tobytes()], "numbers": [numbers.tobytes()]}
            )

        for batch in batches:
            for dim, ids, numbers in integers(batch.column(0), batch.column(1), scale):
                taken = waiting.setdefault(dim, [])
                taken.append((ids, numbers))
                have = sum(len(x[0]) for x in taken)
                while have >= rows:
                    ids, numbers = (np.concatenate([x[i] for x in taken]) for i in (0, 1))
                    yield emit(dim, [(ids[:rows], numbers[:rows])])
                    taken[:] = [(ids[rows:], numbers[rows:])]
                    have -= rows
        for dim, taken in waiting.items():
            if any(len(x[0]) for x in taken):
                yield emit(dim, taken)

    return make


def integers(ids: pa.Array, vectors: pa.Array, scale: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per vector length, the ids and integer vectors of the rows that take part."""
    n = len(ids)
    known = np.asarray(ids.is_valid()) & np.asarray(vectors.is_valid())
    vectors = vectors.cast(pa.large_list(pa.float64()))
    at = np.frombuffer(vectors.buffers()[1], np.int64)[vectors.offset : vectors.offset + n + 1] if n else np.zeros(1, np.int64)
    flat = vectors.values.to_numpy(zero_copy_only=False)  # null components turn into nan
    lengths = np.diff(at)
    id_values = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    for dim in np.unique(lengths[known]):
        rows = np.flatnonzero(known & (lengths == dim))
        matrix = flat[at[rows][:, None] + np.arange(dim)] if dim else np.zeros((len(rows), 0))
        good = np.isfinite(matrix).all(axis=1)
        with np.errstate(over="ignore", invalid="ignore"):
            numbers = np.clip(np.floor(matrix[good] * scale), -(2.0**62), 2.0**62).astype(np.int64)
        if good.any():
            yield int(dim), id_values[rows[good]], numbers


def _matrix(ids: bytes, numbers: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    keys = np.frombuffer(ids, "<i8")
    return keys, np.frombuffer(numbers, "<i8").reshape(len(keys), dim)


def _locals(q: np.ndarray, c: np.ndarray, slices: int) -> list[np.ndarray]:
    """The local scores of each slice of the dimensions; floats only where they are exact."""
    dim = q.shape[1]
    top = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, dim)
    kind = np.float64 if top < 2.0**53 else np.int64
    edges = np.linspace(0, dim, slices + 1).astype(int)
    q, c = q.astype(kind), c.astype(kind)
    return [q[:, a:b] @ c[:, a:b].T for a, b in zip(edges, edges[1:], strict=False)]


def _best(scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the ``k`` best allowed scores of each row, smaller ids first among equals."""
    n = scores.shape[1]
    if n > k:
        least = np.where(allowed, scores.astype(np.float64), -np.inf)
        allowed = allowed & (least >= np.partition(least, n - k, axis=1)[:, [n - k]])
    rows, columns = np.nonzero(allowed)
    order = np.lexsort((ids[columns], -scores[rows, columns], rows))
    rows, columns = rows[order], columns[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    return rows[place < k], columns[place < k]


def _gather(k: int, slices: int):
    """Phase 1 on one pair of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                query_ids, queries = _matrix(row["q_ids"], row["q_numbers"], row["dim"])
                ids, numbers = _matrix(row["ids"], row["numbers"], row["dim"])
                for lo in range(0, len(query_ids), QUERIES_AT_ONCE):
                    own = query_ids[lo : lo + QUERIES_AT_ONCE]
                    local = _locals(queries[lo : lo + QUERIES_AT_ONCE], numbers, slices)
                    total, other = sum(local), ids != own[:, None]
                    named = np.zeros(other.shape, bool)
                    for scores in local:
                        named[_best(scores, other, ids, k)] = True
                    rows, columns = _best(total, named, ids, k)
                    out = {"query_id": own[rows], "vec_id": ids[columns], "score": total[rows, columns].astype(np.int64)}
                    low = [x.min(axis=1).astype(np.int64)[rows] for x in local]
                    yield pa.RecordBatch.from_pydict(out | {f"low{j}": x for j, x in enumerate(low)})

    return run


def _resolve(k: int, slices: int):
    """Phases 2 and 3 on one pair of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                query_ids, queries = _matrix(row["q_ids"], row["q_numbers"], row["dim"])
                ids, numbers = _matrix(row["ids"], row["numbers"], row["dim"])
                known = {x["query_id"]: x for x in row["cutoffs"]}
                lowest = -(2.0**63)
                cut = np.array([x["cutoff"] if (x := known.get(i)) and x["cutoff"] is not None else lowest for i in query_ids.tolist()], float)
                low = np.array([[known[i][f"low{j}"] if i in known else lowest for j in range(slices)] for i in query_ids.tolist()], float).reshape(-1, slices)
                for lo in range(0, len(query_ids), QUERIES_AT_ONCE):
                    some = slice(lo, lo + QUERIES_AT_ONCE)
                    local = _locals(queries[some], numbers, slices)
                    need = cut[some] - low[some].sum(axis=1)
                    share = (need / slices)[:, None]
                    # Rounded bounds may keep an entry too many, never one too few.
                    slack = 1e-9 * np.abs(need)[:, None] + 1
                    bound = np.zeros(local[0].shape)
                    sent = np.zeros(local[0].shape, bool)
                    for j, scores in enumerate(local):
                        lifted = scores - low[some, j][:, None]
                        here = lifted >= share - slack
                        sent |= here
                        bound += np.where(here, lifted, share)
                    open_ = sent & (bound >= need[:, None] - slack) & (ids != query_ids[some][:, None])
                    rows, columns = np.nonzero(open_)
                    total = np.zeros(open_.shape, local[0].dtype)
                    total[rows, columns] = sum(x[rows, columns] for x in local)
                    open_[rows, columns] = total[rows, columns] >= cut[some][rows]
                    rows, columns = _best(total, open_, ids, k)
                    yield pa.RecordBatch.from_pydict(
                        {"query_id": query_ids[some][rows], "vec_id": ids[columns], "score": total[rows, columns].astype(np.int64)}
                    )

    return run


def exact_topk(
    vectors: DataFrame,
    queries: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    k: int = 10,
    scale: float = 1024.0,
    slices: int = 4,
    block_rows: int = 8192,
    query_rows: int = 2048,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` best rows of ``vectors`` for each row of ``queries``."""
    pick = [F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("vector")]
    candidates = written(in_tasks(vectors.select(*pick), _blocks(scale, block_rows), BLOCK), "topk-rows")
    asked = queries.select(*pick).where("id is not null")
    parts = max(1, -(-asked.count() // query_rows))
    asked = in_tasks(asked.repartition(parts, "id"), _blocks(scale, query_rows), BLOCK)
    asked = written(asked, "topk-queries").withColumnsRenamed({"block": "q_block", "ids": "q_ids", "numbers": "q_numbers"})

    # Pairs of block numbers first, the matrices by number.
    pairs = candidates.select("block", "dim").join(asked.select("q_block", "dim"), "dim").select("block", "q_block")
    both = pairs.join(candidates, "block").join(asked.drop("dim"), "q_block")

    lows = [f"low{j}" for j in range(slices)]
    named = in_tasks(both, _gather(k, slices), FOUND + "".join(f", {x} long" for x in lows))
    named = written(named, "topk-named")
    best_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    cutoffs = (
        named.withColumn("place", F.row_number().over(best_first)).where(F.col("place") <= k)
        .groupBy("query_id").agg(F.max(F.when(F.col("place") == k, F.col("score"))).alias("cutoff"))
    )
    cutoffs = cutoffs.join(named.groupBy("query_id").agg(*(F.min(x).alias(x) for x in lows)), "query_id")
    # A block's queries are at most query_rows rows.
    listed = in_tasks(asked.select("q_block", "q_ids"), _listed, "q_block long, query_id long").distinct()
    cutoffs = (
        listed.join(cutoffs, "query_id").groupBy("q_block")
        .agg(F.collect_list(F.struct("query_id", "cutoff", *lows)).alias("cutoffs"))
    )
    both = both.join(written(cutoffs, "topk-cutoffs"), "q_block")
    found = in_tasks(both, _resolve(k, slices), FOUND)
    return (
        found.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            keys = np.frombuffer(ids, "<i8")
            yield pa.RecordBatch.from_pydict({"q_block": np.full(len(keys), block), "query_id": keys})
