"""Exact top-k search by inner product (operator 6): columnar branch and bound.

Queries go out in blocks of a fixed number; each task walks its candidates in vertical layout (one row a dimension),
adds up scores dimension block by dimension block, and after each block keeps only candidates whose score so far plus
the Cauchy-Schwarz bound of the remaining dimensions can still reach the query's (k+1)-th best. One of these k+1 may be
the query's own row, which is taken out at the end: rows of its id and score are alike in the result, so one of them
goes. Each task sends k+1 rows a query at most; these are merged by rank. Each block's result is written before the next
block goes out, so plans and broadcasts stay as small as one block's.

Defined cases: vectors that are null or hold null or non-finite components, and rows without an id, take no part (a
component whose scaled value is beyond doubles counts as not finite); a vector without components takes part among such;
vectors are compared with those of their own length only; every row whose id asks is a query of its own, and other rows
of its id are candidates like all others; ties go to the smaller id; scores beyond 64 bits are held at the largest long;
an empty table gives no rows; extra columns play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.session import cut

SCALE, BLOCK_DIMS, QUERY_BLOCK = 1024, 16, 4096
_LONG = (1 << 63) - 1


def quantise(batch: pa.RecordBatch, scale: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(ids, whole-number vectors as float64) for each vector length in the batch, without vectors that take no part."""
    ids, lists = batch["id"], batch["vec"]
    out: dict[int, tuple[list, list]] = {}
    if not batch.num_rows:
        return []
    flat = lists.flatten()
    if not lists.null_count and not flat.null_count and not ids.null_count:
        size = np.diff(np.asarray(lists.offsets))
        if len(set(size.tolist())) == 1:
            with np.errstate(over="ignore"):
                x = np.floor(np.asarray(flat, np.float64).reshape(len(ids), size[0]) * scale)
            good = np.isfinite(x).all(axis=1)
            return [(np.asarray(ids)[good], x[good])]
    for i, v in zip(ids.to_pylist(), lists.to_pylist(), strict=True):
        if i is None or v is None or any(c is None for c in v):
            continue
        with np.errstate(over="ignore"):
            x = np.floor(np.asarray(v, np.float64) * scale)
        if np.isfinite(x).all():
            mine = out.setdefault(len(x), ([], []))
            mine[0].append(i)
            mine[1].append(x)
    return [(np.asarray(a, np.int64), np.asarray(b)) for a, b in out.values()]


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    if len(ids) > 4 * k:
        cut_at = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = scores >= cut_at
        ids, scores = ids[near], scores[near]
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


class Search:
    """Running top k of a block of queries of one length over candidates that come in pieces, own rows included."""

    def __init__(self, numbers: np.ndarray, vectors: np.ndarray, k: int):
        self.numbers, self.q, self.k = numbers, vectors, k
        self.top = [(np.empty(0, np.int64), np.empty(0))] * len(numbers)
        dims = vectors.shape[1]
        self.cuts = [0, *range(BLOCK_DIMS, dims, BLOCK_DIMS), dims]
        self.rest = [np.sqrt((vectors[:, a:] ** 2).sum(axis=1)) for a in self.cuts[1:]]

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        if np.abs(vectors).max(initial=0) * np.abs(self.q).max(initial=0) * vectors.shape[1] >= 2**52:
            return self._add_exact(ids, vectors)
        vertical = np.ascontiguousarray(vectors.T)
        rest = [np.sqrt((vertical[a:] ** 2).sum(axis=0)) for a in self.cuts[1:]]
        seed = vectors[: 16 * self.k]
        seeds = self.q @ seed.T
        head = self.q[:, : self.cuts[1]] @ vertical[: self.cuts[1]]
        for i in range(len(self.numbers)):
            tops, scores = self.top[i]
            floor = scores[-1] if len(scores) >= self.k else -np.inf
            if len(seed) >= self.k:
                floor = max(floor, np.partition(seeds[i], len(seed) - self.k)[len(seed) - self.k])
            alive, score = np.arange(len(ids)), head[i]
            for b in range(len(self.cuts) - 1):
                if b:
                    a, z = self.cuts[b], self.cuts[b + 1]
                    score = score + self.q[i, a:z] @ vertical[a:z, alive]
                bound = self.rest[b][i] * rest[b][alive]
                keep = score + bound * (1 + 1e-9) + 1e-3 >= floor
                if not keep.all():
                    alive, score = alive[keep], score[keep]
            self.top[i] = _best(np.concatenate([tops, ids[alive]]), np.concatenate([scores, score]), self.k)

    def _add_exact(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Components too large for exact float64 sums: whole numbers of any size."""
        whole = [[int(x) for x in v] for v in vectors]
        for i, q in enumerate(self.q):
            mine = [int(x) for x in q]
            score = [float(max(-_LONG, min(_LONG, sum(a * b for a, b in zip(mine, v, strict=True))))) for v in whole]
            tops, scores = self.top[i]
            self.top[i] = _best(np.concatenate([tops, ids]), np.concatenate([scores, np.asarray(score)]), self.k)


def _search(block, k: int, scale: int):
    def run(batches):
        searches = {q.shape[1]: Search(numbers, q, k) for numbers, q in block.value}
        for b in batches:
            for ids, vectors in quantise(b, scale):
                if (s := searches.get(vectors.shape[1])) is not None:
                    s.add(ids, vectors)
        for s in searches.values():
            n = [len(t[0]) for t in s.top]
            if sum(n):
                score = [max(-_LONG, min(_LONG, int(x))) for t in s.top for x in t[1].tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(s.numbers, n)), pa.array(np.concatenate([t[0] for t in s.top])), pa.array(score, pa.int64())], ["number", "vec_id", "score"])

    return run


def _own(vector: np.ndarray) -> int:
    """A vector's score against itself, as candidates' scores are held."""
    if np.abs(vector).max(initial=0) ** 2 * len(vector) < 2**52:
        return int(vector @ vector)
    return min(_LONG, int(float(min(_LONG, sum(int(x) ** 2 for x in vector)))))


def exact_topk(vectors: DataFrame, queries: Column, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all other rows for each row that the condition `queries` picks."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"), queries.alias("asks"))
    # rows alike in id and vector ask once, and their result is repeated
    asking = cut(rows.where("asks and id is not null and vec is not null").groupBy("id", "vec").agg(F.count("*").alias("times")))
    blocks, found = max(1, -(-asking.count() // query_block)), None
    schema = "query_id long, rank int, vec_id long, score long"
    for b in range(blocks):  # one pass over the candidates for each block; a block has a bounded size
        part = asking.where(F.pmod(F.xxhash64("id", "vec"), F.lit(blocks)) == b).toArrow().combine_chunks()
        here = cut(_answers(rows, part, k, scale))
        found = here if found is None else found.unionByName(here)
    return found if found is not None else spark.createDataFrame([], schema)


def _answers(rows: DataFrame, asking: pa.Table, k: int, scale: int) -> DataFrame:
    """The results of one block of queries (id, vec, times)."""
    spark = rows.sparkSession
    numbered = asking.append_column("number", pa.array(np.arange(asking.num_rows), pa.int64()))
    block = _merged(x for batch in numbered.select(["number", "vec"]).rename_columns(["id", "vec"]).to_batches() for x in quantise(batch, scale))
    ids, times = asking["id"].to_pylist(), asking["times"].to_pylist()
    own = [(n, ids[n], _own(v), times[n]) for numbers, q in block for n, v in zip(numbers.tolist(), q, strict=True)]
    asked = F.broadcast(spark.createDataFrame(own, "number long, query_id long, own long, times long"))  # as many as the block has
    near = rows.select("id", "vec").mapInArrow(_search(spark.sparkContext.broadcast(block), k + 1, scale), "number long, vec_id long, score long")
    order = Window.partitionBy("number").orderBy(F.desc("score"), "vec_id")
    best = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k + 1).join(asked, "number")
    itself = F.min(F.when((F.col("vec_id") == F.col("query_id")) & (F.col("score") == F.col("own")), F.col("rank"))).over(Window.partitionBy("number"))
    best = best.withColumn("at", F.coalesce(itself, F.lit(k + 1))).where(F.col("rank") != F.col("at"))
    best = best.withColumn("rank", F.when(F.col("rank") > F.col("at"), F.col("rank") - 1).otherwise(F.col("rank")))
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("copy")).drop("copy")


def _merged(pieces) -> list[tuple[np.ndarray, np.ndarray]]:
    """Queries of one length together, whatever batches they came in."""
    by: dict[int, list] = {}
    for ids, q in pieces:
        by.setdefault(q.shape[1], []).append((ids, q))
    return [(np.concatenate([i for i, _ in x]), np.concatenate([q for _, q in x])) for x in by.values()]
