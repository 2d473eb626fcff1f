"""Exact top-k inner products by aggregation without random access.

Each component of a block of vectors is a sorted list. For a query, a list is read from the end that
scores most: from its largest values if the query's component is positive, else from its smallest. All
lists are read in step. A value read counts as it is; one not yet read lies between the list's far end
and the place reached, which gives every vector a lower and an upper bound. A vector whose upper bound
is below the k-th best lower bound can no longer qualify; once few are left, or the lists are nearly
read, the scores of those still open are resolved, and only theirs.

Bounds of all vectors for all queries of a block are two matrix products, since for a given depth
"value, or else the place reached" is one matrix for all queries.

The stated queries meet all vectors block by block: a grid of (vector block, query block) cells, each a
task of bounded size, none of which emits more than k rows a query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracewaste.llm.tables import written

K = 20
BLOCK_VECTORS = 2_048
BLOCK_QUERIES = 2_048
#: Parts of the lists read before each look at the bounds, and the part of a block worth resolving.
DEPTHS = (1 / 4, 1 / 2, 3 / 4, 7 / 8, 15 / 16)
RESOLVE = 1 / 16
EXACT = 2**53
CELL_DDL = "query_row long, query_id long, vec_id long, score long"


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Rows as an integer matrix; shorter vectors are filled up with zeros."""
    rows = [np.asarray(x, np.int64) for x in column.to_pylist()]
    out = np.zeros((len(rows), max(map(len, rows), default=0)), np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def _resolved(values, ids, query, candidates, k):
    """The k best of the candidates by exact score, ties to smaller ids."""
    scores = values[candidates] @ query
    best = np.lexsort((ids[candidates], -scores))[:k]
    return candidates[best], scores[best]


def best_in_block(values, ids, rows, queries, query_rows, k=K, seen=None):
    """(query, vector, score) index arrays: the k best rows of a block for each query, its own row left out.

    ``seen``, a dict, counts the (query, vector) pairs that bounds closed and those that were resolved.
    """
    n, m = len(values), len(queries)
    d = max(values.shape[1], queries.shape[1])
    values = np.pad(values, ((0, 0), (0, d - values.shape[1])))
    queries = np.pad(queries, ((0, 0), (0, d - queries.shape[1])))
    top = max([abs(int(x)) for x in (values.min(initial=0), values.max(initial=0))])
    most = max([abs(int(x)) for x in (queries.min(initial=0), queries.max(initial=0))])
    kind = np.float64 if top * most * max(d, 1) < EXACT else object
    values, queries = values.astype(kind), queries.astype(kind)
    out = []

    def resolve(query, candidates):
        if seen is not None:
            seen["resolved"] = seen.get("resolved", 0) + len(candidates)
            seen["closed"] = seen.get("closed", 0) + n - len(candidates)
        at, scores = _resolved(values, ids, queries[query], candidates, k)
        out.append((np.full(len(at), query), at, scores))

    active = np.arange(m)
    if kind is np.float64 and n > 4 * k and d:
        lists = np.sort(values, axis=0)
        gain, loss = np.maximum(queries, 0), np.minimum(queries, 0)
        for depth in DEPTHS:
            read = max(1, int(n * depth))
            falling, rising = lists[n - read], lists[read - 1]
            upper = gain[active] @ np.maximum(values, falling).T + loss[active] @ np.minimum(values, rising).T
            lower = gain[active] @ np.where(values >= falling, values, lists[0]).T
            lower += loss[active] @ np.where(values <= rising, values, lists[-1]).T
            own = query_rows[active][:, None] == rows[None, :]
            lower[own] = -np.inf
            bar = np.partition(lower, n - k, axis=1)[:, n - k]
            open_ = (upper >= bar[:, None]) & ~own
            done = (open_.sum(axis=1) <= max(k, n * RESOLVE)) | (depth == DEPTHS[-1])
            for row in np.flatnonzero(done):
                resolve(active[row], np.flatnonzero(open_[row]))
            active = active[~done]
            if not len(active):
                break
    for query in active:  # a block of few rows, or of scores beyond exact floats, is read to the end
        resolve(query, np.flatnonzero(rows != query_rows[query]))
    return tuple(np.concatenate(x) if out else np.zeros(0, np.int64) for x in (list(zip(*out, strict=True)) or [[]] * 3))


def _cell(vectors: pa.Table, queries: pa.Table) -> pa.Table:
    ids, query_ids = vectors["vec_id"].to_numpy(), queries["query_id"].to_numpy()
    rows, query_rows = vectors["row"].to_numpy(), queries["query_row"].to_numpy()
    if not len(ids) or not len(query_ids):
        which, at, score = (np.zeros(0, np.int64),) * 3
    else:
        which, at, score = best_in_block(_matrix(vectors["v"]), ids, rows, _matrix(queries["qv"]), query_rows)
    limit = 2**63 - 1
    return pa.table(
        {
            "query_row": query_rows[which],
            "query_id": query_ids[which],
            "vec_id": ids[at],
            "score": pa.array([max(-limit - 1, min(limit, int(s))) for s in score], pa.int64()),
        }
    )


def quantised(embedding: Column) -> Column:
    """floor(64 x) of every component; null for a vector that is null or has a null or non-finite one."""
    x = F.transform(embedding, lambda v: v.cast("double"))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.when(finite, F.transform(x, lambda v: F.floor(v * 64).cast("long")))


def nearest(embeddings: DataFrame, is_query: Column) -> DataFrame:
    """The K best rows for each query row by integer inner product, ties to smaller ids.

    Queries are the rows for which ``is_query`` (an expression on vec_id) holds; candidates are all rows
    but the query's own, other rows with its vec_id included. Rows whose vec_id is null, or whose vector is null or has a null or non-finite
    component, take no part. Shorter vectors count as filled up with zeros, an empty one scores 0.
    Repeated rows are candidates each and, as queries, answered each. Components and scores beyond 64
    bits stop at the border. Further columns play no part.
    """
    rows = written(
        embeddings.select(
            F.col("vec_id").cast("long").alias("vec_id"),
            quantised(F.col("embedding")).alias("v"),
            F.monotonically_increasing_id().alias("row"),
        ).filter("vec_id IS NOT NULL AND v IS NOT NULL"),
        "topk-vectors",
    )
    asked = rows.filter(is_query)
    size = rows.agg(F.count("*").alias("n"), F.count_if(is_query).alias("m")).first()
    blocks, query_blocks = -(-size["n"] // BLOCK_VECTORS) or 1, -(-size["m"] // BLOCK_QUERIES) or 1

    def dealt(table: Column, n: int) -> Column:
        return F.pmod(F.xxhash64(table), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    vectors = rows.select(
        "vec_id", "row", "v", dealt(F.col("row"), blocks).alias("b"), every(query_blocks).alias("c")
    )
    queries = asked.select(
        F.col("row").alias("query_row"),
        F.col("vec_id").alias("query_id"),
        F.col("v").alias("qv"),
        dealt(F.col("row"), query_blocks).alias("qc"),
        every(blocks).alias("qb"),
    )
    found = vectors.groupBy("b", "c").cogroup(queries.groupBy("qb", "qc")).applyInArrow(_cell, CELL_DDL)
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= K)
        .select("query_id", "rank", "vec_id", "score")
    )
