"""Exact top-k by inner product with the no-random-access algorithm (NRA, Fagin, Lotem & Naor 2001).

The vectors are dealt into blocks of bounded size. A block keeps one list a dimension, its rows sorted by that component; an entry
carries the row, its component and the row's squared length. A query reads its lists in step, from the end that its own
component makes large. Every row has a lower and an upper bound: what was read of it, and of what is unread no more than the
lists' values at the reading depth, nor more or less than the product of what is left of the two lengths (Cauchy-Schwarz). The k-th best lower bound is the one to beat. Reading ends when all but a few rows cannot
reach it, or with the lists; the final scores of these few are then resolved. Blocks return k rows a query, so the
merge is a window over k rows for each query and block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import partitions, save

BLOCK_ROWS = 8192
#: Queries that search a block together: as many as leave TASKS tasks a partition, in these bounds.
BLOCK_QUERIES = (512, 8192)
TASKS = 4
EXACT = float(1 << 53)
#: Entries of a list that are read before the bounds are compared, as a part of the list.
STEP = 1 / 16
#: Reading stops when at most this many times k rows can still qualify.
LEFT = 16
#: Queries whose bounds are compared together.
QUERIES_AT_ONCE = 64
#: Queries whose bounds are compared at every depth, to find the depth at which those of the others are worth it.
FIRST = 8


def floored(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 256) -> DataFrame:
    """id, v: floor(scale * x) of every component as double; vectors null or with null or non-finite components go."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    usable = vectors.where(F.col(vec_col).isNotNull() & F.col(id_col).isNotNull()).where(F.forall(vec_col, finite))
    return usable.select(F.col(id_col).cast("long").alias("id"), F.transform(vec_col, lambda x: F.floor(x.cast("double") * scale).cast("double")).alias("v"))


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


class SortedLists:
    """One block: its rows' components, sorted for each dimension, ascending."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        self.ids, self.values = ids, values
        self.order = np.argsort(values, axis=0, kind="stable").T.copy()  # dimension x place -> row
        self.sorted = np.take_along_axis(values.T, self.order, axis=1)
        self.length2 = (values * values).sum(axis=1)

    def top(self, query: np.ndarray, k: int, own: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Rows (positions) of the k best by (score desc, id), without the row ``own``, and their scores."""
        return self._best(query, k, self._candidates(query, k, own))

    def tops(self, queries: np.ndarray, k: int, owns: list[int | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``top`` of every query, in their order."""
        for query, rows in zip(queries, self._candidates_of(queries, k, owns), strict=True):
            yield self._best(query, k, rows)

    def _best(self, query: np.ndarray, k: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        values = self.values[rows]
        scores = values @ query
        if np.abs(values).max(initial=0) * np.abs(query).max(initial=0) * max(len(query), 1) >= EXACT:
            scores = values.astype(np.int64) @ query.astype(np.int64)
        best = np.lexsort((self.ids[rows], -scores))[:k]
        return rows[best], scores[best]

    def _candidates(self, query: np.ndarray, k: int, own: int | None) -> np.ndarray:
        return self._candidates_of(query[None, :], k, [own])[0]

    def _candidates_of(self, queries: np.ndarray, k: int, owns: list[int | None]) -> list[np.ndarray]:
        """For each query, the rows that can be among its k best when its reading ends.

        A list is read from both ends, once for all queries: what was read lies in ``high`` and ``low``, and a query takes from each
        dimension the end that its own component makes large. The queries that can't stop yet go on to the next depth together. The bounds of
        most are first compared at the depth at which one of the first FIRST queries stops: reading on beyond need loses nothing.
        """
        n, width = self.values.shape
        out: list[np.ndarray | None] = [None] * len(queries)
        for i, own in enumerate(owns):
            if not queries[i].any() or n - (own is not None) <= LEFT * k:
                out[i] = np.arange(n) if own is None else np.delete(np.arange(n), own)
        open_ = np.array([i for i, found in enumerate(out) if found is None], dtype=np.int64)
        step, begun = max(1, int(n * STEP)), False
        high, low = np.zeros((width, n)), np.zeros((width, n))  # components read from the upper and the lower ends
        high_seen, low_seen = np.zeros((width, n), dtype=bool), np.zeros((width, n), dtype=bool)
        for depth in range(step, n, step):
            if not len(open_):
                break
            for read, seen, places in ((high, high_seen, slice(n - depth, n - depth + step)), (low, low_seen, slice(depth - step, depth))):
                np.put_along_axis(read, self.order[:, places], self.sorted[:, places], axis=1)
                np.put_along_axis(seen, self.order[:, places], True, axis=1)
            read, seen = np.concatenate([high, low]), np.concatenate([high_seen, low_seen]).astype(float)
            read2 = read * read
            stopped = np.zeros(len(open_), dtype=bool)
            for a in [0, *range(FIRST, len(open_), QUERIES_AT_ONCE)]:
                some = open_[a : a + (QUERIES_AT_ONCE if a else FIRST)]
                if a and not begun and not stopped.any():
                    break  # none of the first has stopped
                begun = begun or a > 0
                q = queries[some]
                sides = np.concatenate([np.maximum(q, 0), np.minimum(q, 0)], axis=1)
                q2 = (q * q).sum(axis=1)[:, None]
                front = np.maximum(sides * np.concatenate([self.sorted[:, n - depth], self.sorted[:, depth - 1]]), 0).sum(axis=1)[:, None]
                # what was read of each row: score, the query's and its own squared length; then what is left of the lengths
                score, left, left2 = sides @ read, (sides * sides) @ seen, (sides != 0).astype(float) @ read2
                # (sums in another order than the whole lengths': they may lack a little)
                np.maximum(np.subtract(q2 * (1 + 1e-9), left, out=left), 0, out=left)
                np.maximum(np.subtract(self.length2 * (1 + 1e-9), left2, out=left2), 0, out=left2)
                spread = np.sqrt(np.multiply(left, left2, out=left), out=left)
                spread *= 1 + 1e-9
                below = score - spread
                above = np.add(score, np.minimum(spread, front, out=spread), out=score)
                for j, own in enumerate(owns[i] for i in some.tolist()):
                    if own is not None:
                        below[j, own] = above[j, own] = -np.inf
                bar = np.partition(below, -k, axis=1)[:, -k]
                bar -= 1e-6 * np.maximum(1.0, np.abs(bar))
                can = above >= bar[:, None]
                for j in np.flatnonzero(can.sum(axis=1) <= LEFT * k).tolist():
                    out[some[j]], stopped[a + j] = np.flatnonzero(can[j]), True
            open_ = open_[~stopped]
        for i in open_.tolist():  # read to the end: all scores are final
            out[i] = np.arange(n) if owns[i] is None else np.delete(np.arange(n), owns[i])
        return out


def numbered(rows: DataFrame) -> DataFrame:
    """(id, v) -> + row, a number of its own for each row, so that rows of one id are told apart."""
    return save(rows.select("id", "v").withColumn("row", F.monotonically_increasing_id()), "vectors")


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 5, block_rows: int = BLOCK_ROWS, block_queries: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` best rows of ``vectors`` by inner product, ties to smaller ids.

    Both tables are (id, v, row) with whole-numbered components, as ``numbered(floored(...))`` returns, ``queries`` being rows of
    ``vectors`` or others with other row numbers. Every row of ``queries`` is a query, rows of one id too; only a query's own row is
    no candidate. Vectors of different lengths compare as if padded with zeros; an empty vector scores 0. Fewer than k candidates
    are all returned. Repeated rows are candidates each. Scores beyond 2**53 are summed as integers; beyond 2**63 they
    are undefined. Empty tables give an empty result.
    """
    spark = vectors.sparkSession
    n, m = vectors.count(), queries.count()
    blocks, parts = max(1, -(-n // block_rows)), partitions(spark)
    if block_queries is None:
        block_queries = min(max(-(-m * blocks // (TASKS * parts)), BLOCK_QUERIES[0]), BLOCK_QUERIES[1])
    sets = max(1, -(-m // block_queries))
    data = vectors.withColumn("b", F.pmod(F.xxhash64("row", F.lit(3)), F.lit(blocks))).withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(sets - 1))))
    asked = queries.withColumn("s", F.pmod(F.xxhash64("row", F.lit(5)), F.lit(sets)).cast("int")).withColumn("b", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    schema = {"query_id": "int64", "query_row": "int64", "vec_id": "int64", "score": "int64"}

    def search(own: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(rows):
            return pd.DataFrame({c: pd.Series(dtype=t) for c, t in schema.items()})
        width = max(own["v"].map(len).max(), rows["v"].map(len).max())
        rows = rows.sort_values(["id", "row"])
        lists, place = SortedLists(rows["id"].to_numpy(), _matrix(rows["v"], width)), {r: i for i, r in enumerate(rows["row"])}
        out = []
        every = lists.tops(_matrix(own["v"], width), k, [place.get(r) for r in own["row"]])
        for qid, row, (found, scores) in zip(own["id"].to_numpy(), own["row"].to_numpy(), every, strict=True):
            out.append((np.full(len(found), qid), np.full(len(found), row), lists.ids[found], scores.astype(np.int64)))
        return pd.DataFrame({name: np.concatenate([x[i] for x in out]) for i, name in enumerate(schema)})

    parts = max(parts, min(blocks * sets, 4096))
    asked, data = asked.repartition(parts, "s", "b"), data.repartition(parts, "s", "b")
    found = asked.groupBy("s", "b").cogroup(data.groupBy("s", "b")).applyInPandas(search, ", ".join(f"{c} long" for c in schema))
    best = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2_query(spark, sf_dir):
    rows = numbered(floored(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))
    return top_k(rows.where("id % 50 = 0"), rows)


OP2_SQL = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score FROM s
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5"""
