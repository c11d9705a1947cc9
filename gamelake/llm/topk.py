"""Exact top-k inner products (operator 2) in three phases with a uniform threshold.

The dimensions are cut into blocks, and each block gives every query a list of partial scores. Queries
and candidates meet in cells of bounded size (a stated query set against all rows, in blocks).

1. Each cell takes the highest entries of each list and sums up the totals of their candidates. The k-th
   highest of these over all cells is a safe cutoff: no smaller total is among the k best.
2. The cutoff goes back to the cells with each query. A candidate whose every partial score is under the
   cutoff's equal share per list cannot reach the cutoff; the entries at or above the share are collected.
3. The totals of those left, and of no others, are computed exactly; each cell sends its k best, which
   are ranked.

Scores of a list aren't kept between the phases (there are as many as pairs); each phase multiplies anew.
Equal vectors are one candidate (with its k + 1 smallest ids, more can't be needed) and one query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gamelake.llm.common import materialise

K, SCALE = 20, 64
#: Dimension blocks (lists of partial scores), and rows of queries and of candidates in one cell.
LISTS, QUERY_ROWS, CANDIDATE_ROWS = 2, 4096, 4096
#: Queries of a cell that are scored at once: at most 8 MB for each list.
AT_ONCE = 256


def integer_vectors(table: DataFrame) -> DataFrame:
    """vec_id, v (array of long): floor(64 x) of each component. Null ids and vectors that are null,
    empty or hold null or non-finite components are left out; of an id's vectors the smallest counts. Other
    columns are left out; an empty table gives an empty one."""
    x = F.col("embedding")
    ok = x.isNotNull() & (F.size(x) > 0) & F.forall(x, lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(float("inf")), F.lit(False)) & ~F.coalesce(F.isnan(c), F.lit(True)))
    v = F.transform(x, lambda c: F.floor(c.cast("double") * SCALE).cast("long"))
    return table.filter(F.col("vec_id").isNotNull() & ok).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks]) if column.num_chunks else np.empty(0)
    return flat.reshape(rows, -1)


def _exact(q: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles if no product or sum can leave the whole numbers that these hold, else as they are."""
    most = float(np.abs(q.astype(np.float64)).max(initial=0)) * float(np.abs(c.astype(np.float64)).max(initial=0)) * q.shape[1]
    return (q.astype(np.float64), c.astype(np.float64)) if most < 2.0**53 else (q, c)


def _lists(q: np.ndarray, c: np.ndarray) -> list[np.ndarray]:
    edges = np.linspace(0, q.shape[1], min(LISTS, q.shape[1]) + 1).astype(int)
    return [q[:, a:b] @ c[:, a:b].T for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _highest(scores: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k highest scores of each row."""
    k = min(k, scores.shape[1])
    return np.argpartition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k :]


def resolved(lists: list[np.ndarray], rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """The totals of the given entries."""
    return sum(p[rows, columns] for p in lists)


def top_k(table: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k highest integer inner products of each query of
    ``queries`` (vec_id, v) with the other ids of ``table`` (vec_id, v); all if there are fewer. Ties go to the
    smaller vec_id. Vectors of different lengths do not meet. Empty tables give no rows. Of repeated rows
    (same id and vector) one counts; ``integer_vectors`` leaves one vector of an id. Other columns are
    left out. Scores are exact as long as they, and all sums on the way, are below 2**63."""
    k1 = k + 1  # the query's own id may be among the first
    n = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    candidates = materialise(
        table.withColumn("n", n).filter(F.col("n") <= k1).groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(F.col("ids")[0].alias("c"), "v", "ids", F.size("v").alias("dim")), "candidates"
    )
    members = queries.select("vec_id", F.col("v").alias("qv"))
    asked = materialise(members.groupBy(F.col("qv").alias("v")).agg(F.min("vec_id").alias("q")).withColumn("dim", F.size("v")), "asked")
    nq, nc = (max(1, -(-df.count() // rows)) for df, rows in ((asked, QUERY_ROWS), (candidates, CANDIDATE_ROWS)))
    each = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    right = candidates.select("dim", each(nq).alias("qb"), F.pmod(F.xxhash64("c"), F.lit(nc)).cast("int").alias("cb"), "c", "v")

    def asked_in(df: DataFrame) -> DataFrame:
        return df.withColumn("qb", F.pmod(F.xxhash64("q"), F.lit(nq)).cast("int")).select("*", each(nc).alias("cb"))

    def meet(left: DataFrame, fn, schema: str) -> DataFrame:
        return asked_in(left).groupBy("dim", "qb", "cb").cogroup(right.groupBy("dim", "qb", "cb")).applyInArrow(fn, schema)

    def bounds(a: pa.Table, b: pa.Table) -> pa.Table:
        keys, best = [], []
        if a.num_rows and b.num_rows:
            ids = a["q"].to_numpy()
            q, c = _exact(_matrix(a["v"], a.num_rows), _matrix(b["v"], b.num_rows))
            for at in range(0, len(q), AT_ONCE):
                lists = _lists(q[at : at + AT_ONCE], c)
                seen = np.full(lists[0].shape, -np.inf)  # the totals of the lists' highest entries
                rows = np.arange(len(seen))[:, None]
                for p in lists:
                    high = _highest(p, k1)
                    seen[rows, high] = resolved(lists, rows, high)
                top = np.take_along_axis(seen, _highest(seen, k1), 1)
                keys.append(ids[at : at + AT_ONCE])
                best += top.tolist()
        return pa.table({"q": pa.array(np.concatenate([np.empty(0, np.int64), *keys])), "best": pa.array(best, pa.list_(pa.float64()))})

    found = materialise(meet(asked, bounds, "q long, best array<double>"), "bounds")
    one = found.select("q", F.explode("best").alias("b")).withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("b"))))
    cutoff = one.filter(F.col("n") <= k1).groupBy("q").agg(F.when(F.count("*") == k1, F.min("b")).alias("cutoff"))

    def resolve(a: pa.Table, b: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = [(np.empty(0, np.int64),) * 3]
        if a.num_rows and b.num_rows:
            q, c = _exact(_matrix(a["v"], a.num_rows), _matrix(b["v"], b.num_rows))
            ids, names = a["q"].to_numpy(), b["c"].to_numpy()
            order = np.argsort(names)  # ties of a cell then fall to the smaller id
            c, names = c[order], names[order]
            cut = np.array([-np.inf if x is None else x - abs(x) * 2.0**-50 for x in a["cutoff"].to_pylist()])
            for at in range(0, len(q), AT_ONCE):
                part = slice(at, at + AT_ONCE)
                lists = _lists(q[part], c)
                left = np.logical_or.reduce([p >= cut[part][:, None] / len(lists) for p in lists])
                rows, at_c = np.nonzero(left)
                exact = resolved(lists, rows, at_c)
                ends = np.searchsorted(rows, np.arange(len(left) + 1))
                for i in range(len(left)):
                    score, near = exact[ends[i] : ends[i + 1]], at_c[ends[i] : ends[i + 1]]
                    best = np.flatnonzero(score >= cut[part][i])
                    if len(best) > k1:
                        best = best[np.argsort(-score[best], kind="stable")[:k1]]
                    out.append((np.full(len(best), ids[at + i]), names[near[best]], score[best].astype(np.int64)))
        return pa.table({name: pa.array(np.concatenate([o[j] for o in out])) for j, name in enumerate(("q", "c", "score"))})

    sent = meet(asked.join(cutoff, "q"), resolve, "q long, c long, score long")
    first = sent.withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "c"))).filter(F.col("n") <= k1)
    rows = first.join(candidates.select("c", "ids"), "c").select("q", "score", F.explode("ids").alias("id"))
    ranked = rows.withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id"))).filter(F.col("n") <= k1)
    tops = ranked.groupBy("q").agg(F.transform(F.sort_array(F.collect_list(F.struct("n", "id", "score"))), lambda s: F.struct(s["id"].alias("id"), s["score"].alias("score"))).alias("top"))
    who = members.join(asked.select(F.col("v").alias("qv"), "q"), "qv").select(F.col("vec_id").alias("query_id"), "q")
    kept = who.join(tops, "q").select("query_id", F.slice(F.filter("top", lambda s: s["id"] != F.col("query_id")), 1, k).alias("top"))
    return kept.select("query_id", F.posexplode("top").alias("rank", "t")).select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("t.id").alias("vec_id"), F.col("t.score").alias("score"))
