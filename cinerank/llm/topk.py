"""Exact top-k by inner product: a ball tree per shard, branch and bound, a shared kth score.

Rows are dealt to shards by a hash of their id, so copies of one vector spread evenly.
In a first wave every shard scores, for each query, only the leaf with the highest
bound; the kth best score over all shards is shared with all of them.  In the second
wave each shard visits its leaves in the order of their bounds until the next bound is
below the kth score, its own or the shared one.  A ball with centre c and radius r
bounds the inner product with q by q.c + |q| r.

Scores are exact integers of any size: between tasks they travel as texts that sort as the
integers do (:func:`sortable`).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from cinerank.config import materialize
from cinerank.llm.common import buckets_for

SHARD = 16_384           # vectors in one tree
QUERY_BLOCK = 4_096      # queries that meet a shard in one task
LEAF = 256
EXACT = 2.0 ** 53        # integers below this are exact in a double
HITS = "query_id long, vec_id long, score string"
DIGITS, NINES = "0123456789", "9876543210"


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component, as a double, which holds it exactly: from 2**53
    on a double is a whole number itself."""
    def floor(y: Column) -> Column:
        return F.when(F.abs(y) < EXACT, F.floor(y).cast("double")).otherwise(y)
    return F.transform(vector, lambda x: floor(x.cast("double") * scale))


def sortable(n: int) -> str:
    """Sign, number of digits and digits, those of a negative number by their complements to nine."""
    digits = str(abs(n))
    if n >= 0:
        return f"1{len(digits):04d}{digits}"
    return f"0{9999 - len(digits):04d}{digits.translate(str.maketrans(DIGITS, NINES))}"


def from_sortable(text: str) -> int:
    return int(text[5:]) if text[0] == "1" else -int(text[5:].translate(str.maketrans(DIGITS, NINES)))


def _number(text: Column) -> Column:
    """The decimal digits of a sortable text."""
    digits = F.substr(text, F.lit(6))
    return F.when(F.startswith(text, F.lit("1")), digits).otherwise(F.concat(F.lit("-"), F.translate(digits, DIGITS, NINES)))


def finite(vector: Column) -> Column:
    """Neither null nor holding null, NaN or infinite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & ~bad


class BallTree:
    """Nodes in breadth-first order; every split halves a node by rank along the line
    between two far points, so equal vectors split as well as others."""

    def __init__(self, points: np.ndarray, leaf: int) -> None:
        parts, parents, self.leaves = [np.arange(len(points))], [0], []
        i = 0
        while i < len(parts):
            own = parts[i]
            if len(own) > leaf:
                x = points[own]
                far = x[((x - x.mean(0)) ** 2).sum(1).argmax()]
                other = x[((x - far) ** 2).sum(1).argmax()]
                order = np.argsort(x @ (other - far), kind="stable")
                half = len(own) // 2
                parts += [own[order[:half]], own[order[half:]]]
                parents += [i, i]
            else:
                self.leaves.append(i)
            i += 1
        self.parts, self.parents = parts, parents
        self.centres = np.stack([points[p].mean(0) for p in parts])
        self.radii = np.array([np.sqrt(((points[p] - c) ** 2).sum(1).max()) for p, c in zip(parts, self.centres)])

    def leaf_bounds(self, queries: np.ndarray) -> np.ndarray:
        """Upper bounds (queries x leaves): the least bound on the way from the root."""
        norms = np.sqrt((queries ** 2).sum(1))
        bound = queries @ self.centres.T + norms[:, None] * self.radii[None, :]
        bound += 1e-6 + 1e-9 * (norms[:, None] * (np.sqrt((self.centres ** 2).sum(1)) + self.radii)[None, :])
        for i in range(1, len(self.parents)):
            np.minimum(bound[:, i], bound[:, self.parents[i]], out=bound[:, i])
        return bound[:, self.leaves]


def _products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in doubles where every sum stays below 2**53, else
    in Python integers."""
    if q.size and v.size and float(np.abs(q).max()) * float(np.abs(v).max()) * q.shape[1] >= EXACT:
        whole = np.frompyfunc(int, 1, 1)
        return whole(q) @ whole(v).T
    return (q @ v.T).astype(np.int64)


def search(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, kth: list[int | None], k: int,
           visits: int | None, leaf: int = LEAF) -> Iterator[tuple[int, int, int]]:
    """(query id, vector id, score) of up to ``k`` best candidates of this shard for each
    query, none below its ``kth`` (None: no bound yet).  ``visits`` limits the leaves a
    query sees (first wave); None searches to the proven end."""
    tree = BallTree(vectors, leaf)
    bounds = tree.leaf_bounds(queries)
    order = np.argsort(-bounds, axis=1, kind="stable")
    best: list[list[tuple[int, int]]] = [[] for _ in query_ids]
    exact = np.array([-np.inf if x is None else x for x in kth], dtype=object)
    floor = exact.astype(float)      # enough against bounds, which leave room, and against scores below 2**53
    active = np.arange(len(query_ids))
    unique = len(np.unique(ids)) == len(ids)
    for step in range(min(len(tree.leaves), visits or len(tree.leaves))):
        at = order[active, step]
        going = bounds[active, at] >= floor[active]
        active, at = active[going], at[going]
        if not len(active):
            break
        for leaf_no in np.unique(at):
            rows = active[at == leaf_no]
            own = tree.parts[tree.leaves[leaf_no]]
            scores = _products(queries[rows], vectors[own])
            least = exact if scores.dtype == object else floor
            for r in np.nonzero((scores >= least[rows][:, None]).any(1))[0]:
                row, s = rows[r], scores[r]
                hit = np.nonzero(s >= least[row])[0]
                if unique and len(hit) > 4 * k:
                    cut = np.partition(s[hit], len(hit) - k - 1)[len(hit) - k - 1]      # one more: the query's own row
                    hit = hit[s[hit] >= cut]
                own_ids = ids[own[hit]]
                found = [(-int(x), int(i)) for x, i in zip(s[hit], own_ids) if i != query_ids[row]]
                once: dict[int, int] = {}
                for neg, i in sorted(best[row] + found):
                    once.setdefault(i, neg)
                best[row] = [(neg, i) for i, neg in list(once.items())[:k]]
                if len(best[row]) == k:
                    exact[row] = max(exact[row], -best[row][-1][0])
                    floor[row] = float(exact[row])
    for q, hits in zip(query_ids, best):
        for s, i in hits:
            yield int(q), i, -s


def _search_group(k: int, visits: int | None):
    def run(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        hits = []
        if len(vectors) and len(queries) and len(vectors["v"].iloc[0]):
            hits = list(search(vectors["id"].to_numpy(np.int64), np.stack(vectors["v"].to_list()),
                               queries["qid"].to_numpy(np.int64), np.stack(queries["qv"].to_list()),
                               [None if pd.isna(x) else from_sortable(x) for x in queries["kth"]], k, visits))
        found = [(q, i, sortable(x)) for q, i, x in hits]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64"})
    return run


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    once = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = W.Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 50, k: int = 5,
          shard: int = SHARD, query_block: int = QUERY_BLOCK, score_type: str = "long") -> DataFrame:
    """query_id, rank, vec_id, score for every row whose id is divisible by ``every``.

    * Candidates are all rows but those with the query's id; ties go to the smaller id.
    * Rows with a null id, a null vector or a null or non-finite component take no part;
      vectors meet queries of their own length only; empty vectors have no candidates.
    * Repeated rows count once; an id with several vectors counts with its best score.
    * Scores are ranked exactly whatever their size.  A listed one that ``score_type`` cannot
      hold is an error; ``"string"`` holds all.
    * Fewer than ``k`` candidates: all of them.  Empty table: empty result; other columns
      are ignored."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("raw"))
    whole = rows.filter(F.col("id").isNotNull() & finite(F.col("raw")))
    data = materialize(whole.select("id", quantised(F.col("raw")).alias("v")).distinct(), "vectors")
    asked = F.col("id") % every == 0
    n = data.agg(F.count(F.lit(1)).alias("all"), F.count_if(asked).alias("asked")).first()
    shards, blocks = buckets_for(n["all"], shard), buckets_for(n["asked"], query_block)
    seq = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    at, at_query = ["dim", "shard", "block"], ["qdim", "qshard", "qblock"]
    dealt = data.select("id", "v", F.size("v").alias("dim"), F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"),
                        seq(blocks).alias("block"))
    queries = data.filter(asked).select(F.col("id").alias("qid"), F.col("v").alias("qv"), F.size("v").alias("qdim"),
                                        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int").alias("qblock"))

    def wave(kth: DataFrame | None, visits: int | None) -> DataFrame:
        q = queries.withColumn("kth", F.lit(None).cast("string")) if kth is None else queries.join(kth, "qid", "left")
        q = q.select("qid", "qv", "qdim", "qblock", "kth", seq(shards).alias("qshard"))
        return dealt.groupBy(*at).cogroup(q.groupBy(*at_query)).applyInPandas(_search_group(k, visits), HITS)

    first = materialize(wave(None, 1), "first-wave")
    shared = _ranked(first, k).filter(F.col("rank") == k).select(
        F.col("query_id").alias("qid"), F.col("score").alias("kth"))
    found = _ranked(wave(shared, None).unionByName(first), k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id",
                        _number(F.col("score")).cast(score_type).alias("score"))
