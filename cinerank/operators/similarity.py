"""Item-to-item similarity without a full cross product.

Dense vectors (embeddings, ALS factors, hashed TF-IDF)
    Vectors are normalised once in Spark (and written, cutting lineage), then
    dealt into about B blocks of at most ``block_size`` items, by nearest pivot where a
    cosine threshold is given: block pairs whose angles rule out every score above it
    are never formed.  Every vector is replicated to the block pairs it belongs to and
    ``groupBy(pair).applyInPandas`` multiplies the two blocks with NumPy, in
    row chunks.  A group holds exactly two blocks and the score matrix is
    built chunk x block at a time, so memory per task is bounded by
    ``block_size`` whatever the catalogue size; shuffle volume is the input
    times B, and the work is spread over B(B+1)/2 independent tasks.
    Thresholds and per-row top-k are applied inside the block pair; a final
    window merges the per-pair top-k, which is exact because the final order
    (score desc, id asc) is a total order.  Without k, a row's results of a block pair
    move packed in one record (:func:`pack_results`) to the task that ranks its list.

Sparse vectors (exact-vocabulary TF-IDF)
    Blocks by hash; inside a block pair common terms are a dense product and
    meetings of rare ones are added up (NumPy).  No term-level self-join: pairs sharing a hot
    term are never emitted as rows, only each row's result.  Pairs that share
    no term score 0 and are not produced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.config import FIXED_DIGITS, SCORE_DIGITS, materialize, parallelism
from cinerank.functions.columns import dot, l1_norm, l2_norm, scale_array
from cinerank.operators.blocktop import best_products, round_half_away
from cinerank.operators.topk import by_score, nest_ranked, rank_within

PAIR_SCHEMA = "mid int, rec_mid int, score double"
ANGLE_MARGIN = 1e-6   # radians: more than the noise of an arc cosine near 1
PLAIN_BLOCK = 4096    # vectors of a block whose score matrix is kept in chunks
BLOCK_CELLS = 1 << 20  # components of a block of which only each row's best are kept
LEAST_BLOCK = 32      # smaller blocks cost more to start than to multiply
HEAVY_ROW_FACTOR = 4  # rows with more candidates than this many times k are partitioned first
PACKED_SCHEMA = "unit int, mid int, n int, packed array<binary>"
RANKED_SCHEMA = "mid int, rank int, rec_mid int, score double"
LIST_BLOCK_CELLS = 1 << 21  # components of a block of which all results are kept: fewer blocks, longer records
CHUNK_CELLS = 1 << 22  # cells of the score matrix made at a time where all results are kept
LIST_CELLS = 1 << 23  # cells of the rows ranked by one call, however many of them are results
PART_CELLS = 1 << 30  # cells of the rows ranked in one partition: its packed results need no spill


def _normalised(vectors: DataFrame, id_col: str, vec_col: str, metric: str) -> DataFrame:
    v = F.col(vec_col).cast("array<double>")
    l2 = l2_norm(v)
    right = F.when(l2 > 0, scale_array(v, 1.0 / l2)).otherwise(F.transform(v, lambda x: x * 0.0))
    if metric == "cosine":
        left = right
    elif metric == "l1l2":
        l1 = l1_norm(v)
        left = F.when(l1 > 0, scale_array(v, 1.0 / l1)).otherwise(F.transform(v, lambda x: x * 0.0))
    else:
        raise ValueError(f"unknown metric {metric!r}")
    return vectors.select(F.col(id_col).cast("int").alias("id"), left.alias("lhs"), right.alias("rhs"))


def _select(raw: np.ndarray, k: int | None, min_score: float | None, digits: int):
    """Exact row-wise selection: the threshold on raw scores, the ranking on rounded ones,
    rounding only candidates.

    ``raw`` holds unrounded scores (NaN = excluded pair), columns in
    ascending id order.  A score passes ``min_score`` (strict) at FIXED_DIGITS
    decimals, so a score a little above it stays even where it rounds to it.
    Rounding moves a value by at most h = half a unit of the last digit, so an
    entry can only be in a row's rounded top-k if its raw score is within 2h of
    the row's k-th best raw score.  Those candidates are rounded and cut exactly
    by (score desc, column asc); ties at the boundary go to the lowest ids,
    never more than k per row.
    Returns (row_idx, col_idx, rounded_scores)."""
    h = 0.5 * 10.0 ** -digits
    margin = 2.2 * h
    mask = np.isfinite(raw)
    if min_score is not None:
        mask &= raw > min_score
        edge = mask & (raw < min_score + 2 * 10.0 ** -FIXED_DIGITS)      # only there can the fixed score be another
        mask[edge] = np.round(raw[edge], FIXED_DIGITS) > min_score
    if k is not None and raw.shape[1] > k:
        # rows with many candidates are trimmed by a k-th-best partition first;
        # sparse rows go straight to the exact cut below
        heavy = np.flatnonzero(mask.sum(axis=1) > HEAVY_ROW_FACTOR * k)
        if len(heavy):
            sub = np.where(mask[heavy], raw[heavy], -np.inf)
            kth = -np.partition(-sub, k - 1, axis=1)[:, k - 1:k]
            mask[heavy] &= sub >= kth - margin
    r, c = np.nonzero(mask)
    sc = round_half_away(raw[r, c], digits)
    if k is not None and len(r):
        order = np.lexsort((c, -sc, r))
        r, c, sc = r[order], c[order], sc[order]
        first = np.r_[True, r[1:] != r[:-1]]
        starts = np.flatnonzero(first)
        rank = np.arange(len(r)) - np.repeat(starts, np.diff(np.r_[starts, len(r)]))
        keep = rank < k
        r, c, sc = r[keep], c[keep], sc[keep]
    return r, c, sc


def _block_kernel(k: int | None, min_score: float | None, digits: int, symmetric: bool,
                  include_self: bool = False, chunk: int = 1024):
    def kernel(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        lo, hi = int(key[0]), int(key[1])
        pdf = pdf.sort_values("id", kind="stable")
        a = pdf[pdf["blk"] == lo]
        b = a if lo == hi else pdf[pdf["blk"] == hi]
        if len(a) == 0 or len(b) == 0:
            return pd.DataFrame({"mid": [], "rec_mid": [], "score": []})
        a_ids, b_ids = a["id"].to_numpy(), b["id"].to_numpy()
        a_r = np.stack(a["rhs"].to_numpy())
        b_r = a_r if lo == hi else np.stack(b["rhs"].to_numpy())
        a_l = a_r if symmetric else np.stack(a["lhs"].to_numpy())
        b_l = b_r if symmetric else (a_l if lo == hi else np.stack(b["lhs"].to_numpy()))
        directions = [(a_ids, a_l, b_ids, b_r)]
        if lo != hi:
            directions.append((b_ids, b_l, a_ids, a_r))
        if k is not None:
            floors = [x["floor"].to_numpy("float64") if "floor" in x else None for x in (a, b)]
            out = []
            for (src_ids, src, dst_ids, dst), floor in zip(directions, floors):
                own = np.arange(len(src)) if lo == hi and not include_self else None
                out.append((src_ids, dst_ids, *best_products(src, dst, k, digits, min_score, floor, own)))
            return pd.concat([pd.DataFrame({"mid": src_ids[r].astype("int32"), "rec_mid": dst_ids[c].astype("int32"), "score": sc})
                              for src_ids, dst_ids, r, c, sc in out], ignore_index=True)
        out = []
        for src_ids, src, dst_ids, dst in directions:
            # row chunks bound the score matrix to chunk x block columns
            for s0 in range(0, len(src_ids), chunk):
                raw = src[s0:s0 + chunk] @ dst.T
                if lo == hi and not include_self:
                    rows = np.arange(raw.shape[0])
                    raw[rows, rows + s0] = np.nan  # no self pair
                r, c, sc = _select(raw, None, min_score, digits)
                out.append(pd.DataFrame({"mid": src_ids[s0 + r].astype("int32"),
                                         "rec_mid": dst_ids[c].astype("int32"),
                                         "score": sc.astype("float64")}))
        full = [o for o in out if len(o)]
        return pd.concat(full, ignore_index=True) if full else out[0]
    return kernel


def block_count(rows: int, block_size: int, slots: int) -> int:
    """Blocks to deal ``rows`` into: enough that a block holds about ``block_size`` rows,
    and enough that the block pairs B (B + 1) / 2 fill every task slot.  The number
    decides how the work is split, never its result."""
    by_size = math.ceil(rows / block_size)
    by_slots = math.ceil((math.sqrt(8 * slots + 1) - 1) / 2)
    return max(1, by_size, min(by_slots, math.ceil(rows / LEAST_BLOCK)))


def _nearest(pivots: np.ndarray):
    def run(batches):
        for pdf in batches:
            if len(pdf):
                yield pdf.assign(cluster=np.argmax(np.stack(pdf["rhs"].to_numpy()) @ pivots.T, axis=1).astype("int32"))
    return run


def _cone(pdf: pd.DataFrame) -> pd.DataFrame:
    """The narrowest known cone around a block's vectors: its axis and widest angle."""
    x = np.stack(pdf["rhs"].to_numpy())
    axis = x.sum(0)
    length = np.sqrt(axis @ axis)
    axis = axis / length if length > 0 else x[0]
    return pd.DataFrame({"blk": pdf["blk"].iloc[:1], "axis": [axis], "angle": [float(np.arccos(np.clip(x @ axis, -1, 1)).max())]})


def pivot_blocks(norm: DataFrame, rows: int, n_blocks: int) -> DataFrame:
    """``norm`` (id, rhs: unit vectors) with ``blk``: vectors go to the nearest of ``n_blocks`` pivots
    (those of the least hashes), and a pivot's vectors are dealt into blocks of at most about
    ``rows / n_blocks``, so that neighbours share a block and no block grows with a cluster."""
    pivots = norm.orderBy(F.xxhash64("id"), "id").limit(n_blocks).select("rhs").collect()       # n_blocks vectors
    near = norm.mapInPandas(_nearest(np.array([r[0] for r in pivots])), "id int, rhs array<double>, cluster int")
    near = materialize(near, "clusters")
    sizes = near.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).collect()                 # one row a pivot
    most, starts, counts, at = math.ceil(rows / n_blocks), {}, {}, 0
    for r in sorted(sizes):
        starts[r["cluster"]], counts[r["cluster"]] = at, math.ceil(r["n"] / most)
        at += counts[r["cluster"]]
    spots = near.sparkSession.createDataFrame([(c, starts[c], counts[c]) for c in starts], "cluster int, start int, parts int")
    return near.join(F.broadcast(spots), "cluster").select(
        "id", "rhs", (F.col("start") + F.pmod(F.xxhash64("id"), F.col("parts"))).cast("int").alias("blk"))


def pivot_pairs(blocked: DataFrame, min_score: float) -> DataFrame:
    """``lo, hi, needed`` for every two blocks (lo <= hi).  Vectors of two blocks are at least the
    angle of their axes less both widest angles apart; where that is more than the angle of
    ``min_score`` no pair can score above it."""
    cones = materialize(blocked.groupBy("blk").applyInPandas(_cone, "blk int, axis array<double>, angle double"), "cones")
    one, two = (cones.select(F.col("blk").alias(s), F.col("axis").alias(f"axis_{s}"), F.col("angle").alias(f"angle_{s}")) for s in ("lo", "hi"))
    met = one.select("*", F.explode(cones.agg(F.collect_list("blk")).scalar()).alias("hi")).where("lo <= hi").join(two, "hi")
    between = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot("axis_lo", "axis_hi"))))
    least = between - F.col("angle_lo") - F.col("angle_hi")
    return met.select("lo", "hi", (least <= math.acos(min(1.0, min_score)) + ANGLE_MARGIN).alias("needed"))


def dense_pairs(vectors: DataFrame, id_col: str = "mid", vec_col: str = "features", metric: str = "cosine",
                min_score: float | None = None, k: int | None = None, block_size: int | None = None,
                n_blocks: int | None = None, digits: int = SCORE_DIGITS, include_self: bool = False) -> DataFrame:
    """Directed pairs ``mid, rec_mid, score`` (score rounded to ``digits``),
    ``mid != rec_mid`` unless ``include_self``, raw ``score > min_score`` when
    given.  With ``k`` every block pair keeps each row's exact top-k by
    (score desc, id asc): a superset of the row's overall top-k (at most k
    per block), which a final ranking cuts -- see :func:`dense_similarity`.

    With a cosine threshold of at least 0, vectors are dealt by nearest pivot and only
    block pairs are formed whose angles allow a score above it (:func:`pivot_pairs`);
    otherwise by hash, every pair.

    With ``k`` blocks are as large as BLOCK_CELLS allows, since every block a row meets moves the
    row once more and gives up to k results; and each block is multiplied with itself first: a
    row's kth score there bounds what its other blocks give (``floor``)."""
    # normalised once and written: the row count, the replication and any
    # retried kernel task read the table instead of recomputing the inputs
    norm = materialize(_normalised(vectors, id_col, vec_col, metric), "vectors")
    symmetric = metric == "cosine"
    slots = _slots(vectors.sparkSession)
    rows, width = norm.agg(F.count(F.lit(1)), F.max(F.size("rhs"))).first()
    block_size = block_size or (max(PLAIN_BLOCK, BLOCK_CELLS // max(1, width or 1)) if k is not None else PLAIN_BLOCK)
    b = n_blocks or block_count(rows, block_size, parallelism(vectors.sparkSession))
    vec_cols = ["rhs"] if symmetric else ["lhs", "rhs"]
    tagged, pairs = _dealt(norm.select("id", *vec_cols), rows, b, min_score if symmetric else None)
    n_pairs = pairs.count() if pairs is not None else b * (b + 1) // 2
    kernel = _block_kernel(k, min_score, digits, symmetric, include_self)
    first = None
    if k is not None and n_pairs > 1:
        alone = tagged.select(F.col("blk").alias("lo"), F.col("blk").alias("hi"), "*").repartition(max(1, min(b, slots)), "lo", "hi")
        first = materialize(alone.groupBy("lo", "hi").applyInPandas(kernel, PAIR_SCHEMA), "own-block-pairs")
        floors = first.groupBy(F.col("mid").alias("id")).agg(F.when(F.count(F.lit(1)) == k, F.min("score")).alias("floor"))
        tagged = tagged.join(floors, "id", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
        pairs = pairs.where("lo < hi") if pairs is not None else None
    replicated = _replicated(tagged, pairs, b, own=first is None, parts=min(n_pairs, slots))
    found = replicated.groupBy("lo", "hi").applyInPandas(kernel, PAIR_SCHEMA)
    return found if first is None else first.unionByName(found)


def _slots(spark) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), parallelism(spark))


def _dealt(norm: DataFrame, rows: int, b: int, min_score: float | None):
    """``norm`` with ``blk``, and the block pairs ``lo, hi`` to form (None: all).  ``min_score``: a
    cosine threshold, by which vectors are dealt by pivot and pairs are left out."""
    if min_score is not None and min_score >= 0 and rows:
        # a zero vector scores 0.0 with everything, never above the threshold
        some = norm.where(F.exists("rhs", lambda x: x != 0)).select("id", "rhs")
        tagged = materialize(pivot_blocks(some, rows, b), "pivot-blocks")
        return tagged, materialize(pivot_pairs(tagged, min_score).where("needed").select("lo", "hi"), "block-pairs")
    return norm.withColumn("blk", F.pmod(F.xxhash64("id"), F.lit(b)).cast("int")), None


def _replicated(tagged: DataFrame, pairs: DataFrame | None, b: int, own: bool, parts: int) -> DataFrame:
    """``tagged`` once for each block pair ``lo, hi`` a row's block is in; ``own``: also with itself."""
    if pairs is None:
        others = F.sequence(F.lit(0), F.lit(b - 1))
        partner = F.explode(others if own else F.array_remove(others, F.col("blk"))).alias("other")
        replicated = tagged.select("*", partner).withColumns(
            {"lo": F.least("blk", "other"), "hi": F.greatest("blk", "other")}).drop("other")
    else:
        places = pairs.select("lo", "hi", F.explode(F.array_distinct(F.array("lo", "hi"))).alias("blk"))
        replicated = tagged.join(places, "blk")
    # every vector meets each other block of its pairs exactly once (and its own block once).
    # An explicit partition count keeps one block pair per task slot instead of
    # letting the runtime merge the (few, large) groups into fewer tasks.
    return replicated.repartition(max(1, parts), "lo", "hi")


_ZSTD = pa.Codec("zstd", 1)


def pack_results(ids: np.ndarray, whole: np.ndarray) -> list[bytes]:
    """A row's results in one block, by ascending id: the eight byte planes of the steps between
    ids and of the scores as whole numbers.  Empty: all zero; shorter than the results: compressed."""
    steps = np.diff(ids.astype("int32").view("uint32"), prepend=np.uint32(0))         # wraps, and so does the sum
    planes = np.stack([steps, whole.astype("int32").view("uint32")]).astype("<u4").view("uint8").reshape(2, -1, 4).transpose(0, 2, 1)
    out = []
    for plane in np.ascontiguousarray(planes.reshape(8, -1)):
        raw = plane.tobytes() if plane.any() else b""
        short = _ZSTD.compress(raw, asbytes=True) if len(raw) > 32 else raw
        out.append(short if len(short) < len(raw) else raw)
    return out


def unpack_results(n: int, packed) -> tuple[np.ndarray, np.ndarray]:
    """``ids, whole`` of :func:`pack_results`."""
    planes = np.zeros((8, n), "uint8")
    for plane, x in zip(planes, packed):
        if len(x):
            plane[:] = np.frombuffer(x if len(x) == n else _ZSTD.decompress(x, n, asbytes=True), "uint8")
    steps, whole = np.ascontiguousarray(planes.reshape(2, 4, n).transpose(0, 2, 1)).reshape(2, -1).view("<u4").astype("uint32")
    return np.cumsum(steps, dtype="uint32").view("int32"), whole.view("int32")


def _packing_kernel(metric: str, min_score: float | None, digits: int):
    """All results of a block pair, a record for each row that has some in the other block."""
    def kernel(key: tuple[Any, ...], batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lo, hi = int(key[0]), int(key[1])
        parts = [(x["id"].to_numpy().astype("int32"), x["unit"].to_numpy(), x["blk"].to_numpy(), np.stack(x["rhs"].to_numpy())) for x in batches if len(x)]
        ids, units, blks, vecs = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(ids, kind="stable")
        one, two = (order[blks[order] == blk] for blk in (lo, hi))
        for src, dst in ([(one, one)] if lo == hi else [(one, two), (two, one)]):
            if not len(src) or not len(dst):
                continue
            left, right, dst_ids = vecs[src], vecs[dst], ids[dst]
            if metric == "l1l2":
                l1 = np.abs(left).sum(1, keepdims=True)
                left = np.divide(left, l1, out=np.zeros_like(left), where=l1 > 0)
            chunk = max(1, CHUNK_CELLS // len(dst))
            for s0 in range(0, len(src), chunk):
                raw = left[s0:s0 + chunk] @ right.T
                if lo == hi:
                    at = np.arange(len(raw))
                    raw[at, at + s0] = np.nan  # no self pair
                r, c, sc = _select(raw, None, min_score, digits)
                rec, whole = dst_ids[c], np.rint(sc * 10 ** digits).astype("int32")
                n = np.bincount(r, minlength=len(raw))
                ends = np.cumsum(n)
                some = np.flatnonzero(n)
                if len(some):
                    yield pd.DataFrame({"unit": units[src[s0 + some]], "mid": ids[src[s0 + some]], "n": n[some].astype("int32"),
                                        "packed": [pack_results(rec[e - m:e], whole[e - m:e]) for e, m in zip(ends[some], n[some])]})
    return kernel


def _ranking_kernel(digits: int):
    """The ranked lists of the rows of a unit."""
    def kernel(pdf: pd.DataFrame) -> pd.DataFrame:
        mids, lists = [], []
        for mid, part in pdf.groupby("mid"):
            found = [unpack_results(n, packed) for n, packed in zip(part["n"], part["packed"])]
            rec, whole = (np.concatenate(x).astype("int64") for x in zip(*found))
            # one number orders by (score desc, id asc)
            mids.append(mid)
            lists.append(np.sort(((1 << 31) - 1 - whole).astype("uint64") << np.uint64(32) | (rec + (1 << 31)).astype("uint64")))
        n, keys = [len(x) for x in lists], np.concatenate(lists)
        return pd.DataFrame({"mid": np.repeat(np.array(mids, "int32"), n), "rank": np.concatenate([np.arange(1, x + 1, dtype="int32") for x in n]),
                             "rec_mid": ((keys & np.uint64(0xFFFFFFFF)).astype("int64") - (1 << 31)).astype("int32"),
                             "score": ((1 << 31) - 1 - (keys >> np.uint64(32)).astype("int64")) / 10.0 ** digits})
    return kernel


def packed_lists(vectors: DataFrame, id_col: str = "mid", vec_col: str = "features", metric: str = "cosine",
                 min_score: float | None = None, block_size: int | None = None, n_blocks: int | None = None,
                 digits: int = SCORE_DIGITS) -> DataFrame:
    """All results above ``min_score``, ``unit, mid, n, packed``: a record holds those a row has in
    one block (:func:`pack_results`).  The rows of a ``unit`` (dealt by id) are ranked together and
    lie in one partition.  The number of results may grow with the square of the rows: each takes a
    few bytes and moves once.  Vectors move once for each block, and blocks are as large as
    LIST_BLOCK_CELLS allows; a task holds two blocks and CHUNK_CELLS scores."""
    if metric not in ("cosine", "l1l2"):
        raise ValueError(f"unknown metric {metric!r}")
    # unit vectors serve both metrics: divided by its own l1 norm one is the left side of l1l2
    norm = materialize(_normalised(vectors, id_col, vec_col, "cosine").select("id", "rhs"), "vectors")
    slots = _slots(vectors.sparkSession)
    rows, width = norm.agg(F.count(F.lit(1)), F.max(F.size("rhs"))).first()
    b = n_blocks or block_count(rows, block_size or max(PLAIN_BLOCK, LIST_BLOCK_CELLS // max(1, width or 1)), parallelism(vectors.sparkSession))
    if min_score is not None and min_score >= 0:
        norm = norm.where(F.exists("rhs", lambda x: x != 0))
    tagged, pairs = _dealt(norm, rows, b, min_score if metric == "cosine" else None)
    n_pairs = pairs.count() if pairs is not None else b * (b + 1) // 2
    units = max(1, math.ceil(rows * rows / LIST_CELLS), min(rows, slots))
    tagged = tagged.withColumn("unit", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(units)).cast("int"))
    # more partitions than slots where the blocks of so many pairs would spill in one
    replicated = _replicated(tagged, pairs, b, own=True, parts=min(n_pairs, max(slots, n_pairs // 4)))
    packed = replicated.groupBy("lo", "hi").applyInPandas(_packing_kernel(metric, min_score, digits), PACKED_SCHEMA)
    return packed.repartition(max(slots, math.ceil(rows * rows / PART_CELLS)), "unit")


def dense_similarity(vectors: DataFrame, id_col: str = "mid", vec_col: str = "features", metric: str = "cosine",
                     min_score: float | None = None, k: int | None = None, block_size: int | None = None,
                     n_blocks: int | None = None) -> DataFrame:
    """Ranked similarity lists in long form: ``mid, rank, rec_mid, score``."""
    if k is None:
        packed = packed_lists(vectors, id_col, vec_col, metric, min_score, block_size, n_blocks)
        return packed.groupBy("unit").applyInPandas(_ranking_kernel(SCORE_DIGITS), RANKED_SCHEMA)
    pairs = dense_pairs(vectors, id_col, vec_col, metric, min_score, k, block_size, n_blocks)
    return rank_within(pairs, ["mid"], by_score("score", "rec_mid"), k).select("mid", "rank", "rec_mid", "score")


ITEM_BLOCK = 4096     # items of one block of :func:`item_blocks`
ASK_BLOCK = 512       # asking items of one block of :func:`lists_of`


def item_blocks(vectors: DataFrame, id_col: str = "mid", vec_col: str = "features") -> DataFrame:
    """``blk, ids, vecs``: normalised vectors in blocks of about ITEM_BLOCK items, one row each."""
    norm = _normalised(vectors, id_col, vec_col, "cosine")
    n = max(1, math.ceil(norm.count() / ITEM_BLOCK))
    return norm.groupBy(F.pmod(F.xxhash64("id"), F.lit(n)).alias("blk")).agg(
        F.sort_array(F.collect_list(F.struct("id", "rhs"))).alias("b")).select(
        "blk", F.col("b.id").alias("ids"), F.col("b.rhs").alias("vecs"))


def _lists_kernel(min_score: float | None, digits: int, chunk: int = 1024):
    def kernel(batches):
        for pdf in batches:
            for q_ids, q_vecs, bounds, ids, vecs in zip(*(pdf[c] for c in ("q_ids", "q_vecs", "bounds", "ids", "vecs"))):
                src, dst, bounds = np.stack(list(q_vecs)), np.stack(list(vecs)), np.asarray(bounds)
                for s0 in range(0, len(src), chunk):
                    own = np.asarray(q_ids)[s0:s0 + chunk]
                    raw = src[s0:s0 + chunk] @ dst.T
                    raw[own[:, None] == np.asarray(ids)[None, :]] = np.nan      # no self pair
                    r, c, sc = _select(raw, int(bounds[s0:s0 + chunk].max()), min_score, digits)
                    order = np.lexsort((c, -sc, r))                             # ids rise with the column
                    r, c, sc = r[order], c[order], sc[order]
                    keep = np.arange(len(r)) - np.searchsorted(r, r) < bounds[s0 + r]
                    r, c, sc = r[keep], c[keep], sc[keep]
                    yield pd.DataFrame({"mid": own[r].astype("int32"), "rec_mid": np.asarray(ids)[c].astype("int32"),
                                        "score": sc.astype("float64")})
    return kernel


def lists_of(asked: DataFrame, vectors: DataFrame, blocks: DataFrame, min_score: float | None = None,
             digits: int = SCORE_DIGITS) -> DataFrame:
    """Ranked lists ``mid, rank, rec_mid, score`` of the items in ``asked`` (``mid, bound``,
    one row each): the top ``bound`` others with cosine above ``min_score``, the same rows as
    :func:`dense_similarity` gives.  Asking items are dealt into blocks of about ASK_BLOCK, and
    each of these goes to every one of ``blocks`` (:func:`item_blocks` of the same vectors) by an
    equi-join on the block's number: a row holds two blocks, whatever is asked for, and gives
    at most ``bound`` entries an item."""
    spark = asked.sparkSession
    slots = max(int(spark.conf.get("spark.sql.shuffle.partitions")), parallelism(spark))
    norm = _normalised(vectors, "mid", "features", "cosine").withColumnRenamed("id", "mid")
    wanted = asked.agg(F.ceil(F.count(F.lit(1)) / ASK_BLOCK)).scalar()
    q = asked.join(norm, "mid").groupBy(F.pmod(F.xxhash64("mid"), F.greatest(wanted, F.lit(1))).alias("q")).agg(
        F.collect_list(F.struct("mid", "rhs", "bound")).alias("b")).select(
        "q", F.col("b.mid").alias("q_ids"), F.col("b.rhs").alias("q_vecs"), F.col("b.bound").alias("bounds"))
    numbers = blocks.agg(F.collect_list("blk")).scalar()
    pairs = q.select("*", F.explode(numbers).alias("blk")).join(blocks.hint("merge"), "blk").repartition(slots, "q", "blk")
    found = pairs.mapInPandas(_lists_kernel(min_score, digits), PAIR_SCHEMA)
    ranked = rank_within(found, ["mid"], by_score("score", "rec_mid"))
    return ranked.join(asked, "mid").where(F.col("rank") <= F.col("bound")).select("mid", "rank", "rec_mid", "score")


def nest_similarity(ranked: DataFrame) -> DataFrame:
    """Long lists -> ``mid, recs`` (the MovieRecs / ContentMovieRecs shape)."""
    return nest_ranked(ranked, "mid", mid="rec_mid")


SPARSE_SCHEMA = "mid int, rec_mid int, score double"


def _flatten(part: pd.DataFrame):
    lengths = part["terms"].map(len).to_numpy()
    rows = np.repeat(np.arange(len(part)), lengths)
    terms = np.concatenate(part["terms"].to_numpy()) if len(rows) else np.empty(0, dtype=object)
    ws = np.concatenate(part["ws"].to_numpy()).astype("float64") if len(rows) else np.empty(0)
    return rows, terms, ws


COMMON_TERM = 64      # entries of a term in both blocks together from which it is multiplied densely
TERM_SLICE = 512      # common terms multiplied at a time


def _sparse_product(a_rows, a_terms, a_ws, n_a: int, b_rows, b_terms, b_ws, n_b: int) -> np.ndarray:
    """Dot products of the rows of two sparse matrices given by entries.  Only terms that both
    hold count: common ones are columns of a dense product, slice by slice; of the rare ones
    every meeting of two entries is added up."""
    n_terms = 1 + max(a_terms.max(initial=0), b_terms.max(initial=0))
    in_a, in_b = np.bincount(a_terms, minlength=n_terms), np.bincount(b_terms, minlength=n_terms)
    scores, both = np.zeros((n_a, n_b)), (in_a > 0) & (in_b > 0)
    common = np.flatnonzero(both & (in_a + in_b >= COMMON_TERM))
    column = np.full(n_terms, -1)
    for t0 in range(0, len(common), TERM_SLICE):
        part = common[t0:t0 + TERM_SLICE]
        column[:] = -1
        column[part] = np.arange(len(part))
        x, y = np.zeros((n_a, len(part))), np.zeros((n_b, len(part)))
        for out, rows, terms, ws in ((x, a_rows, a_terms, a_ws), (y, b_rows, b_terms, b_ws)):
            hit = column[terms] >= 0
            out[rows[hit], column[terms[hit]]] = ws[hit]
        scores += x @ y.T
    rare = both & (in_a + in_b < COMMON_TERM)
    a_hit, b_hit = rare[a_terms], rare[b_terms]
    order = np.argsort(b_terms[b_hit], kind="stable")
    terms, rows, ws = (v[b_hit][order] for v in (b_terms, b_rows, b_ws))
    first, last = (np.searchsorted(terms, a_terms[a_hit], side) for side in ("left", "right"))
    n = last - first
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    np.add.at(scores, (np.repeat(a_rows[a_hit], n), rows[at]), np.repeat(a_ws[a_hit], n) * ws[at])
    return scores


def _sparse_kernel(k: int | None, min_score: float | None, digits: int, include_self: bool, chunk: int = 1024):
    def kernel(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        lo, hi = int(key[0]), int(key[1])
        pdf = pdf.sort_values("id", kind="stable")
        a = pdf[pdf["blk"] == lo]
        b = a if lo == hi else pdf[pdf["blk"] == hi]
        if len(a) == 0 or len(b) == 0:
            return pd.DataFrame({"mid": [], "rec_mid": [], "score": []})
        parts = [(a["id"].to_numpy(), *_flatten(a))]
        if lo != hi:
            parts.append((b["id"].to_numpy(), *_flatten(b)))
        # local vocabulary of the block pair -> integer term ids
        vocab, inv = np.unique(np.concatenate([p[2] for p in parts]), return_inverse=True)
        coded, at = [], 0
        for ids, rows, terms, ws in parts:
            coded.append((ids, rows, inv[at:at + len(terms)], ws))
            at += len(terms)
        directions = [(coded[0], coded[0])] if lo == hi else [(coded[0], coded[1]), (coded[1], coded[0])]
        out = []
        for src, (dst_ids, d_rows, d_terms, d_ws) in directions:
            src_ids, s_rows, s_terms, s_ws = src
            for s0 in range(0, len(src_ids), chunk):
                n_rows = min(chunk, len(src_ids) - s0)
                sel = (s_rows >= s0) & (s_rows < s0 + n_rows)
                scores = _sparse_product(s_rows[sel] - s0, s_terms[sel], s_ws[sel], n_rows, d_rows, d_terms, d_ws, len(dst_ids))
                if lo == hi and not include_self:
                    r = np.arange(n_rows)
                    scores[r, r + s0] = np.nan  # no self pair
                r, c, sc = _select(scores, k, min_score, digits)
                out.append(pd.DataFrame({"mid": src_ids[s0 + r].astype("int32"),
                                         "rec_mid": dst_ids[c].astype("int32"), "score": sc.astype("float64")}))
        full = [o for o in out if len(o)]
        return pd.concat(full, ignore_index=True) if full else out[0]
    return kernel


def sparse_pairs(weights: DataFrame, id_col: str = "mid", term_col: str = "term", w_col: str = "w",
                 min_score: float | None = 0.0, k: int | None = None, include_self: bool = False,
                 block_size: int = 4096, n_blocks: int | None = None, digits: int = SCORE_DIGITS) -> DataFrame:
    """Cosine over sparse vectors: ``mid, rec_mid, score`` (rounded).

    ``weights`` holds one row per (item, term).  Vectors are L2-normalised in
    Spark, each item's terms and weights become one row, and items are
    blocked by hash and paired like the dense kernel; inside a block pair
    dot products fill a bounded chunk x block score matrix.  Pairs never become rows: only entries above
    ``min_score`` (strict, default: drop zero scores) and, with ``k``, each
    row's exact top-k within the block pair leave the task (a superset of
    the row's overall top-k, cut by a final ranking).  Zero vectors produce
    nothing.
    """
    w = (weights.select(F.col(id_col).cast("int").alias("id"), F.col(term_col).cast("string").alias("term"),
                        F.col(w_col).cast("double").alias("w"))
         .groupBy("id", "term").agg(F.sum("w").alias("w")))
    # one row per item; its norm comes from the collected weights, without a join
    lists = w.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("term", "w"))).alias("tw"))
    norm = F.sqrt(F.aggregate("tw", F.lit(0.0), lambda s, x: s + x["w"] * x["w"]))
    docs = (lists.withColumn("norm", norm).where(F.col("norm") > 0)
            .select("id", F.col("tw.term").alias("terms"), F.transform("tw", lambda x: x["w"] / F.col("norm")).alias("ws")))
    docs = materialize(docs, "sparse-vectors")
    spark = weights.sparkSession
    if n_blocks is None:
        n_blocks = block_count(docs.count(), block_size, parallelism(spark))
    b = n_blocks
    partner = F.explode(F.sequence(F.lit(0), F.lit(b - 1))).alias("other")
    replicated = docs.withColumn("blk", F.pmod(F.xxhash64("id"), F.lit(b)).cast("int")).select("*", partner).select(
        F.least("blk", "other").alias("lo"), F.greatest("blk", "other").alias("hi"), "blk", "id", "terms", "ws")
    slots = max(int(spark.conf.get("spark.sql.shuffle.partitions")), parallelism(spark))
    replicated = replicated.repartition(min(b * (b + 1) // 2, slots), "lo", "hi")
    kernel = _sparse_kernel(k, min_score, digits, include_self)
    return replicated.groupBy("lo", "hi").applyInPandas(kernel, SPARSE_SCHEMA)


BROADCAST_ROWS = 1 << 19   # rows (two numbers and a score) of group lists that are broadcast
MEMBERS_A_TASK = 100_000   # items of a task that expands lists of groups to items


def expand_groups(group_pairs: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """Item top-k lists from similarities between groups of identical items.

    ``members`` maps ``mid -> gid`` where every member of a group has the
    same vector and ``gid`` is the group's smallest member id;
    ``group_pairs`` holds ``gid, ngid, score`` -- including a group with
    itself -- and, per ``gid``, at least the top (k+1) neighbour groups by
    (score desc, ngid asc).  Result: ``mid, rank, rec_mid, score`` with the
    top k other items of each item by (score desc, rec_mid asc).

    Exact: a group ranked after k+1 others always has k+1 better members
    (each earlier group's smallest member), so only the top (k+1) groups and
    the (k+1) smallest members of each can reach a list; an item's own list
    is its group's list without itself.  Work grows with the number of
    distinct vectors, and each item reads only k+1 rows.  The expansion runs in partitions of at
    most about MEMBERS_A_TASK items: the k+1 rows of an item are made where its list is
    cut, however few files the items come from.
    """
    members = materialize(members.select("mid", "gid"), "members")
    spark = members.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(members.count() / MEMBERS_A_TASK))
    firsts = rank_within(members.select("gid", "mid"), ["gid"], [F.col("mid").asc()], k + 1).select(
        F.col("gid").alias("ngid"), F.col("mid").alias("rec_mid"))
    per_group = rank_within(group_pairs.join(firsts, "ngid"), ["gid"],
                            [F.col("score").desc(), F.col("rec_mid").asc()], k + 1).select("gid", "rec_mid", "score")
    per_group = materialize(per_group, "group-lists")
    # members are as few bytes as group lists but many more rows come of them, so they stay dealt
    # and the lists travel; lists of very many groups meet them by a merge join
    if per_group.count() <= BROADCAST_ROWS:
        per_item = members.repartition(n, "mid").join(F.broadcast(per_group), "gid")
    else:
        per_item = members.join(per_group.hint("merge"), "gid")
    per_item = per_item.where(F.col("mid") != F.col("rec_mid"))
    return rank_within(per_item, ["mid"], [F.col("score").desc(), F.col("rec_mid").asc()], k).select(
        "mid", "rank", "rec_mid", "score")


def fill_with_zeros(ranked: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """Complete top-k lists with zero-score items (the reference also lists
    pairs that share nothing): ``mid, rank, rec_mid, score`` for every item.

    A list with p < k positive entries is completed by the smallest other
    ids not already listed, so the 2k+1 smallest ids overall always suffice;
    they are fetched once (a bounded top-(2k+1), as a scalar subquery) and
    exploded per item -- no join, nothing unbounded in one task.
    """
    ids = items.select("mid").distinct()
    smallest = ids.orderBy("mid").limit(2 * k + 1).agg(F.collect_list("mid").alias("ids")).scalar()
    zeros = ids.select("mid", F.explode(smallest).alias("rec_mid")).where(F.col("mid") != F.col("rec_mid")) \
        .select("mid", "rec_mid", F.lit(0.0).alias("score"))
    merged = (ranked.select("mid", "rec_mid", "score").unionByName(zeros)
              .groupBy("mid", "rec_mid").agg(F.max("score").alias("score")))
    return rank_within(merged, ["mid"], by_score("score", "rec_mid"), k).select("mid", "rank", "rec_mid", "score")
