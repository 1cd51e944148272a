"""Near duplicates: banded MinHash candidates, sequential Bayesian verification.

1. Every text becomes a set of hashed word shingles and a signature of ``PERMS`` hashes.
   Rows with the same set are represented by their smallest id.
2. Representatives that agree on all hashes of a band share a bucket.  Buckets first
   give star pairs (each member with the bucket's smallest), at most one row per member
   and band however large the bucket.
3. A pair's signatures are compared batch by batch.  With m of n hashes equal and a
   uniform prior the similarity's posterior is Beta(m + 1, n - m + 1); a pair is dropped
   as soon as the posterior chance of reaching the threshold is below ``miss``.
4. For each member the most promising survivor is verified on the full sets; verified
   links join components.
5. Buckets that still hold different components are settled without forming pairs inside
   a component, which cannot change the result.  Members of buckets of up to ``SMALL``
   rows are paired, compared and verified the same way, at most ``SMALL`` partners a bucket.
   Larger buckets that share members make one cluster; its members meet in blocks of
   ``BLOCK`` rows, those outside the cluster's main component against all, and a block pair
   is compared, verified and joined inside its task, which returns at most one link for
   each two components it joins.

With 40 bands of 5 hashes a pair at similarity 0.8 misses every bucket with a chance of
1.3e-7.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinerank.config import materialize
from cinerank.llm.common import FILTER_BITS, bounded_batches, key_bitmap, maybe_in, text_of, without
from cinerank.llm.components import connected_components

BANDS, ROWS = 40, 5
PERMS = BANDS * ROWS
BATCH = 40               # hashes compared at a time
MISS = 1e-8              # chosen chance of dropping a pair at the threshold in one comparison
THRESHOLD = 80           # percent
SMALL = 16               # rows of a bucket up to which its members are paired as rows
BLOCK = 512              # rows of a cluster that meet another block in one task
SLICE = 4096             # shingles hashed at a time, so a long text needs no more memory

_rng = np.random.default_rng(20240229)
_MUL = _rng.integers(0, 1 << 31, PERMS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _rng.integers(0, 1 << 32, PERMS, dtype=np.uint32)


def shingle_set(text: str, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles of a text; A-Z are
    lower-cased, words are separated by ASCII white space.  Fewer words: the whole
    sequence is the one shingle; no words: empty."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b"\x00".join(words), seed=len(words))], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(h) - width + 1
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = (out ^ h[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def signature(shingles: np.ndarray) -> np.ndarray:
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    best = np.full(PERMS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), SLICE):
        part = low[at:at + SLICE, None] * _MUL
        part += _ADD
        np.minimum(best, part.min(0), out=best)
    return best


def _sketch(width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            sets = [shingle_set(t, width) for t in rows["text"]]
            yield pd.DataFrame({
                "id": rows["id"], "n_shingles": [len(s) for s in sets],
                "set_key": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets],
                "sig": [signature(s).tobytes() if len(s) else b"" for s in sets]})
    return run


def _sets(width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            yield pd.DataFrame({"id": rows["id"], "set": [shingle_set(t, width).tobytes() for t in rows["text"]]})
    return run


def least_matches(threshold: float, miss: float) -> dict[int, int]:
    """For n compared hashes the fewest equal ones with which a pair goes on: the chance
    that the similarity is at least ``threshold`` under Beta(m + 1, n - m + 1), which is
    the chance of at most m successes in n + 1 draws of ``threshold``, reaches ``miss``."""
    out = {}
    for n in range(BATCH, PERMS + 1, BATCH):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        out[n] = m
    return out


def _compare(needed: dict[int, int]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            a, b = (np.frombuffer(b"".join(rows[c]), np.uint32).reshape(-1, PERMS) for c in ("sig_a", "sig_b"))
            alive, equal = np.arange(len(rows)), np.zeros(len(rows), np.int64)
            for n, least in needed.items():
                equal[alive] += (a[alive, n - BATCH:n] == b[alive, n - BATCH:n]).sum(1)
                alive = alive[equal[alive] >= least]
            yield pd.DataFrame({"a": rows["a"].to_numpy()[alive], "b": rows["b"].to_numpy()[alive], "equal": equal[alive]})
    return run


def _verify(percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            keep = []
            for x, y in zip(rows["set_a"], rows["set_b"]):
                p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.intersect1d(p, q, assume_unique=True).size
                keep.append(100 * both >= percent * (p.size + q.size - both))
            yield rows.loc[np.array(keep, bool), ["a", "b"]]
    return run


def _settle(needed: dict[int, int], percent: int):
    """Links between the components of two blocks: ``left`` rows against ``right`` rows of
    other components.  Signatures are compared in batches, survivors on their full sets."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        links: list[tuple[int, int]] = []
        if len(left) and len(right):
            parent: dict[int, int] = {}

            def root(c: int) -> int:
                while parent.get(c, c) != c:
                    c = parent[c]
                return c
            sig = np.frombuffer(b"".join(right["sig"]), np.uint32).reshape(-1, PERMS)
            sets = [np.frombuffer(x, np.uint64) for x in right["set"]]
            sizes = np.array([len(x) for x in sets])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            words, codes = np.unique(np.concatenate(sets), return_inverse=True)
            ids, comps, main = (right[c].to_numpy() for c in ("id", "comp", "main"))
            for own, comp, own_sig, own_set in zip(left["id"], left["comp"], left["sig"], left["set"]):
                mine = np.frombuffer(own_sig, np.uint32)
                alive = np.nonzero((comps != comp) & (main | (ids > own)))[0]
                equal = np.zeros(len(ids), np.int64)
                for n, least in needed.items():
                    equal[alive] += (sig[alive, n - BATCH:n] == mine[n - BATCH:n]).sum(1)
                    alive = alive[equal[alive] >= least]
                if not len(alive):
                    continue
                shingles = np.frombuffer(own_set, np.uint64)
                at = np.searchsorted(words, shingles)
                at = at[at < len(words)]
                held = np.zeros(len(words), bool)
                held[at] = np.isin(words[at], shingles)
                both = np.add.reduceat(held[codes].astype(np.int32), starts)
                for j in alive[100 * both[alive] >= percent * (sizes[alive] + len(shingles) - both[alive])]:
                    x, y = root(int(comp)), root(int(comps[j]))
                    if x != y:
                        parent[max(x, y)] = min(x, y)
                        links.append((int(own), int(ids[j])))
        return pd.DataFrame(links, columns=["a", "b"]).astype("int64")
    return run


def _clusters(placed: DataFrame) -> DataFrame:
    """(id, cluster) of the members (id, center) of the larger mixed buckets: buckets that share
    a member belong to one cluster."""
    return connected_components(placed.select(F.col("id").alias("a"), F.col("center").alias("b")), "a", "b"
                                ).withColumnRenamed("component", "cluster").withColumnRenamed("node", "id")


def _settle_clusters(clusters: DataFrame, comps: DataFrame, reps: DataFrame, sets: DataFrame, needed: dict[int, int],
                     percent: int) -> DataFrame:
    """Links (a, b) that join the components of each cluster."""
    rows = clusters.join(comps, "id", "left").select("id", "cluster", F.coalesce("component", "id").alias("comp"))
    sized = rows.groupBy("cluster", "comp").agg(F.count(F.lit(1)).alias("n"))
    about = (sized.groupBy("cluster").agg(F.sum("n").alias("all"), F.max(F.struct("n", "comp")).alias("m"), F.count(F.lit(1)).alias("comps"))
             .filter("comps > 1")
             .select("cluster", F.col("m.comp").alias("main_comp"), F.ceil((F.col("all") - F.col("m.n")) / BLOCK).alias("lefts"),
                     F.ceil(F.col("all") / BLOCK).alias("rights")))
    full = materialize(rows.join(about, "cluster").join(reps, "id").join(sets, "id")
                       .withColumn("main", F.col("comp") == F.col("main_comp")), "cluster-rows")
    block = lambda n, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.col(n))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    own = ["id", "comp", "main", "sig", "set"]
    left = full.filter("not main").select(*own, "cluster", block("lefts", 1).alias("l"), each("rights").alias("r"))
    right = full.select(*[F.col(c).alias(c) for c in own], F.col("cluster").alias("cluster2"), each("lefts").alias("l2"),
                        block("rights", 2).alias("r2"))
    renamed = right.toDF(*[f"{c}2" for c in own], "cluster2", "l2", "r2")
    settle = _settle(needed, percent)

    def meet(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        return settle(x, y.rename(columns={f"{c}2": c for c in own}))
    return left.groupBy("cluster", "l", "r").cogroup(renamed.groupBy("cluster2", "l2", "r2")).applyInPandas(meet, "a long, b long")


def _attach(pairs: DataFrame, values: DataFrame, value: str) -> DataFrame:
    """The values of both ends of every pair.  Plain equi-joins on the ids: a node with
    very many partners is split by adaptive execution."""
    one = pairs.join(values.select(F.col("id").alias("a"), F.col(value).alias(f"{value}_a")), "a")
    return one.join(values.select(F.col("id").alias("b"), F.col(value).alias(f"{value}_b")), "b")


def _band_rows(reps: DataFrame) -> DataFrame:
    """(bucket, id): one row for each band of each representative."""
    keys = F.array(*[F.xxhash64(F.lit(i), F.substring("sig", i * ROWS * 4 + 1, ROWS * 4)) for i in range(BANDS)])
    return reps.select("id", F.explode(keys).alias("bucket"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                    percent: int = THRESHOLD, miss: float = MISS) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id, kept.

    * Two rows are linked when 100 * intersection >= ``percent`` * union of their sets;
      component_id is the smallest id reachable over links, kept marks that row.
    * Null or empty text, or no words: empty set, linked with nothing.
    * Rows that share an id are one document: their links count together.
    * Rows with a null id take no part: component_id null, kept true.
    * Empty table: empty result; other columns are ignored."""
    bounded_batches(docs.sparkSession)
    text = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    sketch = materialize(text.mapInPandas(_sketch(width), "id long, n_shingles long, set_key binary, sig binary"), "sketches")
    real = sketch.filter("n_shingles > 0 and id is not null")
    first = materialize(real.groupBy("set_key").agg(F.min("id").alias("rep")), "distinct-sets")
    member = materialize(sketch.select("id", "n_shingles", "set_key").join(first, "set_key", "left"), "members")
    reps = real.join(first.select("set_key", F.col("rep").alias("id")), ["set_key", "id"], "left_semi").select("id", "sig")
    reps = materialize(reps.dropDuplicates(["id", "sig"]), "representatives")

    bands = _band_rows(reps)
    shared = bands.groupBy("bucket").agg(F.min("id").alias("center"), F.max("id").alias("top")).filter("center <> top")
    crowded = materialize(bands.join(shared.select("bucket", "center"), "bucket"), "buckets")
    needed = least_matches(percent / 100, miss)
    compare = lambda pairs: _attach(pairs, reps, "sig").mapInPandas(
        _compare(needed), "a long, b long, equal long")
    stars = crowded.filter("id <> center").select(F.col("id").alias("a"), F.col("center").alias("b")).distinct()
    likely = materialize(compare(stars).groupBy("a").agg(F.max(F.struct("equal", -F.col("b"))).alias("m"))
                         .select("a", (-F.col("m.col2")).alias("b")), "star-pairs")

    wanted = crowded.select("id").distinct()
    near = maybe_in(text.filter("id is not null"), F.col("id"), key_bitmap(wanted, F.col("id"), FILTER_BITS), FILTER_BITS)
    sets = materialize(near.join(wanted, "id", "left_semi").mapInPandas(_sets(width), "id long, set binary"), "sets")
    verify = lambda pairs: _attach(pairs, sets, "set").mapInPandas(_verify(percent), "a long, b long")
    same_id = (member.filter("rep is not null").groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("top"))
               .filter("a <> top").select("id", "a"))
    repeated = member.join(same_id, "id").filter("rep <> a").select("a", F.col("rep").alias("b"))
    stage1 = connected_components(verify(likely).unionByName(repeated), "a", "b")

    comps = stage1.withColumnRenamed("node", "id")
    placed = crowded.select("id", "bucket").join(comps, "id", "left").select(
        "bucket", "id", F.coalesce("component", "id").alias("comp"))
    mixed = (placed.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("n"),
                                           F.min("id").alias("center"))
             .filter("lo <> hi").select("bucket", "n", "center"))
    left = materialize(placed.join(mixed, "bucket"), "mixed-buckets")
    clusters = materialize(_clusters(left.filter(F.col("n") > SMALL)), "clusters")
    inner = materialize(_settle_clusters(clusters, comps, reps, sets, needed, percent), "cluster-links")
    small = (left.filter(F.col("n") <= SMALL).join(clusters, "id", "left")
             .select("bucket", "id", "comp", "cluster"))
    cross = (small.alias("x").join(small.alias("y"), (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.id") < F.col("y.id"))
                                   & (F.col("x.comp") != F.col("y.comp")) & F.coalesce(F.col("x.cluster") != F.col("y.cluster"), F.lit(True)))
             .select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct())
    links = inner.unionByName(verify(materialize(compare(cross).select("a", "b"), "cross-pairs")))
    up = stage1.select(F.col("node"), F.col("component"))
    lifted = (links.join(up.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a", "left")
              .join(up.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b", "left")
              .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
    stage2 = connected_components(lifted, "a", "b")
    final = (stage1.join(stage2.select(F.col("node").alias("component"), F.col("component").alias("upper")), "component", "left")
             .select("node", F.coalesce("upper", "component").alias("component")))
    alone = stage2.join(stage1.select("node"), "node", "left_anti")
    lookup = final.unionByName(alone).select(F.col("node").alias("rep"), "component")
    comp = F.when(F.col("id").isNotNull(), F.coalesce("component", "rep", "id"))
    return member.join(lookup, "rep", "left").select(
        F.col("id").alias(id_col), "n_shingles", comp.alias("component_id"),
        F.coalesce(comp == F.col("id"), F.lit(True)).alias("kept"))


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
              percent: int = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each group of near duplicates, the smallest id; rows
    that share an id are one document and stay or go together.  Rows with a null id and
    texts without words stay.  Columns are unchanged."""
    judged = near_duplicates(docs, id_col, text_col, width, percent)
    gone = materialize(judged.filter(~F.col("kept")).select(F.col(id_col).cast("long").alias("gone")).distinct(), "near-copies")
    return without(docs, F.col(id_col).cast("long"), gone)
