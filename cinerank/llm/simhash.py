"""Near duplicates by SimHash, found through an index in Gray order.

Distinct fingerprints are sorted by Gray rank, so that neighbours differ in few bits, and
cut into buckets of 64; 16 neighbouring nodes share a parent, up to one root.  A node keeps
the bits that all fingerprints below it share, factored: only those that its parent does
not hold already, as a mask and a pattern.  The join of the index with itself starts at
the pair (root, root) and goes down one level at a time; a pair of nodes adds the
differences in the bits that became common at this level to those of its parents, and the
whole pair of groups goes when they exceed the distance.  Pairs of buckets that are left
compare their fingerprints bit by bit, so no link is lost and none is guessed.

Every level is an equi-join on node numbers; the number of pairs that live on grows with
the number of nodes times the square of the logarithm.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinerank.config import materialize
from cinerank.llm.common import bounded_batches, text_of
from cinerank.llm.components import connected_components
from cinerank.llm.ordering import dealt_by, look_up, numbered

WIDTH = 3            # words of a shingle
DISTANCE = 2         # most differing bits of a link
SEED = 42
BUCKET = 64          # fingerprints of a lowest node
FANOUT = 16
SLICE = 1 << 15      # shingles counted at a time
MEETINGS = 256       # pairs of buckets that reach a Python worker at a time


# ------------------------------------------------------------------ fingerprints
def fingerprint(text: str, width: int = WIDTH) -> int:
    """SimHash of the text's word shingles as a signed 64-bit number; 0 without words."""
    words = text.encode().lower().split()        # bytes: A-Z, and the six ASCII spaces only
    if not words:
        return 0
    width = min(width, len(words))
    total, ones = len(words) - width + 1, np.zeros(64, np.int64)
    for at in range(0, total, SLICE):
        part = words[at:at + SLICE + width - 1]
        h = np.array([xxhash.xxh64_intdigest(b" ".join(s), SEED) for s in zip(*(part[i:] for i in range(width)))], "<u8")
        ones += np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def _sketch(width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            yield pd.DataFrame({"id": rows["id"], "fp": np.array([fingerprint(t, width) for t in rows["text"]], np.int64)})
    return run


# ------------------------------------------------------------------ index
def gray_rank(fp: str) -> Column:
    """Place of a fingerprint in the reflected Gray code, as a long that sorts like the
    unsigned rank."""
    rank = F.col(fp)
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank.bitwiseXOR(F.lit(-(1 << 63)))


def gray_index(fps: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(buckets, levels) over distinct fingerprints ``fp``.  Buckets: node, fps.  Levels, lowest
    first: node, parent, mask, pat, where the mask holds the bits that all fingerprints
    below the node share and the parent's do not, and the pattern their values."""
    ranked = materialize(fps.select("fp", F.lit(0).alias("all"), gray_rank("fp").alias("rank")), "gray-ranks")
    placed = numbered(ranked, ["all"], ["rank"]).select("fp", F.expr(f"at div {BUCKET}").alias("node"))
    shared = lambda least, most: (F.bit_and(least).alias("ones"), F.bit_or(most).alias("any"))
    buckets = materialize(placed.groupBy("node").agg(*shared("fp", "fp"), F.collect_list("fp").alias("fps")), "gray-buckets")
    whole = [buckets.select("node", "ones", "any")]
    while whole[-1].count() > 1:
        up = whole[-1].groupBy(F.expr(f"node div {FANOUT}").alias("node")).agg(*shared("ones", "any"))
        whole.append(materialize(up, "gray-nodes"))
    levels = []
    for own, above in zip(whole, whole[1:] + [None]):
        mask = F.bitwise_not(F.col("ones").bitwiseXOR(F.col("any")))
        node = own.select("node", F.expr(f"node div {FANOUT}").alias("parent"), mask.alias("mask"), F.col("ones").alias("pat"))
        if above is not None:
            held = above.select(F.col("node").alias("parent"), mask.alias("held"))
            node = node.join(held, "parent").select("node", "parent", F.col("mask").bitwiseAND(F.bitwise_not("held")).alias("mask"),
                                                    F.col("pat").bitwiseAND(F.bitwise_not("held")).alias("pat"))
        levels.append(node)
    return buckets.select("node", "fps"), levels


def surviving_pairs(levels: list[DataFrame], distance: int) -> DataFrame:
    """(a, b), a <= b: buckets that may hold a link, by descent from (root, root).  A pair
    carries both nodes' accumulated masks and patterns and the differences so far."""
    pairs = levels[-1].select(F.col("node").alias("a"), F.col("node").alias("b"), F.col("mask").alias("mask_a"), F.col("pat").alias("pat_a"),
                              F.col("mask").alias("mask_b"), F.col("pat").alias("pat_b"), F.lit(0).alias("far"))
    for level in reversed(levels[:-1]):
        x, y = (level.select(F.col("node").alias(f"to_{s}"), F.col("parent").alias(s), F.col("mask").alias(f"own_{s}"),
                             F.col("pat").alias(f"bits_{s}")) for s in "ab")
        met = pairs.join(x, "a").join(y, "b").filter("to_a <= to_b")
        common = "((mask_a | own_a) & (mask_b | own_b) & ~(mask_a & mask_b))"
        met = met.selectExpr("to_a AS a", "to_b AS b", "mask_a | own_a AS mask_a", "pat_a | bits_a AS pat_a", "mask_b | own_b AS mask_b",
                             "pat_b | bits_b AS pat_b", f"far + bit_count(((pat_a | bits_a) ^ (pat_b | bits_b)) & {common}) AS far")
        pairs = materialize(met.filter(F.col("far") <= distance), "gray-pairs")
    return pairs.select("a", "b")


def _spanning(u: np.ndarray, v: np.ndarray) -> pd.DataFrame:
    """Those of the links that join two parts: the same components from fewer rows."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = up
        return x
    kept = []
    for x, y in zip(u.tolist(), v.tolist()):
        p, q = root(x), root(y)
        if p != q:
            parent[p] = q
            kept.append((x, y))
    return pd.DataFrame(kept, columns=["u", "v"]).astype("int64")


def _meet(distance: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            us, vs = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for at in range(0, len(rows), MEETINGS):
                part = rows.iloc[at:at + MEETINGS]
                for a, b, x, y in zip(part["a"], part["b"], part["fps_a"], part["fps_b"]):
                    near = np.bitwise_count((x[:, None] ^ y[None, :]).view(np.uint64)) <= distance      # of signed numbers it counts |x|
                    i, j = np.nonzero(np.triu(near, 1) if a == b else near)
                    us.append(x[i])
                    vs.append(y[j])
            yield _spanning(np.concatenate(us), np.concatenate(vs))
    return run


def links(buckets: DataFrame, levels: list[DataFrame], distance: int = DISTANCE) -> DataFrame:
    """(u, v): fingerprints at most ``distance`` bits apart, reduced inside every batch of
    bucket pairs to links that connect the same fingerprints."""
    pairs = surviving_pairs(levels, distance)
    one = pairs.join(buckets.select(F.col("node").alias("b"), F.col("fps").alias("fps_b")), "b")
    both = dealt_by(one, "a").join(buckets.select(F.col("node").alias("a"), F.col("fps").alias("fps_a")), "a")
    return both.mapInPandas(_meet(distance), "u long, v long")


# ------------------------------------------------------------------ operator
def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                    distance: int = DISTANCE) -> DataFrame:
    """One row per row of ``docs``: id, fingerprint (16 hex digits), component_id.

    * Words are what the six ASCII spaces separate, A-Z lower-cased; a text with fewer words
      than ``width`` is one shingle.  Null texts and texts without words have fingerprint
      zero and are linked like any other.
    * Rows are linked when their fingerprints differ in at most ``distance`` bits;
      component_id is the smallest id reachable.
    * Rows with a null id carry links like any other; a component of null ids only has a
      null component_id.  Rows that share an id each have their own fingerprint and component.
    * Equal fingerprints meet once, as one; one that a third of all rows have is combined
      inside the map tasks and looked up by broadcast.
    * Empty table: empty result; other columns are ignored."""
    bounded_batches(docs.sparkSession)
    text = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    sketch = materialize(text.mapInPandas(_sketch(width), "id long, fp long"), "fingerprints")
    reps = materialize(sketch.groupBy("fp").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")), "distinct-fingerprints")
    buckets, levels = gray_index(reps.select("fp"))
    near = connected_components(links(buckets, levels, distance), "u", "v").withColumnRenamed("node", "fp")
    near = materialize(near.join(reps, "fp").select("fp", "component", "rep"), "near-fingerprints")
    least = near.groupBy("component").agg(F.min("rep").alias("component_id"), F.count(F.lit(1)).alias("members"))
    placed = look_up(near.select("fp", "component"), materialize(least, "near-components"), "component", F.col("members"), near.count())
    known = materialize(reps.join(placed.select("fp", "component_id"), "fp", "left").select(
        "fp", "copies", F.coalesce("component_id", "rep").alias("component_id")), "fingerprint-components")
    out = look_up(sketch, known, "fp", F.col("copies"), sketch.count())
    return out.select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
