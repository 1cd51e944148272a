"""Mix sources to target weights by pivotal dependent rounding.

Every document of a source gets the same copy rate (target / size of the source); the
whole part is taken for certain, the fraction by dependent rounding.  Two fractional
documents are paired and probability mass, weighed by size, moves at random from one
to the other until one is integral: expected copies and the source's words stay as
they are.  Each chunk of a source leaves at most one fractional document; these
residuals are paired again chunk by chunk, level by level, until a source has one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from cinerank.config import materialize
from cinerank.llm.common import FILTER_BITS, WORD, key_bitmap, maybe_in, packed, row_identity, text_of
from cinerank.llm.ordering import numbered

WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
CHUNK = 4096             # documents of one source paired in one group
FAN_IN = 1024            # residuals that meet in one group of the reduction tree
ITEM = "key string, source string, size long, chunk long, r long, p double"
DOMINANT = 16
EDGE = 1e-9              # a probability this near 0 or 1 is integral


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def ranked_sources(sizes: DataFrame) -> DataFrame:
    """source, total, docs, rank (from 0, by code point, null last).  The rank is taken
    within range partitions and shifted by the rows of the partitions before, so no
    task sees all sources."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("total"), F.count(F.lit(1)).alias("docs"))
    order = [F.col("source").isNull(), F.col("source")]
    ranged = materialize(per.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "sources")
    counts = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))      # one row per partition
    before = counts.select("part", (F.sum("n").over(W.Window.orderBy("part")) - F.col("n")).alias("before"))
    local = F.row_number().over(W.Window.partitionBy("part").orderBy(*order)) - 1
    return ranged.withColumn("local", local).join(before, "part").select(
        "source", "total", "docs", (F.col("local") + F.col("before")).alias("rank"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """source, total, docs, target: all words shared by weight, a target stops at ``most``
    times its source's words, and the excess is shared again among the others by weight
    until none is above.  Each round is one aggregate over the sources."""
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights)).cast("int") + 1)
    src = materialize(ranked_sources(sizes).withColumn("w", w).withColumn("cap", F.col("total") * float(most)), "targets")
    left, per_weight, above = None, 0.0, -1
    while True:
        stops = F.col("cap") < per_weight * F.col("w") if left is not None else F.lit(False)
        r = src.agg(F.sum("total").cast("double").alias("all"), F.sum(F.when(stops, F.col("cap"))).alias("capped"),
                    F.sum(F.when(~stops, F.col("w"))).alias("open"), F.count_if(stops).alias("above")).first()
        if r["all"] is None or not r["open"] or r["above"] == above:
            break
        above, left, open_w = r["above"], r["all"] - (r["capped"] or 0.0), r["open"]
        per_weight = left / open_w
    if left is None:
        return src.select("source", "total", "docs", F.lit(0.0).alias("target"))
    return src.select("source", "total", "docs", F.least("cap", F.lit(left) * F.col("w") / F.lit(open_w)).alias("target"))


def _settle(p: np.ndarray, i: int) -> bool:
    """Make p[i] integral where it is within EDGE of 0 or 1; whether it is."""
    if EDGE < p[i] < 1 - EDGE:
        return False
    p[i] = round(p[i])
    return True


def pair_up(size: np.ndarray, p: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Pivotal rounding of one group given largest first: all but at most one of the
    returned probabilities are 0 or 1, and sum(size * p) is unchanged up to rounding.

    A document that outweighs the rest (its square is over 1 / DOMINANT of the rest's sum of
    squares) has no partner of its size; it is paired with all the rest at once, which
    move by one common step, so that it too becomes integral at the words' expense of
    many.  Expected copies are unchanged by either step."""
    p = p.copy()
    rest_squares = np.append(np.cumsum((size ** 2)[::-1])[::-1], 0.0)
    rest_words = np.append(np.cumsum(size[::-1])[::-1], 0.0)
    again = (u * 2.0 ** 20) % 1.0           # a second draw: the lower bits of the first
    held = -1
    for i in range(len(p)):
        if _settle(p, i):
            continue
        if held < 0:
            held = i
            continue
        if DOMINANT * size[held] ** 2 > rest_squares[i] and np.all((p[i:] > EDGE) & (p[i:] < 1 - EDGE)):
            words = rest_words[i]
            gain = min((1 - p[held]) * size[held], p[i:].min() * words)
            loss = min(p[held] * size[held], (1 - p[i:].max()) * words)
            move = gain if again[i] * (gain + loss) < loss else -loss
            p[held] += move / size[held]
            p[i:] -= move / words
            if _settle(p, held):
                held = -1
        if held >= 0 and not _settle(p, i):
            a, b = size[held], size[i]
            gain, loss = min((1 - p[held]) * a, p[i] * b), min(p[held] * a, (1 - p[i]) * b)
            move = gain if u[i] * (gain + loss) < loss else -loss
            p[held] += move / a
            p[i] -= move / b
            held = -1 if _settle(p, held) else held
        if not _settle(p, i):
            held = i
    return p


def _round_group(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["size", "r", "key"], ascending=[False, True, True], kind="stable", na_position="last")
    u = (rows["r"].to_numpy(np.int64).view(np.uint64) >> np.uint64(11)) * 2.0 ** -53
    return rows.assign(p=pair_up(rows["size"].to_numpy(float), rows["p"].to_numpy(float), u))


def dependent_rounding(items: DataFrame, levels: int, seed: int, fan_in: int = FAN_IN) -> DataFrame:
    """Items (see ITEM) with p rounded to 0 or 1.  Every level writes its result; settled
    rows stay, the residual of each group goes on to the next level, ``fan_in`` to a
    group.  The one residual a source ends with takes the nearer whole number."""
    settled, rest = [], items
    for level in range(levels + 1):
        done = materialize(rest.groupBy("source", "chunk").applyInPandas(_round_group, ITEM), f"mix-level{level}")
        whole = F.col("p").isin(0.0, 1.0)
        settled.append(done.filter(whole))
        rest = (done.filter(~whole).withColumn("chunk", F.floor(F.col("chunk") / fan_in))
                .withColumn("r", F.xxhash64("key", "r", F.lit(seed + level + 1))))
    settled.append(rest.withColumn("p", F.round("p")))
    out = settled[0]
    for part in settled[1:]:
        out = out.unionByName(part)
    return out


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, seed: int = 17, chunk: int = CHUNK,
        fan_in: int = FAN_IN) -> DataFrame:
    """One row per row of ``docs``: id, size, source_size, target, copies, taken.

    * size: words of the text (null text: 0); taken = copies * size; copies <= ``most``.
    * Draws hash the id and ``seed``, groups depend on ids, sizes and counts alone: reruns
      agree on any cluster.  Rows with equal or null ids draw alike but are rounded one by one.
    * A source is dealt into chunks of ``chunk`` rows in hash order of the ids, so no group is
      larger whatever the source, and however often an id repeats.  Empty texts (which carry no
      words to move) take their source's whole copies only.
    * Sources without words get target 0.  Empty table: empty result; other columns are
      ignored."""
    ided = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                       word_count(text_of(text_col)).alias("size"))
    sizes = materialize(ided, "mix-sizes")
    # rows that tie in id and size are alike, so their order among themselves does not matter
    order = sizes.select("*", F.coalesce(F.concat(F.lit("="), "source"), F.lit("-")).alias("group"), F.xxhash64("id", F.lit(seed + 1)).alias("hash"),
                         F.monotonically_increasing_id().alias("tie"))
    placed = numbered(order, ["group"], ["hash", "id", "size", "tie"])
    goal = materialize(targets(sizes, weights, most), "mix-targets")
    most_docs = goal.agg(F.max("docs")).first()[0] or 0
    levels, groups = 0, -(-most_docs // chunk)
    while groups > 1:
        levels, groups = levels + 1, -(-groups // fan_in)
    per_source = goal.withColumn("rate", F.when(F.col("total") > 0, F.col("target") / F.col("total")).otherwise(0.0))
    dealt = (placed.alias("s").join(per_source.alias("g"), F.col("s.source").eqNullSafe(F.col("g.source")))
             .select("s.id", "s.source", "s.size", "s.at", "g.rate"))
    r = F.xxhash64("id", F.lit(seed))
    whole = F.floor(F.col("rate") + EDGE)
    items = dealt.select(F.col("id").cast("string").alias("key"), "source", "size",
                         F.floor(F.col("at") / chunk).alias("chunk"), r.alias("r"),
                         F.greatest(F.col("rate") - whole, F.lit(0.0)).alias("p"))
    rounded = dependent_rounding(items.filter("size > 0"), levels, seed, fan_in).select("key", "source", "size", "p")
    rounded = rounded.unionByName(items.filter("size = 0").select("key", "source", "size", F.lit(0.0).alias("p")))
    copies = (F.floor(F.col("rate") + EDGE) + F.col("p")).cast("long")
    id_type = docs.schema[id_col].dataType
    return (rounded.alias("d").join(per_source.alias("g"), F.col("d.source").eqNullSafe(F.col("g.source")))
            .select(F.col("d.key").cast(id_type).alias(id_col), F.col("d.size").alias("size"),
                    F.col("g.total").alias("source_size"), F.col("g.target").alias("target"),
                    copies.alias("copies"), (copies * F.col("d.size")).alias("taken")))


def apply_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
              weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, seed: int = 17) -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it; rows it does not take
    are gone.  Columns are unchanged.  Rows that repeat in every column share the copies
    drawn for them."""
    keyed = packed(docs, row_identity(docs, id_col))
    mixed = mix(keyed.select("key", F.col(f"row.`{text_col}`").alias("text"), F.col(f"row.`{source_col}`").alias("source")),
                "key", "text", "source", weights, most, seed)
    copies = materialize(mixed.groupBy("key").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("n"))
                         .filter("copies > 0"), "mix-copies")
    single, repeated = (copies.filter(f).select("key", "copies") for f in ("n = 1", "n > 1"))
    suspects = maybe_in(keyed, F.xxhash64("key"), key_bitmap(repeated, F.xxhash64("key"), FILTER_BITS), FILTER_BITS)
    taken = keyed.join(single, "key").unionByName(suspects.join(repeated, "key").dropDuplicates(["key"]))
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")
