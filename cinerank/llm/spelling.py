"""Groups of spelling variants: words of a corpus that are one edit apart.

Words are counted over the whole corpus, then matched by dense tiling: words become rows of
padded code-point matrices, one aligned at the left and one at the right, and a tile
compares every word of a block with every word of another.  The length of the common prefix
is the number of leading equal columns, that of the common suffix the number of trailing
ones; when both together reach the longer length minus one, the words are one edit apart.

Which blocks meet: prefix + suffix >= longer - 1 means that the longer half of what is
equal, m // 2 code points for a longer length of m, stands at the front or at the back of
both words.  So blocks are formed of words that share (m, side, those code points); a group
of any size is cut into blocks of 512, and every pair of its blocks is a tile of its own.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.config import materialize
from cinerank.llm.common import bounded_batches, text_of
from cinerank.llm.ordering import dealt_by, numbered

LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5              # a form is at least so many times as frequent
SLIP = 199             # where this divides the run's crc32, a code point is deleted
BLOCK = 512            # words of one side of a tile
HELD = 200_000         # distinct words that a counting task holds before it hands them on

# Latin-1 bytes of a text: letters stay (A-Z lower-cased), everything else separates.
_LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0xC0 else 0x20 for b in range(256))


# ------------------------------------------------------------------ words
def runs(text: str) -> list[bytes]:
    """Maximal runs of [A-Za-z\\u00C0-\\u00FF] in Latin-1, A-Z lower-cased."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split()


def slipped(run: bytes, seed: int) -> bytes:
    """The run, without one code point where SLIP divides its crc32 (``seed`` is the crc32 of
    what stands before it)."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
    if h % SLIP:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _count(least: int, held: int):
    def written(counts: Counter) -> pd.DataFrame:
        return pd.DataFrame({"word": [w.decode("latin-1") for w in counts], "n": list(counts.values())})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for rows in batches:
            for prefix, text in zip(rows["prefix"], rows["text"]):
                seed = None if prefix is None else zlib.crc32(prefix.encode())
                for word, n in Counter(runs(text)).items():
                    if len(word) >= least:
                        kept = word if seed is None else slipped(word, seed)
                        if len(kept) >= least:
                            counts[kept] += n
                if len(counts) >= held:
                    yield written(counts)
                    counts = Counter()
        if counts:
            yield written(counts)
    return run


def vocabulary(docs: DataFrame, id_col: str, text_col: str, least_length: int, least_count: int) -> DataFrame:
    """(word, n): words of at least the length and count over all of ``docs``."""
    text = docs.select(F.concat(F.col(id_col).cast("string"), F.lit(":")).alias("prefix"), text_of(text_col).alias("text"))
    counted = text.mapInPandas(_count(least_length, HELD), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


# ------------------------------------------------------------------ tiles
def matrices(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points aligned left, aligned right, lengths); padding is -1 and -2 by turns in
    the two sides of a tile, so it never equals anything."""
    lengths = np.array([len(w) for w in words])
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.int32)
    rows = np.repeat(np.arange(len(words)), lengths)
    column = np.arange(len(points)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    left = np.full((len(words), lengths.max()), -1, np.int32)
    right = left.copy()
    left[rows, column] = points
    right[rows, np.repeat(lengths, lengths) - 1 - column] = points
    return left, right, lengths


def _leading(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many leading columns of every row of ``a`` equal those of every row of ``b``."""
    same, out = np.ones((len(a), len(b)), bool), np.zeros((len(a), len(b)), np.int32)
    for i in range(min(a.shape[1], b.shape[1])):
        same &= (a[:, i, None] == b[None, :, i]) & (a[:, i, None] >= 0)
        if not same.any():
            break
        out += same
    return out


def tile(a: list[str], b: list[str], longer: int, side: str) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of words one edit apart whose longer length is ``longer``.  Pairs that share
    the front belong to the tile of the front, so the tile of the back leaves them out."""
    (la, ra, na), (lb, rb, nb) = matrices(a), matrices(b)
    prefix, suffix = _leading(la, lb), _leading(ra, rb)
    most, differ = np.maximum(na[:, None], nb[None, :]), np.abs(na[:, None] - nb[None, :])
    equal = (differ == 0) & (prefix == most)
    near = (most == longer) & (differ <= 1) & ~equal & (prefix + suffix >= longer - 1)
    if side == "back":
        near &= prefix < longer // 2
    return np.nonzero(near)


def _meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For every word of a tile with near words: how many, and the best of them."""
    for rows in batches:
        words, others, counts = [], [], []
        for longer, side, a, b, words_a, ns_a, words_b, ns_b in zip(*(rows[c] for c in (
                "longer", "side", "a", "b", "words_a", "ns_a", "words_b", "ns_b"))):
            i, j = tile(list(words_a), list(words_b), longer, side)
            if a != b:                                   # a block meets itself in both directions
                words.append(words_b[j]), others.append(words_a[i]), counts.append(ns_a[i])
            words.append(words_a[i]), others.append(words_b[j]), counts.append(ns_b[j])
        if words:
            met = pd.DataFrame({"word": np.concatenate(words), "other": np.concatenate(others), "other_n": np.concatenate(counts)})
            best = met.sort_values(["other_n", "other"], ascending=[False, True], kind="stable").groupby("word", sort=False)
            yield best.agg(n_near=("other", "size"), near=("other", "first"), near_n=("other_n", "first")).reset_index()


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, near, near_n) of the words (word, n) that have near words: their number
    and the most frequent one, ties to the smallest in code-point order."""
    length = F.length("word")
    keyed = words.select("word", "n", F.explode(F.array(length, length + 1)).alias("longer"))
    half = F.expr("longer div 2").cast("int")
    sides = F.explode(F.array(*[F.struct(F.lit(s).alias("side"), e.alias("affix")) for s, e in (
        ("front", F.left("word", half)), ("back", F.right("word", half)))]))
    keyed = keyed.select("word", "n", "longer", sides.alias("s")).select("word", "n", "longer", "s.side", "s.affix")
    group = ["longer", "side", "affix"]
    placed = numbered(keyed, group, ["word"]).withColumn("block", F.expr(f"at div {BLOCK}"))
    blocks = materialize(placed.groupBy(*group, "block").agg(F.collect_list(F.struct("word", "n")).alias("w")).select(
        *group, "block", F.col("w.word").alias("words"), F.col("w.n").alias("ns")), "word-blocks")
    # block numbers meet first; the words follow by (group, block), so a hot group is many keys
    pairs = (blocks.filter((F.col("block") > 0) | (F.size("words") > 1)).select(*group, F.col("block").alias("b"))
             .select(*group, "b", F.explode(F.sequence(F.lit(0).cast("long"), "b")).alias("a")))
    one, two = (blocks.select(*group, F.col("block").alias(s), F.col("words").alias(f"words_{s}"), F.col("ns").alias(f"ns_{s}")) for s in "ab")
    tiles = dealt_by(pairs.join(one, [*group, "a"]), *group, "b").join(two, [*group, "b"])
    met = tiles.mapInPandas(_meet, "word string, n_near long, near string, near_n long")
    first = F.min(F.struct((-F.col("near_n")).alias("rank"), F.col("near"))).alias("m")
    return met.groupBy("word").agg(F.sum("n_near").alias("n_near"), first).select(
        "word", "n_near", F.col("m.near").alias("near"), (-F.col("m.rank")).alias("near_n"))


# ------------------------------------------------------------------ operator
def roots_of(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form) links: where following them ends.  Pointers are doubled, and
    a form is RATIO times as frequent as its word, so a handful of rounds is enough."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = now.join(now.select(F.col("word").alias("root"), F.col("root").alias("next")), "root", "left")
        after = materialize(step.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        now = after.select("word", "root")
        if after.filter("moved").isEmpty():
            return now


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH,
             least_count: int = LEAST_COUNT, ratio: int = RATIO) -> DataFrame:
    """One row per word of the corpus: word, form, root, n, n_near, form_n.

    * Words are maximal runs of [A-Za-z\\u00C0-\\u00FF], A-Z lower-cased, with one code point
      deleted where SLIP divides the crc32 of ``<id>:<run>``; kept with at least
      ``least_length`` (2 or more) code points and ``least_count`` occurrences.
    * A word's form is its most frequent near word (ties: the smallest) if that is at least
      ``ratio`` (2 or more) times as frequent; root is where forms lead, the word itself
      without one.
    * Null and empty texts have no words; rows with a null id lose no code points; rows that
      repeat are counted each.
    * Empty table, or no words: empty result; other columns are ignored."""
    if least_length < 2 or ratio < 2:
        raise ValueError("least_length and ratio must be at least 2")
    bounded_batches(docs.sparkSession)
    words = materialize(vocabulary(docs, id_col, text_col, least_length, least_count), "words")
    near = near_words(words)
    high = F.col("near_n") >= ratio * F.col("n")
    judged = materialize(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(high, F.col("near")).alias("form"),
        F.when(high, F.col("near_n")).alias("form_n")), "spelling-forms")
    roots = roots_of(judged.filter("form is not null").select("word", "form"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
