"""Secret scan with corpus-wide ownership frequency.

Base kinds (fixed patterns) are found in every whole text.  A further pattern
collects credential-looking runs of no known form; how often a value's hash occurs
over distinct repositories and owners separates widely copied examples from
owner-specific, live-looking credentials, and only the latter become spans.

Only built-in DataFrame functions run here.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinerank.config import materialize
from cinerank.llm.common import text_of

# Fixed patterns: kind, pattern, group that holds the value, least length of that value.
BASE_KINDS = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]{16,}+", 0, 16),
)
OWNED = ("owned", r"[A-Za-z0-9+/_=-]{20,}+", 0, 20)
KINDS = tuple(k[0] for k in BASE_KINDS) + (OWNED[0],)
MAX_LIVE_OWNERS = 2      # a live value has at most so many owners
MAX_LIVE_REPOS = 4       # and lies in at most so many repositories, of all owners together
RUN = 64                 # matches whose positions are summed up one after the other
SPAN = "struct<start:bigint,kind:int,end:bigint,hash:string>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _runs(parts: Column, run: Callable[[Column, Column], Column]) -> Column:
    """``run(its number from 0, its parts)`` for every run of RUN consecutive parts."""
    last = F.greatest(F.ceil(F.size(parts) / RUN).cast("int") - 1, F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda i: run(i, F.slice(parts, i * RUN + 1, F.lit(RUN))))


def spans(text: Column, kind: int, pattern: str, group: int, least: int) -> Column:
    """Array of (start, kind, end, hash) of the leftmost non-overlapping matches whose
    value has ``least`` characters; code points, end exclusive, whole match; ``hash``
    is the value's digest.

    Positions are running sums of the lengths of the pieces between the matches and of the
    matches.  An array grows by copying, so the sums run within runs of RUN matches, after
    one pass for what each run adds: work grows in proportion to the matches."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), matches.alias("match"), values.alias("value"))
    parts = F.transform(zipped, lambda p: F.struct(
        F.length(p["gap"]).cast("bigint").alias("gap"), F.coalesce(F.length(p["match"]), F.lit(0)).cast("bigint").alias("match"),
        F.when(F.length(p["value"]) >= least, F.sha2(p["value"], 256)).alias("hash")))
    zero, longs = F.lit(0).cast("bigint"), F.array().cast("array<bigint>")
    none = F.array().cast(f"array<{SPAN}>")

    def step(acc: Column, p: Column) -> Column:
        start = acc["at"] + p["gap"]
        end = start + p["match"]
        found = F.array(F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), p["hash"].alias("hash")))
        return F.struct(end.alias("at"), F.when(p["hash"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], found)).alias("out"))

    def placed(p: Column) -> Column:
        lengths = _runs(p, lambda _, run: F.aggregate(run, zero, lambda s, x: s + x["gap"] + x["match"]))
        starts = F.aggregate(lengths, F.struct(zero.alias("at"), longs.alias("out")), lambda a, x: F.struct(
            (a["at"] + x).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")), lambda a: a["out"])
        return let(starts, lambda at: F.flatten(_runs(p, lambda i, run: F.aggregate(
            run, F.struct(F.get(at, i).alias("at"), none.alias("out")), step, lambda a: a["out"]))))
    return F.when(F.regexp_like(text, F.lit(pattern)), let(parts, placed)).otherwise(none)


def live_looking(text: Column, found: Column) -> Column:
    """Of spans, those whose text mixes upper case, lower case and digits."""
    def mixed(s: Column) -> Column:
        v = F.substring(text, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
        return F.regexp_like(v, F.lit("[A-Z]")) & F.regexp_like(v, F.lit("[a-z]")) & F.regexp_like(v, F.lit("[0-9]"))
    return F.filter(found, mixed)


def written(found: Column) -> Column:
    """``kind:start:end`` of spans in order, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def candidates(docs: DataFrame, text_col: str, owner_col: str, repo_col: str, keep: tuple[str, ...]) -> DataFrame:
    """``keep`` columns, owner, repo, text key, ``base`` and ``extra`` span arrays of
    every row; written once, so the texts are scanned once."""
    t = docs.select(*keep, F.col(owner_col).alias("owner__"), F.col(repo_col).alias("repo__"),
                    text_of(text_col).alias("text__"))
    text = F.col("text__")
    raw = t.select("*", *[spans(text, i, *k[1:]).alias(f"k{i}__") for i, k in enumerate((*BASE_KINDS, OWNED))])
    n = len(BASE_KINDS)
    return materialize(raw.select(
        *keep, "owner__", "repo__", F.sha2("text__", 256).alias("text_key"),
        F.array_sort(F.concat(*[F.col(f"k{i}__") for i in range(n)])).alias("base"),
        live_looking(text, F.col(f"k{n}__")).alias("extra")), "secret-candidates")


def ownership(found: DataFrame) -> DataFrame:
    """hash, n_owners, n_repos of every candidate value of the corpus.  Two aggregates
    that combine inside the map tasks, so a value copied into a third of all rows
    arrives as one row per owner, repository and task.  A null owner or repository
    counts as one of its own; a repository belongs to its owner."""
    seen = (found.select(F.explode(F.concat("base", "extra")).alias("s"), "owner__", "repo__")
            .groupBy(F.col("s.hash").alias("hash"), "owner__", "repo__").agg(F.lit(1).alias("one")))
    per_owner = seen.groupBy("hash", "owner__").agg(F.count("one").alias("repos"))
    return per_owner.groupBy("hash").agg(F.count("repos").alias("n_owners"), F.sum("repos").alias("n_repos"))


def scan_secrets(docs: DataFrame, text_col: str = "text", owner_col: str = "source", repo_col: str = "lang",
                 keep: tuple[str, ...] = ("doc_id",), max_live_owners: int = MAX_LIVE_OWNERS,
                 max_live_repos: int = MAX_LIVE_REPOS) -> DataFrame:
    """One row per row of ``docs``: ``keep`` columns, ``base`` (spans of the base kinds),
    ``all_spans`` (these and the owner-specific ones the method adds) and ``verdicts``
    (for each value found in the text: n_owners, n_repos, live).

    * A value is live when at most ``max_live_owners`` owners have it, in at most
      ``max_live_repos`` repositories, else a widely copied example.  Base spans stay whatever the verdict; an ``owned`` span needs a
      live value.  ``owned`` spans may overlap base ones.
    * Null or empty text: no spans.  Equal texts share their spans: occurrences meet the
      ownership counts once per distinct text, and the join back is a plain equi-join
      that adaptive execution may split, so repeated rows and hot copies are safe.
    * An empty table gives an empty result; other columns of ``docs`` are ignored."""
    found = candidates(docs, text_col, owner_col, repo_col, keep)
    occurrences = found.select("text_key", F.explode(F.concat("base", "extra")).alias("s")).distinct()
    judged = (occurrences.join(ownership(found), F.col("s.hash") == F.col("hash"))
              .select("text_key", F.struct("s.start", "s.kind", "s.end", "s.hash").alias("s"), "n_owners", "n_repos",
                      ((F.col("n_owners") <= max_live_owners) & (F.col("n_repos") <= max_live_repos)).alias("live")))
    owned = len(BASE_KINDS)
    per_text = materialize(judged.groupBy("text_key").agg(
        F.collect_list(F.when((F.col("s.kind") == owned) & F.col("live"), F.col("s"))).alias("added"),
        F.array_sort(F.collect_set(F.struct(F.col("s.hash").alias("hash"), "n_owners", "n_repos", "live"))).alias("verdicts")),
        "secret-verdicts")
    none = F.array().cast(f"array<{SPAN}>")
    return (found.join(per_text, "text_key", "left")
            .select(*keep, "base", F.array_sort(F.concat("base", F.coalesce("added", none))).alias("all_spans"),
                    "verdicts"))


def count_kind(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def total(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, cols)
