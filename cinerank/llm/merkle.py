"""Merkle manifest of a dataset in van Emde Boas layout.

Every document is a leaf, every source a tree of arity 16 over its leaves by id, and the
trees' roots form one more tree.  A tree is stored in blocks, aligned subtrees of at most
16^3 leaves; the block roots are the leaves of the next tier, and so on until one block is
left.  Inside a block the nodes lie in van Emde Boas order: the levels are split at half
height, first the top subtree, then every bottom subtree, each laid out the same way.
:func:`address` finds a node by arithmetic alone; construction reads children and retrieval
reads siblings through it.

A block is built and read by one task; a source of any size is many blocks, and positions
come from ranges (:func:`cinerank.llm.ordering.numbered`), so no task holds a whole source.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinerank.config import materialize
from cinerank.llm.common import ascii_lower, fold
from cinerank.llm.ordering import dealt_by, numbered

ARITY = 16
HEIGHT = 3                     # edges from a block's root to its leaves: 4,096 of them
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
HEX = 64                       # characters of a digest
LAST = "n_tree = n"            # a tier's single block of a tree: nothing above it
BLOCK_SCHEMA = "tree string, block long, n_tree long, n long, height int, nodes binary, root binary"


# ------------------------------------------------------------------ layout
def tree_size(levels: int) -> int:
    """Nodes of a full subtree with ``levels`` levels."""
    return (ARITY ** levels - 1) // (ARITY - 1)


def address(depth: int, index, levels: int):
    """Place of node ``index`` (a number or an array, from the left) at ``depth`` below the
    root in the layout of a full subtree with ``levels`` levels."""
    if levels == 1:
        return index * 0
    top = levels // 2
    if depth < top:
        return address(depth, index, top)
    below = ARITY ** (depth - top)
    return (tree_size(top) + index // below * tree_size(levels - top)
            + address(depth - top, index % below, levels - top))


def height_of(leaves: int, most: int) -> int:
    """Edges from the root to the leaves of a tree with so many leaves, at most ``most``."""
    height = 0
    while height < most and ARITY ** height < leaves:
        height += 1
    return height


def at_depth(leaves: int, height: int, depth: int) -> int:
    """Nodes at ``depth`` of a subtree with ``leaves`` leaves."""
    return -(-leaves // ARITY ** (height - depth))


def digest(text: bytes) -> bytes:
    return hashlib.sha256(text).digest()


def build_block(leaves: list[bytes], height: int) -> np.ndarray:
    """Digests (32 bytes each) of a subtree in layout order; absent nodes are zero."""
    levels = height + 1
    nodes = np.zeros((tree_size(levels), 32), np.uint8)
    nodes[address(height, np.arange(len(leaves)), levels)] = np.frombuffer(b"".join(leaves), np.uint8).reshape(-1, 32)
    for depth in range(height - 1, -1, -1):
        made = [digest(run) for run in run_texts(nodes, len(leaves), height, depth + 1)]
        nodes[address(depth, np.arange(len(made)), levels)] = np.frombuffer(b"".join(made), np.uint8).reshape(-1, 32)
    return nodes


def run_texts(nodes: np.ndarray, leaves: int, height: int, depth: int) -> list[bytes]:
    """Hex text of every run of siblings at ``depth``, read by address."""
    here = nodes[address(depth, np.arange(at_depth(leaves, height, depth)), height + 1)]
    text = here.tobytes().hex().encode()
    return [text[i:i + ARITY * HEX] for i in range(0, len(text), ARITY * HEX)]


def inner_paths(nodes: np.ndarray, leaves: int, height: int) -> list[list[tuple[int, bytes]]]:
    """For every leaf of a block the (place in its run, siblings) from its level upwards."""
    paths: list[list[tuple[int, bytes]]] = [[] for _ in range(leaves)]
    for depth in range(height, 0, -1):
        runs, step = run_texts(nodes, leaves, height, depth), ARITY ** (height - depth)
        for i, path in enumerate(paths):
            run, at = divmod(i // step, ARITY)
            path.append((at, runs[run][:at * HEX] + runs[run][(at + 1) * HEX:]))
    return paths


def folded(leaf: bytes, path: list[tuple[int, bytes]]) -> bytes:
    """The root that a leaf's hex digest and its siblings give, as hex."""
    for at, siblings in path:
        leaf = hashlib.sha256(siblings[:at * HEX] + leaf + siblings[at * HEX:]).hexdigest().encode()
    return leaf


def written(path: list[tuple[int, bytes]]) -> str:
    return "".join(f"{at}:{siblings.decode()};" for at, siblings in path)


def parsed(path: str) -> list[tuple[int, bytes]]:
    return [(int(at), siblings.encode()) for at, siblings in (step.split(":") for step in path.split(";")[:-1])]


# ------------------------------------------------------------------ tasks
def _build(most: int):
    def build(rows: pd.DataFrame, about: pd.DataFrame) -> pd.DataFrame:
        leaves, info = list(rows.sort_values("at", kind="stable")["digest"]), about.iloc[0]
        height = height_of(int(info["n_tree"]), most)
        nodes = build_block(leaves, height)
        return pd.DataFrame({"tree": [info["tree"]], "block": [info["block"]], "n_tree": [info["n_tree"]], "n": [len(leaves)], "height": [height],
                             "nodes": [nodes.tobytes()], "root": [nodes[0].tobytes()]})
    return build


def _paths_of(block: pd.DataFrame) -> tuple[list, list]:
    """(inner paths of the leaves, path of the block's root) of a block's one row."""
    row = block.iloc[0]
    nodes = np.frombuffer(row["nodes"], np.uint8).reshape(-1, 32)
    return inner_paths(nodes, int(row["n"]), int(row["height"])), parsed(row["path"])


def _lower_paths(rows: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
    inner, above = _paths_of(block)
    tail = written(above)
    rows = rows.sort_values("at", kind="stable")
    return pd.DataFrame({"name": rows["name"].to_numpy(), "tree": rows["tree"].to_numpy(), "at": rows["at"].to_numpy(),
                         "path": [written(p) + tail for p in inner]})


def _verify(rows: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
    inner, above = _paths_of(block)
    tail = b"".join(siblings for _, siblings in above)
    rows = rows.sort_values("at", kind="stable")
    leaves = [d.hex().encode() for d in rows["digest"]]
    changed = [leaf if d is None else d.hex().encode() for leaf, d in zip(leaves, rows["tampered"])]
    proofs = [hashlib.sha256(b"".join(s for _, s in p) + tail).hexdigest() for p in inner]
    folds = [folded(folded(leaf, p), above).decode() for leaf, p in zip(changed, inner)]
    return pd.DataFrame({"id": rows["id"].to_numpy(), "leaf": [x.decode() for x in leaves],
                         "subroot": block["subroot"].iloc[0], "proof_sha256": proofs, "folded_root": folds})


# ------------------------------------------------------------------ forest
def forest(entries: DataFrame, height: int) -> list[tuple[DataFrame, DataFrame]]:
    """Tiers of all trees of ``entries`` (tree, at, digest, more): for each tier its entries,
    with block, and its written blocks (BLOCK_SCHEMA) of at most ``height`` edges.
    A tree with more than one block goes on in the next tier, the block roots being its
    entries there."""
    tiers, block = [], ARITY ** height
    while True:
        placed = materialize(entries.withColumn("block", F.expr(f"at div {block}")), "merkle-entries")
        # the size of a tree joins its blocks, not its entries: a hot source is few blocks
        counts = materialize(placed.groupBy("tree", "block").agg(F.count(F.lit(1)).alias("n")), "merkle-counts")
        sizes = counts.groupBy("tree").agg(F.sum("n").alias("n_tree"))
        about = materialize(counts.join(sizes, "tree").select("tree", "block", "n_tree"), "merkle-sizes")
        blocks = materialize(_meet(placed.select("tree", "block", "at", "digest"), about, _build(height), BLOCK_SCHEMA), "merkle-blocks")
        tiers.append((placed, blocks))
        entries = blocks.filter(F.col("n_tree") > block).select(
            "tree", F.col("block").alias("at"), F.col("root").alias("digest"), F.lit(None).cast("string").alias("name"))
        if entries.isEmpty():
            return tiers


def roots(tiers: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(tree, root) of every tree: the root of its last, single block."""
    last = [blocks.filter(LAST).select("tree", "root") for _, blocks in tiers]
    out = last[0]
    for more in last[1:]:
        out = out.unionByName(more)
    return out


def _with_paths(tiers: list, above: DataFrame, down_to: int) -> DataFrame:
    """Blocks of tier ``down_to`` with the ``path`` of their roots: that of the tree (``above``:
    tree, path) for single blocks, else what the next tier's block holds for this leaf."""
    paths = None
    for tier in range(len(tiers) - 1, down_to - 1, -1):
        blocks = tiers[tier][1]
        own = blocks.filter(LAST).join(above, "tree")
        if paths is not None:
            own = own.unionByName(blocks.join(paths.select("tree", F.col("at").alias("block"), "path"), ["tree", "block"])
                                  .select(*own.columns))
        if tier > down_to:
            paths = materialize(_meet(tiers[tier][0].select("tree", "block", "at", "name"), own, _lower_paths,
                                      "name string, tree string, at long, path string"), "merkle-paths")
    return own


def _meet(entries: DataFrame, blocks: DataFrame, fn, schema: str) -> DataFrame:
    one = dealt_by(entries, "tree", "block").groupBy("tree", "block")
    other = dealt_by(blocks, "tree", "block").groupBy("tree", "block")
    return one.cogroup(other).applyInPandas(fn, schema)


def _stated(c: str) -> Column:
    text = F.col(f"`{c}`").cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(fields: tuple[str, ...], changed: Column | None = None) -> Column:
    """Digest of a row's fields, each null (``-``) or as byte count and value; ``changed`` in
    place of the last one."""
    parts = [_stated(c) for c in fields]
    if changed is not None:
        parts[-1] = F.coalesce(F.concat(F.octet_length(changed).cast("string"), F.lit(":"), changed), F.lit("-"))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, tampered_fold: int = 5,
             height: int = HEIGHT) -> tuple[DataFrame, DataFrame]:
    """(stored blocks, verified leaves) of ``docs``.

    Blocks: tier (0 above the documents; the tree over the sources follows the sources'
    tiers), tree, block, n_tree, n, height, nodes (layout order), root.  Leaves: doc_id, leaf,
    subroot, root, proof_sha256, folded_root, verified, all digests lowercase hex.

    * ``fields`` name id, source and, last, the text; a null field counts as ``-`` in a leaf.
    * Leaves ascend by id, null ids first; equal ids by leaf digest; rows that repeat in all
      fields are leaves of their own.  A null source is a tree of its own, before all others.
    * Where ``tampered_fold`` divides the id's crc32, A-Z of the text are lower-cased before
      the leaf is folded up again; null ids and null texts stay as they are.
    * Empty table: no blocks, no leaves.  Other columns are ignored."""
    spark, id_col, source, text = docs.sparkSession, fields[0], fields[1], fields[-1]
    lowered = ascii_lower(F.col(f"`{text}`"))
    hit = (fold(id_col, tampered_fold) == 0) & F.col(f"`{text}`").isNotNull()
    tree = F.coalesce(F.concat(F.lit("="), F.col(f"`{source}`").cast("string")), F.lit("-"))    # '-' sorts before '='
    leaves = materialize(docs.select(tree.alias("tree"), F.col(f"`{id_col}`").cast("long").alias("id"), leaf_of(fields).alias("digest"),
                                     F.when(hit, leaf_of(fields, lowered)).alias("tampered")), "merkle-leaves")
    trees = forest(materialize(numbered(leaves, ["tree"], ["id", "digest"]), "merkle-order"), height)
    subroots = materialize(roots(trees), "merkle-subroots")
    names = subroots.select(F.lit("*").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("digest"))
    top = forest(materialize(numbered(names, ["tree"], ["name"]), "merkle-top"), height)
    root = roots(top).first()                    # one digest; None where the table is empty
    stored = [blocks.select(F.lit(i).alias("tier"), "*") for i, (_, blocks) in enumerate(trees + top)]
    blocks = stored[0]
    for more in stored[1:]:
        blocks = blocks.unionByName(more)

    whole = spark.createDataFrame([("*", "")], "tree string, path string")
    tops = _meet(top[0][0].select("tree", "block", "at", "name"), _with_paths(top, whole, 0), _lower_paths,
                 "name string, tree string, at long, path string")
    above = materialize(tops.select(F.col("name").alias("tree"), "path"), "merkle-top-paths")
    ready = _with_paths(trees, above, 0).join(
        subroots.select("tree", F.lower(F.hex("root")).alias("subroot")), "tree").select("tree", "block", "n", "height", "nodes", "path", "subroot")
    out = _meet(trees[0][0].select("tree", "block", "at", "id", "digest", "tampered"), ready, _verify,
                "id long, leaf string, subroot string, proof_sha256 string, folded_root string")
    hex_root = F.lit(root["root"].hex() if root else None).cast("string")
    return blocks, out.select(F.col("id").alias(id_col), "leaf", "subroot", hex_root.alias("root"), "proof_sha256", "folded_root",
                              (F.col("folded_root") == hex_root).alias("verified"))
