"""A Merkle manifest of a dataset, with the proof of every row, by a butterfly exchange.

Each row is a leaf; the leaves of a source in order of their ids are a tree,
and the trees' roots in order of the sources are the tree above them. Aligned
blocks of ``FANOUT ** BLOCK_LEVELS`` leaves are hashed by themselves. Then the
blocks swap: in each round, the ``FANOUT`` blocks whose numbers differ in one
digit hand each other the roots of the subtrees they stand in, and each hashes
the common ancestor for itself. After as many rounds as the block number has
digits, every block holds all upper siblings of its leaves and the root, and
nothing has to be sent down the tree. A last subtree that is not full has
fewer blocks than partners; each of them serves several in turn.

Nulls: a null value is the text ``-``; rows without a source are a tree of
their own, before the others; rows without an id come first in their tree.
Rows with equal ids are ordered by leaf, and equal rows stand side by side,
each with a proof of its own. Texts are hashed whole; an empty text is ``0:``.
An empty table has no rows and no root. Other columns are ignored, whatever
their names are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paywarden.llm.positions import numbered
from paywarden.llm.storage import saved, small

FANOUT = 16
BLOCK_LEVELS = 3
BLOCK = FANOUT**BLOCK_LEVELS
# Leaves whose paths are written at a time.
SLICE = 256
# Upper proofs take up to 1 KB a level, so fewer rows than usual are broadcast.
BROADCAST_PROOFS = 4096
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

# Nodes of a run before and after the one that is proved, level by level.
PATH = "array<struct<left: string, right: string>>"


def field(value: Column) -> Column:
    """A value with its length in UTF-8 bytes, so that different rows give different texts."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def fold(path: Column, leaf: Column) -> Column:
    """The root that follows from a leaf and its path."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def proof_digest(path: Column) -> Column:
    """The digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def joined_digest(nodes: list[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def levels_of(leaves: list[str], total: int) -> list[list[str]]:
    """The nodes of a block by level; a block of a larger tree is hashed to its full height."""
    levels = [leaves]
    while len(levels[-1]) > 1 if total <= BLOCK else len(levels) <= BLOCK_LEVELS:
        below = levels[-1]
        levels.append([joined_digest(below[i : i + FANOUT]) for i in range(0, len(below), FANOUT)])
    return levels


def block_roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        leaves, totals = batch.column("leaves"), batch.column("total")
        digests = [levels_of(leaves[i].as_py(), totals[i].as_py())[-1][0] for i in range(batch.num_rows)]
        names = ["tree", "block", "total"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(digests, pa.string())], [*names, "digest"])


def siblings(levels: list[list[str]]) -> list[list[tuple[str, str]]]:
    """Per level below the top, the nodes before and after each node in its run, as texts."""
    found = []
    for nodes in levels[:-1]:
        runs = [nodes[i : i + FANOUT] for i in range(0, len(nodes), FANOUT)]
        found.append([("".join(run[:k]), "".join(run[k + 1 :])) for run in runs for k in range(len(run))])
    return found


def leaf_paths(carried: list[str]):
    """A function for ``mapInArrow``: blocks with the path above them to leaves with their whole path."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                members = row.column("members").flatten()
                leaves = members.field("leaf").to_pylist()
                local = siblings(levels_of(leaves, row.column("total")[0].as_py()))
                above = [(step["left"], step["right"]) for step in row.column("path")[0].as_py()]
                for first in range(0, len(leaves), SLICE):
                    part = members.slice(first, SLICE)
                    steps = [
                        step
                        for at in range(first, first + len(part))
                        for step in (*(level[at // FANOUT**k] for k, level in enumerate(local)), *above)
                    ]
                    height = len(local) + len(above)
                    pairs = pa.StructArray.from_arrays(
                        [pa.array([s[side] for s in steps], pa.string()) for side in (0, 1)], ["left", "right"]
                    )
                    offsets = pa.array(range(0, height * len(part) + 1, height) if height else [0] * (len(part) + 1), pa.int32())
                    same = [pa.array([row.column(name)[0].as_py()] * len(part), pa.string()) for name in ("tree", "subroot", "root")]
                    yield pa.RecordBatch.from_arrays(
                        [*(part.field(name) for name in carried), part.field("leaf"), *same, pa.ListArray.from_arrays(offsets, pairs)],
                        [*carried, "leaf", "tree", "subroot", "root", "path"],
                    )

    return expand


def packed_blocks(leaves: DataFrame, order: list[Column], carried: list[str]) -> DataFrame:
    """Blocks of a tree with at most ``BLOCK`` members each, in order: ``tree``, ``block``, ``total``, ``members``."""
    placed = numbered(leaves, order, "tree")
    member = F.struct("position", "leaf", *carried)
    block = F.floor(F.col("position") / BLOCK).alias("block")
    packed = placed.groupBy("tree", block).agg(
        F.max("total").alias("total"), F.sort_array(F.collect_list(member)).alias("members")
    )
    return saved(packed, "blocks")


def swapped(state: DataFrame, stride: int) -> DataFrame:
    """One round: blocks whose numbers differ in one digit swap the roots of their subtrees of ``stride`` blocks."""
    block, blocks = F.col("block"), F.col("blocks")
    number = F.floor(block / stride)
    low = block % stride
    last = F.floor((blocks - 1) / stride)
    held = blocks - last * stride  # blocks in the last subtree
    alone = number % FANOUT == 0  # it has no partners in this round
    serves = F.when(
        (number == last) & (held < stride) & ~alone, F.sequence(low, F.lit(stride - 1).cast("bigint"), held)
    ).otherwise(F.array(low))
    sent = state.withColumns({"_low": low, "_number": number}).withColumn("_slot", F.explode(serves))
    run = F.floor(F.col("_number") / FANOUT)
    ring = Window.partitionBy("tree", run, "_slot")
    nodes = F.sort_array(F.collect_list(F.struct(F.col("_number").alias("number"), "digest")).over(ring))
    met = sent.withColumn("_nodes", nodes).where("_slot = _low")

    def text_of(keep) -> Column:
        return F.array_join(F.transform(F.filter("_nodes", keep), lambda node: node["digest"]), "")

    step = F.struct(
        text_of(lambda node: node["number"] < F.col("_number")).alias("left"),
        text_of(lambda node: node["number"] > F.col("_number")).alias("right"),
    )
    higher = blocks > stride  # else the tree is done
    return met.select(
        "tree",
        "block",
        "blocks",
        F.when(higher, F.sha2(text_of(lambda node: F.lit(True)), 256)).otherwise(F.col("digest")).alias("digest"),
        F.when(higher, F.concat("path", F.array(step))).otherwise(F.col("path")).alias("path"),
    )


def upper_paths(packed: DataFrame) -> DataFrame:
    """``tree``, ``block``, the tree's root as ``digest``, and the ``path`` from the block's root to it."""
    leaves = F.transform("members", lambda m: m["leaf"]).alias("leaves")
    roots = packed.select("tree", "block", "total", leaves).mapInArrow(
        block_roots, "tree string, block long, total long, digest string"
    )
    state = saved(
        roots.select("tree", "block", F.ceil(F.col("total") / BLOCK).alias("blocks"), "digest"), "roots"
    ).withColumn("path", F.array().cast(PATH))
    most = state.agg(F.max("blocks")).first()[0] or 0
    stride = 1
    while stride < most:
        state = swapped(state, stride)
        stride *= FANOUT
    return saved(state.drop("blocks"), "upper-paths")


def expanded(packed: DataFrame, above: DataFrame, carried: list[str]) -> DataFrame:
    """The leaves of the blocks with their paths; ``above`` has ``tree``, ``block``, ``subroot``, ``root`` and ``path``."""
    types = {f.name: f.dataType.simpleString() for f in packed.schema["members"].dataType.elementType}
    columns = [*(f"`{name}` {types[name]}" for name in carried), "leaf string", "tree string", "subroot string", "root string", f"path {PATH}"]
    joined = packed.join(small(above, BROADCAST_PROOFS), ["tree", "block"])
    given = joined.select("tree", "total", "members", "subroot", "root", "path")
    return given.mapInArrow(leaf_paths(carried), ", ".join(columns))


def build_manifest(docs: DataFrame, carry: dict[str, Column] | None = None) -> DataFrame:
    """``doc_id``, ``leaf``, ``subroot``, ``root`` and ``path`` of each row, and the columns of ``carry``.

    Texts are read once, for their leaves; from there on digests move. Names in
    ``carry`` are the caller's and must differ from those of the result.
    """
    carried = ["doc_id", *(carry or {})]
    source = F.col("source").cast("string")
    leaf = leaf_digest(*map(F.col, LEAF_COLUMNS))
    given = docs.select(
        F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("tree"),
        leaf.alias("leaf"),
        "doc_id",
        *(column.alias(name) for name, column in (carry or {}).items()),
    )
    packed = packed_blocks(saved(given, "leaves"), [F.col("doc_id").asc_nulls_first(), F.col("leaf")], carried)
    upper = upper_paths(packed)

    # The trees' roots are the leaves of one more tree, built alike.
    names = upper.where("block = 0").select(F.lit("").alias("tree"), F.col("digest").alias("leaf"), F.col("tree").alias("name"))
    top = packed_blocks(saved(names, "subroots"), [F.col("name")], ["name"])
    top_above = upper_paths(top).select("tree", "block", "path", F.lit("").alias("subroot"), F.col("digest").alias("root"))
    tops = saved(expanded(top, top_above, ["name"]).select("name", "root", F.col("path").alias("top_path")), "top-paths")

    above = upper.join(small(tops, BROADCAST_PROOFS), F.col("tree") == F.col("name")).select(
        "tree", "block", F.col("digest").alias("subroot"), "root", F.concat("path", "top_path").alias("path")
    )
    return expanded(packed, saved(above, "paths"), carried).drop("tree")
