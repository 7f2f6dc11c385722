"""A manifest of a dataset as a tree of hashes, with an inclusion proof for each row.

Each document is a leaf. Per language, leaves stand in the order of their ids; every ``FANOUT`` neighbours are hashed into
their parent, level by level, until one node remains, the subroot. Subroots, ordered by language, are the leaves of one
more tree, whose top is the root.

A level is one pass of window functions: lag and lead columns of fixed offsets, masked by a node's slot in its run and by
the length of that run, are its left and right siblings, and the first child of a run hashes its parent. Windows are cut
into blocks of a few runs, so a language with most of all rows is spread like any other. The way down again joins each
level with the level above it, an eighth of its size; texts are read once and only digests move.

Defined results: a null column counts as ``-``; a null language is a tree of its own and stands first; a null id stands
last in its tree and its row is never tampered with; equal ids are ordered by their leaves, and equal leaves are
interchangeable. A null, empty or long text is hashed as it is. An empty table gives no rows. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillbook.functions import ASC
from tillbook.llm.common import fold, stored
from tillbook.operators.ranking import global_position

FANOUT = 8

#: Runs of one window group: neighbours are looked up inside a run only, so any number serves.
RUNS_PER_BLOCK = 8

#: Parts into which the rows of a tree are dealt where they learn its size.
PARTS = 64

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Steps = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def encoded(column: Column) -> Column:
    """``-`` for null, else the number of bytes, a colon and the value, so that no two rows have the same encoding."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: Mapping[str, Column]) -> Column:
    return digest(*(encoded(column) for column in columns.values()))


def _levels(largest: int) -> int:
    """How many times the largest tree is folded until one node remains, but once at least."""
    levels = 1
    while FANOUT**levels < largest:
        levels += 1
    return levels


def _folded(nodes: DataFrame) -> DataFrame:
    """``nodes`` (tree, pos, n, digest and more) with ``left`` and ``right`` siblings, and ``parent`` on first children.

    A tree of one node (``n`` is 1) has reached its top; that node goes up as it is.
    """
    run = FANOUT * RUNS_PER_BLOCK
    by_block = Window.partitionBy("tree", F.expr(f"pos div {run}")).orderBy("pos")
    slot = F.col("pos") % FANOUT
    length = F.least(F.lit(FANOUT), F.col("n") - F.col("pos") + slot)
    left = [F.when(slot >= k, F.lag("digest", k).over(by_block)) for k in range(FANOUT - 1, 0, -1)]
    right = [F.when(slot + k < length, F.lead("digest", k).over(by_block)) for k in range(1, FANOUT)]
    seen = nodes.withColumns({"left": F.concat_ws("", *left), "right": F.concat_ws("", *right)})
    parent = F.when(F.col("n") == 1, F.col("digest")).otherwise(digest(F.col("digest"), F.col("right")))
    return seen.withColumn("parent", F.when(slot == 0, parent))


def _climbed(nodes: DataFrame, largest: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The levels of all trees, written one by one, and the top of each tree (tree, digest)."""
    levels = []
    for level in range(_levels(largest)):
        levels.append(stored(_folded(nodes), f"{name}-{level}"))
        nodes = levels[-1].filter("parent IS NOT NULL").select(
            "tree",
            F.expr(f"pos div {FANOUT}").alias("pos"),
            F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n"),
            F.col("parent").alias("digest"),
        )
    return levels, nodes.select("tree", "digest")


def _descended(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """The nodes of the lowest level with the ``steps`` from each to the root, lowest first, and what ``above`` (tree,
    steps and more) says of its tree."""
    more = [name for name in above.columns if name not in ("tree", "steps")]
    above = above.withColumn("up", F.lit(0).cast("long"))
    for number, level in reversed(list(enumerate(levels))):
        steps = above.select(F.col("tree").alias("in_tree"), "up", F.col("steps").alias("further"), *more)
        same = (F.col("tree") == F.col("in_tree")) & (F.expr(f"pos div {FANOUT}") == F.col("up"))
        own = F.array(F.struct("left", "right"))
        joined = level.join(steps, same).withColumn(
            "steps", F.when(F.col("n") == 1, F.col("further")).otherwise(F.concat(own, "further"))
        )
        above = joined if number == 0 else joined.select("tree", F.col("pos").alias("up"), "steps", *more)
    return above


def _numbered(rows: DataFrame) -> tuple[DataFrame, int]:
    """Rows (tree, doc_id, digest and more) with their place ``pos`` in their tree and its size ``n``; the largest size.

    Places come from one global sort, so no tree has to fit a task. What is known of a tree is a row, copied for each of
    the parts that its rows are dealt into: joined on the tree alone, a large one would be one task's here and, as
    windows then find their rows already together, in the next step as well.
    """
    placed = global_position(rows, [("tree", ASC), ("doc_id", ASC), ("digest", ASC)], "place")
    trees = placed.groupBy("tree").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long")))
    known = trees.withColumn("part", parts)
    nodes = placed.withColumn("part", F.col("place") % PARTS).join(known, ["tree", "part"])
    nodes = nodes.withColumn("pos", F.col("place") - F.col("first")).drop("place", "first", "part")
    return nodes, trees.agg(F.max("n").alias("n")).first()["n"] or 0


def proofs(docs: DataFrame, claims: Mapping[str, Column] | None = None, columns: tuple[str, ...] = COLUMNS) -> DataFrame:
    """``doc_id, leaf, claim, subroot, root, steps`` of each row.

    ``steps`` are the siblings to the ``left`` and to the ``right`` at each level from the leaf to the root. ``claim`` is
    the leaf that the row would have if the columns in ``claims`` had those values; that of the row itself without any.
    """
    own = {name: F.col(f"`{name}`") for name in columns}
    untouched = leaf(own)
    claim = leaf({**own, **claims}) if claims else untouched
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("")).alias("tree")  # "" sorts before any "=..."
    leaves = stored(docs.select("doc_id", tree, untouched.alias("digest"), claim.alias("claim")), "merkle-leaves")
    nodes, largest = _numbered(leaves)
    levels, subroots = _climbed(nodes, largest, "merkle-level")

    named = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("doc_id"), "digest")
    upper, roots = _climbed(*_numbered(named), "merkle-top")
    none = F.array().cast(Steps)
    tops = _descended(upper, roots.select("tree", F.col("digest").alias("root"), none.alias("steps")))
    above = tops.select(F.col("doc_id").alias("tree"), F.col("digest").alias("subroot"), "root", "steps")
    return _descended(levels, above).select("doc_id", F.col("digest").alias("leaf"), "claim", "subroot", "root", "steps")


def folded_root(claim: Column, steps: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(steps, claim, lambda node, step: digest(step["left"], node, step["right"]))


def proof_digest(steps: Column) -> Column:
    """The hash of all siblings, level by level, left to right."""
    return F.sha2(F.concat_ws("", F.transform(steps, lambda step: F.concat(step["left"], step["right"]))), 256)


def tampered() -> dict[str, Column]:
    """Values after tampering: A-Z of the text in lower case where 3 divides the crc32 of the id."""
    text = F.col("text")
    return {"text": F.when(fold("doc_id", 3) == 0, F.translate(text, UPPER, LOWER)).otherwise(text)}


def verified(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``: who tampered is told from who did not."""
    rows = proofs(docs, tampered()).withColumn("folded_root", folded_root(F.col("claim"), F.col("steps")))
    return rows.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("steps")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
