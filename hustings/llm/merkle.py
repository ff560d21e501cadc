"""Merkle manifest of a table: a tree of digests for each group, and one over the groups.

Rows become leaves, the digest of their columns, each written as its length in bytes, a colon and its
value, or ``-`` if it is null. Within a group leaves ascend by ``order``. Their places are counted
without bringing a group together: rows are sorted by ranges, counted for each range, and a range
starts where the ranges before it end.

A level of the tree takes eight consecutive nodes together, the last run as many as there are. Places
are cut into blocks of whole runs and a window over each block gives every node the seven nodes before
and after it, at fixed offsets; those that lie outside the node's own run, by its slot and the run's
length, are masked. What is left of the mask is the node's siblings; the first child of a run hashes
the whole run, and these rows are the nodes of the next level. Levels shrink by eight, each is stored,
and a group that has come down to one node passes through unchanged. The groups' roots are the leaves of
one more tree, ordered by group.

Proofs go down again, a level at a time: a node's path is its own siblings and then its parent's path,
found by (group, place of the parent), a key that eight rows share at most.

Null groups are a group of their own and come first. Rows with a null order come first in their group,
rows of equal order follow their digests, and rows that are equal in all columns are interchangeable.
A table without rows gives no rows. Extra columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hustings.llm import common

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PATH = "array<struct<left:string,right:string>>"
#: Runs in a block, which one window partition holds.
RUNS = 64


def framed(value: Column) -> Column:
    """``-`` for null, else the length in bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts one after the other."""
    return F.sha2(F.concat(*parts), 256)


def row_digest(values: Sequence[Column]) -> Column:
    return digest(*map(framed, values))


def lower_ascii(text: Column) -> Column:
    """A-Z in small letters, everything else as it is. A text of ASCII alone takes the quick way."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, CAPITALS, SMALL))


def placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with place (from 0) and n, the number of rows, within ``grp``, which is never null."""
    by = [F.col("grp"), *[F.col(c).asc_nulls_first() for c in order], F.col("tie")]
    tied = rows.withColumn("tie", F.monotonically_increasing_id())  # spreads equal rows over ranges, too
    at = tied.repartitionByRange(*by).sortWithinPartitions(*by).drop("tie").withColumn("at", F.monotonically_increasing_id())
    at = common.store(at)
    part = F.shiftright("at", 33)
    ranges = at.groupBy("grp", part.alias("part")).agg(F.count("*").alias("rows"), F.min("at").alias("first"))
    whole = Window.partitionBy("grp")  # a row for each range
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(F.col("grp").alias("of"), "part", F.sum("rows").over(whole).alias("n"),
                           (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return at.join(ranges, (F.col("grp") == F.col("of")) & (part == F.col("part"))) \
        .withColumn("place", F.col("at") + F.col("shift")).drop("of", "part", "shift", "at")


def level(nodes: DataFrame, width: int) -> DataFrame:
    """Nodes (grp, place, n, h, ...) with the digests left and right of each in its run, and for the
    first child the parent's digest."""
    slot = F.col("place") % width
    run = F.least(F.lit(width), F.col("n") - F.col("place") + slot)
    block = F.floor(F.col("place") / (width * RUNS))
    near = Window.partitionBy("grp", block).orderBy("place")
    left = [F.when(slot >= k, F.lag("h", k).over(near)) for k in range(width - 1, 0, -1)]
    right = [F.when(slot + k < run, F.lead("h", k).over(near)) for k in range(1, width)]
    alone = F.col("n") == 1
    return nodes.withColumns({"left": F.concat_ws("", *left), "right": F.concat_ws("", *right)}) \
        .withColumn("parent", F.when(slot == 0, F.when(alone, F.col("h")).otherwise(digest(F.col("h"), F.col("right")))))


def climb(nodes: DataFrame, width: int) -> tuple[list[DataFrame], DataFrame]:
    """The stored levels from the leaves up, and the last nodes, one for each group."""
    levels, most = [], nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        levels.append(common.store(level(nodes, width)))
        nodes = levels[-1].where("parent IS NOT NULL").select(
            "grp", F.floor(F.col("place") / width).alias("place"), F.ceil(F.col("n") / width).alias("n"),
            F.col("parent").alias("h"))
        most = -(-most // width)
    return levels, nodes


def descend(levels: list[DataFrame], top: DataFrame, width: int, carried: Sequence[str]) -> DataFrame:
    """The rows of the lowest level with their path to the top, and what the top's rows carry."""
    for nodes in reversed(levels):
        above = top.select(F.col("grp").alias("of"), F.col("place").alias("up"), F.col("path").alias("rest"), *carried)
        own = F.when(F.col("n") > 1, F.array(F.struct("left", "right"))).otherwise(F.array().cast(PATH))
        top = nodes.join(above, (F.col("grp") == F.col("of")) & (F.floor(F.col("place") / width) == F.col("up"))) \
            .withColumn("path", F.concat(own, "rest")).drop("of", "up", "rest", "left", "right", "parent")
    return top


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings on the way up lead to."""
    return F.aggregate(path, leaf, lambda h, run: digest(run["left"], h, run["right"]))


def manifest(rows: DataFrame, group: str, order: str, columns: Sequence[str], changed: dict[str, Column] | None = None,
             width: int = 8) -> DataFrame:
    """(``order``, leaf, subroot, root, proof_sha256, folded_root, verified), a row for each row.

    ``columns`` make the leaf. ``changed`` names columns whose value is another one when the proof is
    checked: folded_root starts from the leaf with these values and goes up by the siblings of the
    original, and verified tells whether it comes to the root. proof_sha256 is the digest of all
    siblings from the leaf up, those over the groups included.
    """
    now = [(changed or {}).get(c, F.col(c)) for c in columns]
    leaves = rows.select(F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-")).alias("grp"),
                         F.col(order).alias("of_order"), row_digest([F.col(c) for c in columns]).alias("h"),
                         *([row_digest(now).alias("checked")] if changed else []))
    levels, tops = climb(placed(common.store(leaves), ["of_order", "h"]), width)

    groups = tops.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "h")
    over, root = climb(placed(groups, ["name"]), width)
    root = root.withColumns({"root": F.col("h"), "path": F.array().cast(PATH)})
    names = descend(over, root, width, ["root"]).select(F.col("name").alias("of"), F.col("path").alias("path"), "root")

    top = tops.join(names, F.col("grp") == F.col("of")).drop("of").withColumn("subroot", F.col("h"))
    out = descend(levels, top, width, ["subroot", "root"])
    proof = F.aggregate("path", F.lit(""), lambda all_, run: F.concat(all_, run["left"], run["right"]))
    back = folded(F.col("checked") if changed else F.col("h"), F.col("path"))
    out = out.select(F.col("of_order").alias(order), F.col("h").alias("leaf"), "subroot", "root",
                     F.sha2(proof, 256).alias("proof_sha256"), back.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
