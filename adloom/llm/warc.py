"""Fixity audit of archived pages with Merkle trees over key ranges.

Pages become archive records. A record's leaf is the SHA-256 of its bytes with its length; equal records of one page are one leaf
with their number of copies. Leaves stand in the order of page id, address and digest, which gives each its offset in the replica.
The order is cut into ranges by the leaves themselves: a leaf whose key hash ends in k zero hexadecimal digits starts a range of
level k. A node is named by the leaf that starts it and holds the SHA-256 of its children's digests and lengths in order. So a
record that is lost, added or repeated changes the range that it lies in and those above, and no other, however the replica was
numbered or ordered. Two replicas are compared from their roots: only the children of nodes that differ are looked at further
down, until the damaged records are left.

Range numbers and offsets come from distributed running totals over narrow columns, never from one task. A range holds 16 children
on average, more than 16 ln(n) with a chance below 1/n. A page's null columns are written as empty (a null id is -1); a record that
only one replica holds shows with no copies and no offset on the other side; an empty replica lacks everything; equal replicas give
no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.operators.ranking import running_totals
from adloom.session import materialize

FAN_OUT = 16


def record(url: Column, body: Column) -> Column:
    """The bytes of one response record."""
    text = F.coalesce(body.cast("string"), F.lit(""))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: "), F.coalesce(url.cast("string"), F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(text).cast("string"), F.lit("\r\n\r\n"),
    )
    return F.concat(head, text, F.lit("\r\n\r\n"))


def leaf(bytes_: Column) -> list[Column]:
    return [F.sha2(bytes_.cast("binary"), 256).alias("hash"), F.octet_length(bytes_).cast("long").alias("length")]


KEY = ["page", "url", "hash"]


def distinct(records: DataFrame) -> DataFrame:
    """One leaf (page, url, hash, length, copies, id, level) for each distinct record of (page, url, hash, length)."""
    leaves = records.groupBy(*KEY, "length").agg(F.count(F.lit(1)).alias("copies"))
    name = F.sha2(F.concat_ws("\n", F.col("page").cast("string"), "hash", "url").cast("binary"), 256)
    zeros = F.length(F.regexp_extract("id", "0*$", 0))
    return leaves.withColumn("id", name).withColumn("level", zeros)


def numbered(leaves: DataFrame, depth: int) -> DataFrame:
    """Leaves with their ``offset`` and the number of their range on each level below the root: n1, n2, …"""
    size = F.col("length") * F.col("copies")
    sums = {f"n{k}": F.when(F.col("level") >= k, F.lit(1)).otherwise(F.lit(0)).cast("bigint") for k in range(1, depth)}
    out = running_totals(leaves, KEY, sums | {"_end": size})
    return out.withColumns({"offset": F.col("_end") - size, f"n{depth}": F.lit(0).cast("bigint")}).drop("_end")


def parents(level: DataFrame, k: int, depth: int, order: list[str]) -> DataFrame:
    """Level ``k``: the ranges of the nodes (or leaves) below, each with id, level, digest and length."""
    child = F.struct(*order, "hash", "length", "copies")
    above = [F.max(f"n{j}").alias(f"n{j}") for j in range(k + 1, depth + 1)]
    first = F.when(F.lit(k) < depth, F.max(F.when(F.col("level") >= k, F.struct("id", "level"))))
    grouped = level.groupBy(f"n{k}").agg(
        F.sort_array(F.collect_list(child)).alias("c"), F.sum(F.col("length") * F.col("copies")).alias("length"), first.alias("first"), *above,
    )
    text = F.transform("c", lambda c: F.concat_ws(":", c["hash"], c["length"].cast("string"), c["copies"].cast("string")))
    return grouped.select(
        F.coalesce("first.id", F.lit("")).alias("id"), F.coalesce("first.level", F.lit(0)).alias("level"),
        F.sha2(F.array_join(text, ";").cast("binary"), 256).alias("hash"), "length", F.lit(1).cast("bigint").alias("copies"),
        *[f"n{j}" for j in range(k, depth + 1)],
    )


def tree(leaves: DataFrame, depth: int) -> list[DataFrame]:
    """Levels of one replica from the numbered leaves to the root; each is stored once."""
    levels = [materialize(numbered(leaves, depth), "merkle-0")]
    for k in range(1, depth + 1):
        order = KEY[:2] if k == 1 else [f"n{k - 1}"]
        levels.append(materialize(parents(levels[-1], k, depth, order), f"merkle-{k}"))
    return levels


def depth_of(*counts: int) -> int:
    """Levels above the leaves: one range of the highest level below the root holds all leaves or about 16 such ranges do."""
    top, depth = max([1, *counts]), 1
    while top > FAN_OUT:
        top, depth = -(-top // FAN_OUT), depth + 1
    return depth


def differing(one: DataFrame, two: DataFrame, k: int, suspects: DataFrame | None, facts: list[str]) -> DataFrame:
    """Nodes of level ``k`` that the two replicas do not share, among the children of ``suspects`` (all for the root).

    Each has an id and, per side, its number on its level and the ``facts``; null where the replica has no such node.
    """
    sides = []
    for level, side in ((one, "a"), (two, "b")):
        if suspects is not None:
            above = suspects.select(F.col(f"n_{side}").alias(f"n{k + 1}")).dropna()
            level = level.join(above, f"n{k + 1}", "left_semi")
        number = F.col(f"n{k}") if k else F.lit(None).cast("bigint")
        sides.append(level.select("id", *([] if k else KEY), number.alias(f"n_{side}"), *[F.col(c).alias(f"{c}_{side}") for c in facts]))
    same = [F.col(f"{c}_a").eqNullSafe(F.col(f"{c}_b")) for c in ("copies", *(("digest", "length") if k else ()))]
    return sides[0].join(sides[1], ["id"] if k else ["id", *KEY], "full_outer").where(~reduce(lambda a, b: a & b, same))


def audit(one: DataFrame, two: DataFrame) -> DataFrame:
    """Damaged records of two tables (page, url, hash, length), none of them null but ``page`` and ``url`` already filled.

    Columns: page, url, hash, length, and copies and offset on each side.
    """
    leaves = [materialize(distinct(x), "leaves") for x in (one, two)]
    depth = depth_of(*[x.count() for x in leaves])
    a, b = (tree(x, depth) for x in leaves)
    found = None
    for k in range(depth, 0, -1):
        levels = [x[k].withColumn("digest", F.col("hash")) for x in (a, b)]
        found = materialize(differing(*levels, k, found, ["digest", "length", "copies"]), f"suspects-{k}")
    last = differing(a[0], b[0], 0, found, ["length", "copies", "offset"])
    zero = F.lit(0).cast("bigint")
    return last.select(
        *KEY, F.coalesce("length_a", "length_b").alias("length"), F.coalesce("copies_a", zero).alias("copies_a"),
        F.coalesce("copies_b", zero).alias("copies_b"), "offset_a", "offset_b",
    )
