"""Merkle dataset manifest by nested-struct rollup.

Every document is a leaf: the hash of its columns, each ``-`` if null, else ``<utf-8 bytes>:<value>``.  Leaves of one
group (a language) ascend by id; runs of eight become their hash until one node is left, the subroot; the subroots,
ascending by group, become the root the same way.

A leaf's rank in its group is written in base 8.  Its upper digits name a bounded block of ``8 ** LEVELS`` leaves; the
lower digits are columns that are grouped away one after another, each time nesting the children, with their hashes, in
a struct.  All groupings of a round start with the block, so one exchange serves them.  The block hashes are the leaves
of the next round, and so on; a round shrinks the rows 4096-fold.  Then, from the top down, one transform over the nested
structs emits each child's way to the root: for each level the hashes left and right of it.  A way reaches the block
it belongs to by a union and a grouping with the block, so no join is needed, and no node above a block is copied into
more than the way of each leaf below it.

Ranks come from a range exchange on (group, id), whose partitions are counted and summed; no group is ever in one task.
The text is hashed once, in the scan, and never shuffled.

Null groups and null ids come first.  Rows that repeat an id are ordered by their leaves, so the result does not depend
on the order of reading.  Null columns hash as ``-``; an empty table gives an empty manifest; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import LOWER, UPPER, partitions, prepare, stored

WIDTH, LEVELS = 8, 4
BLOCK = WIDTH**LEVELS
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
STEP = "struct<left: string, right: string>"


def hashed(c: Column) -> Column:
    """Lower-case hex SHA-256 of a string's bytes."""
    return F.sha2(c.cast("binary"), 256)


def field(c: Column) -> Column:
    """A column's part of a leaf."""
    s = c.cast("string")
    return F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf_of(columns: list[Column]) -> Column:
    return hashed(F.concat(*[field(c) for c in columns]))


def tampered_text(doc_id: Column, text: Column) -> Column:
    """What a tamperer leaves of the text: every third document, by the checksum of its id, loses its capitals."""
    third = F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0, F.lit(False))
    return F.when(third, F.translate(text, UPPER, LOWER)).otherwise(text)


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``rank``, from 0 in each ``grp``, and ``size``, the rows of the group; ``order`` starts with ``grp``.

    Partitions of a range exchange hold consecutive rows; they are written, with their number, so that a lost executor
    cannot deal them anew.  What a partition holds of each group is one row, summed over the partitions before it.
    """
    n = partitions(rows.sparkSession)
    spread = rows.withColumn("tie", F.monotonically_increasing_id())
    spread = spread.repartitionByRange(n, *order, "tie").withColumn("part", F.spark_partition_id())
    inside = Window.partitionBy("part", "grp").orderBy(*order[1:], "tie")
    placed = stored(spread.withColumn("place", F.row_number().over(inside) - 1).drop("tie"))
    held = placed.groupBy("grp", "part").agg(F.count("*").alias("held"))
    group = Window.partitionBy("grp")
    before = F.coalesce(F.sum("held").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    held = held.select(F.col("grp").alias("g"), F.col("part").alias("p"), before.alias("before"), F.sum("held").over(group).alias("size"))
    out = placed.join(held, (F.col("part") == F.col("p")) & F.col("grp").eqNullSafe(F.col("g")))
    return out.withColumn("rank", (F.col("place") + F.col("before")).cast("long")).drop("part", "place", "before", "p", "g")


def depth(size: Column) -> Column:
    """Levels above the leaves of a tree of ``size`` leaves: the least k with 8^k >= size."""
    out = F.lit(0)
    for k in range(20):
        out = out + (size > WIDTH**k).cast("int")
    return out


def rolled(leaves: DataFrame, below: int, kept: list[str]) -> DataFrame:
    """One round: (grp, rank, size, h, ``kept``) to one row a block: grp, rank (of the block), size, h, tree.

    ``below`` levels lie under this round.  A level above the tree's depth has one child and takes over its hash.
    """
    low = F.col("rank") % BLOCK
    node = F.struct(F.col("h"), *[F.col(c) for c in kept])
    rows = leaves.select(
        "grp", "size", F.floor(F.col("rank") / BLOCK).cast("long").alias("block"),
        *[(F.floor(low / WIDTH**k) % WIDTH).cast("int").alias(f"d{k}") for k in range(LEVELS)], node.alias("node"))
    rows = rows.repartition("grp", "block")
    for k in range(LEVELS):
        upper = [f"d{j}" for j in range(k + 1, LEVELS)]
        kids = F.transform(F.array_sort(F.collect_list(F.struct(F.col(f"d{k}").alias("digit"), "node"))), lambda x: x["node"])
        rows = rows.groupBy("grp", "size", "block", *upper).agg(kids.alias("kids"))
        real = depth(F.col("size")) > below + k
        h = F.when(real, hashed(F.array_join("kids.h", ""))).otherwise(F.get("kids", F.lit(0))["h"])
        rows = rows.select("grp", "size", "block", *upper, F.struct(h.alias("h"), "kids").alias("node"))
    return rows.select("grp", F.col("block").alias("rank"), "size", "node.h", F.col("node").alias("tree"))


def _step(kids: Column, at: Column, real: Column) -> Column:
    """The way from child ``at`` to its parent: one step, none where the level lies above the tree."""
    hs, count = kids["h"], F.size(kids)
    left = F.array_join(F.slice(hs, F.lit(1), at), "")
    right = F.array_join(F.slice(hs, at + 2, count), "")
    return F.when(real, F.array(F.struct(left.alias("left"), right.alias("right")))).otherwise(F.array().cast(f"array<{STEP}>"))


def emitted(blocks: DataFrame, below: int, carry: list[str]) -> DataFrame:
    """One row for each leaf of a round: its own columns, its ``place`` in the block, ``way`` up to the root, ``carry``.

    ``blocks`` has grp, rank, size, tree, ``way`` of the block.  One transform walks the nested structs.
    """

    def walk(node: Column, k: int, way: Column, place: Column) -> Column:
        real = depth(F.col("size")) > below + k

        def child(x: Column, i: Column) -> Column:
            up = F.concat(_step(node["kids"], i, real), way)
            at = place * WIDTH + i
            return F.struct(x.alias("leaf"), at.alias("place"), up.alias("way")) if k == 0 else walk(x, k - 1, up, at)

        out = F.transform(node["kids"], child)
        return out if k == 0 else F.flatten(out)

    all_leaves = walk(F.col("tree"), LEVELS - 1, F.col("way"), F.lit(0))
    return blocks.select("grp", F.col("rank").alias("block"), *carry, F.explode(all_leaves).alias("e")).select("grp", "block", *carry, "e.place", "e.way", "e.leaf.*")


def with_way(blocks: DataFrame, ways: DataFrame, carry: list[str]) -> DataFrame:
    """Each block meets its own way (grp, rank, way, ``carry``) in a grouping of the union of both."""
    tree = blocks.schema["tree"].dataType
    mine = blocks.select("grp", "rank", "size", "tree", F.lit(None).cast(f"array<{STEP}>").alias("way"), *[F.lit(None).cast("string").alias(c) for c in carry])
    theirs = ways.select("grp", "rank", F.lit(None).cast("long").alias("size"), F.lit(None).cast(tree).alias("tree"), "way", *carry)
    met = [F.first(c, ignorenulls=True).alias(c) for c in ("size", "tree", "way", *carry)]
    return mine.unionByName(theirs).groupBy("grp", "rank").agg(*met)


def climbed(leaves: DataFrame, kept: list[str]) -> list[DataFrame]:
    """All rounds, first to last; the last has one row for each group: its subroot."""
    rounds = [stored(rolled(leaves, 0, kept))]
    tallest = leaves.agg(F.max("size")).first()[0] or 1
    while BLOCK ** len(rounds) < tallest:
        last = rounds[-1].select("grp", "rank", "size", "h")
        rounds.append(stored(rolled(last, LEVELS * len(rounds), [])))
    return rounds


def descended(rounds: list[DataFrame], ways: DataFrame, carry: list[str]) -> DataFrame:
    """The leaves of the first round with their ways to the root, from the ways (grp, rank 0) of the last one's rows."""
    for k in range(len(rounds) - 1, -1, -1):
        out = emitted(with_way(rounds[k], ways, carry), LEVELS * k, carry)
        ways = out.withColumn("rank", F.col("block") * BLOCK + F.col("place"))
    return out


def manifest(docs: DataFrame, tamper=tampered_text) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``tamper(doc_id, text)`` is the text whose leaf is folded up along the original siblings.
    """
    prepare(docs.sparkSession)
    columns = [F.col(c) for c in COLUMNS]
    docs = docs.select(*COLUMNS)
    changed = tamper(F.col("doc_id"), F.col("text"))
    leaf, again = leaf_of(columns), leaf_of([*columns[:-1], changed])
    same = changed.eqNullSafe(F.col("text"))
    leaves = stored(docs.select(F.col("lang").alias("grp"), "doc_id", leaf.alias("h"), F.when(~same, again).alias("changed")))
    rounds = climbed(ranked(leaves, ["grp", "doc_id", "h"]), ["doc_id", "changed"])
    # the subroots are leaves of one more tree, of one group
    subroots = rounds[-1].select(F.lit("").alias("grp"), F.col("grp").alias("of"), "h")
    top = climbed(ranked(subroots, ["grp", "of", "h"]), ["of"])
    start = top[-1].select("grp", "rank", F.array().cast(f"array<{STEP}>").alias("way"), F.col("h").alias("root"))
    ways = descended(top, start, ["root"]).select(F.col("of").alias("grp"), F.lit(0).cast("long").alias("rank"), "way", "root", F.col("h").alias("subroot"))
    out = descended(rounds, ways, ["root", "subroot"])
    proof = F.array_join(F.transform("way", lambda s: F.concat(s["left"], s["right"])), "")
    folded = F.aggregate("way", F.coalesce("changed", "h"), lambda acc, s: hashed(F.concat(s["left"], acc, s["right"])))
    out = out.select("doc_id", F.col("h").alias("leaf"), "subroot", "root", hashed(proof).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
