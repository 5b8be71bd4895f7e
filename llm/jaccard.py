"""N-gram Jaccard join by vertical partitioning.

Equal texts (after lower-casing A-Z) are one class.  The distinct word n-grams of all classes are put in one global
order, rare ones first: by the power of two below the number of classes that hold them, then by key.  The n-grams are dealt
over fragments by their level and half of the keys.  For a pair, the overlap is counted in each fragment by itself and summed.

Finding pairs: two sets that link share an n-gram among the first ``n - ceil(t * n) + 1`` of either (n-grams of one
class only come first and match nothing).  Classes that share such an n-gram form a bucket.  A large group of near
copies would be all pairs of many buckets, so each bucket is first joined to one centre (the member with the fewest
n-grams of its own) and to its first member, links are verified, and connected components are taken; what is left to
compare are members of one bucket in different components, the smaller components against the rest, where their sizes
and their own n-grams allow a link at all.  So no link between components is missed, and none within one is
enumerated.  Nothing is capped or sampled.

Counting is done in blocks of texts and ranges of keys: each block counts its n-grams once, each range adds the blocks
up and answers every block, so the shuffle carries a key once for a block and not once for a document.

Null texts and texts without words have the empty set and link with nothing.  A text of fewer words than the width is
one n-gram.  Rows that repeat an id are one document.  A row without id is classed alone (null component).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import ASK, BOXES, ask_rows, ascii_lower, boxed, components, partitions, shingle_keys, slices, stored, tally, tidy, unboxed

FRAGMENTS = 16
SIZES = [f"s{i}" for i in range(FRAGMENTS)]  # how many n-grams a set has in each fragment
SEEN = 1 << 16
SETS = "h1 long, h2 long, n long, prefix array<bigint>, parts array<array<bigint>>"


def _first_seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Box the texts this task has not passed on before, so that no hot text is shuffled more than once a task."""
    return boxed(_unseen(batches))


def _unseen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set[tuple[int, int]] = set()
    for b in slices(batches, "text"):
        if len(seen) > SEEN:  # a text passed on twice is only shuffled twice
            seen.clear()
        keep = []
        for k in zip(b["h1"].to_pylist(), b["h2"].to_pylist(), strict=True):
            keep.append(k not in seen)
            seen.add(k)
        yield b.filter(pa.array(keep, pa.bool_()))


def _texts_once(boxes: pa.Table) -> pa.Table:
    """The distinct texts of a block, in the order of their hashes."""
    t = unboxed(boxes)
    h1, h2 = t["h1"].to_numpy(), t["h2"].to_numpy()
    by = np.lexsort((h2, h1))
    first = np.ones(len(by), bool)
    first[1:] = (np.diff(h1[by]) != 0) | (np.diff(h2[by]) != 0)
    return t.take(pa.array(by[first]))


def _asker(width: int, shards: int):
    def ask(t: pa.Table) -> pa.Table:
        once = _texts_once(t)
        _, keys = shingle_keys(once["text"], width)
        return ask_rows(t["block"][0].as_py(), *np.unique(keys, return_counts=True), shards)

    return ask


def _levels(t: pa.Table) -> pa.Table:
    """For every block of a key range: 0 for an n-gram of one class, else the power of two below its classes."""
    blocks, _, _, sums, places = tally(t)
    level = np.minimum(np.log2(np.maximum(sums, 1)), 254).astype(np.uint8)
    shard = t["shard"][0].as_py()
    return pa.table({
        "block": pa.array(blocks, pa.int32()), "shard": pa.array([shard] * len(blocks), pa.int32()),
        "levels": pa.array([level[p].tobytes() for p in places], pa.binary()),
    })


def prefix_length(n: np.ndarray, num: int, den: int) -> np.ndarray:
    return n + (-num * n) // den + 1


def _setter(width: int, num: int, den: int, shards: int):
    def build(texts: pa.Table, answers: pa.Table) -> pa.Table:
        kind = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("n", pa.int64()), ("prefix", pa.list_(pa.int64())), ("parts", pa.list_(pa.list_(pa.int64())))])
        if not texts.num_rows:
            return kind.empty_table()
        once = _texts_once(texts)
        doc, keys = shingle_keys(once["text"], width)
        level = np.zeros(len(keys), np.uint8)
        if len(keys):
            distinct, place = np.unique(keys, return_inverse=True)
            by = np.argsort(answers["shard"].to_numpy())
            blobs = answers["levels"].to_pylist()
            level = np.concatenate([np.frombuffer(blobs[i], np.uint8) for i in by])[place]
            assert len(distinct) == sum(map(len, blobs))
        size = np.bincount(doc, minlength=once.num_rows)
        rare = np.bincount(doc[level == 0], minlength=once.num_rows)
        wanted = np.maximum(prefix_length(size, num, den) - rare, 0)
        wanted[size == 0] = 0
        shared = (level > 0) & (wanted[doc] > 0)
        doc, keys, level = doc[shared], keys[shared], level[shared].astype(np.int64)
        by = np.lexsort((keys, level, doc))
        doc, keys, level = doc[by], keys[by], level[by]
        signed = keys.view(np.int64)
        start = np.searchsorted(doc, np.arange(once.num_rows + 1))
        prefix = [signed[a : a + w] for a, w in zip(start[:-1], wanted, strict=True)]
        place = doc * FRAGMENTS + np.minimum(level - 1, FRAGMENTS // 2 - 1) * 2 + (keys >> np.uint64(63)).astype(np.int64)
        by = np.argsort(place, kind="stable")  # the last two fragments hold several levels, so their keys alternate in the order above
        cuts = np.searchsorted(place[by], np.arange(once.num_rows * FRAGMENTS + 1))
        inner = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(signed[by]))
        outer = pa.ListArray.from_arrays(pa.array(np.arange(once.num_rows + 1) * FRAGMENTS, pa.int32()), inner)
        return pa.table([once["h1"].cast(pa.int64()), once["h2"].cast(pa.int64()), pa.array(size, pa.int64()), pa.array([p.tolist() for p in prefix], pa.list_(pa.int64())), outer], schema=kind)

    return build


def classes_of(docs: DataFrame, width: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, h1, h2) of all rows, and one row per distinct text: rep, h1, h2, n, prefix, parts."""
    spark = docs.sparkSession
    shards = partitions(spark)
    text = ascii_lower(F.coalesce(F.col("text").cast("string"), F.lit("")))
    hashed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("h1"), F.xxhash64(text, F.lit(1)).alias("h2"), text.alias("text"))
    rows = hashed.select("doc_id", "h1", "h2")
    block = F.pmod("h1", F.lit(2 * shards)).cast("int").alias("block")
    texts = hashed.select("h1", "h2", "text", block).mapInArrow(_first_seen, BOXES)
    asked = texts.groupBy("block").applyInArrow(tidy(_asker(width, shards)), ASK)
    answers = asked.groupBy("shard").applyInArrow(tidy(_levels), "block int, shard int, levels binary")
    sets = texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(tidy(_setter(width, num, den, shards)), SETS)
    reps = rows.groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"))
    return rows, stored(sets.join(reps, ["h1", "h2"]))


def _sized(df: DataFrame, end: str) -> DataFrame:
    """The columns id, n and the fragment sizes, renamed for one side of a pair."""
    return df.select(*[c if c in ("token", "comp", "most") else F.col(c).alias(f"{c}{end}") for c in df.columns])


def _possible(one: str, two: str, num: int, den: int):
    """Can two sets of these sizes reach the threshold?  In a fragment they share no more than the smaller part."""
    n1, n2 = F.col(f"n{one}"), F.col(f"n{two}")
    most = sum((F.least(f"{s}{one}", f"{s}{two}") for s in SIZES), F.lit(0))
    return (F.least(n1, n2) * den >= F.greatest(n1, n2) * num) & ((num + den) * most >= num * (n1 + n2))


def _verified(pairs: DataFrame, able: DataFrame, fragments: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) that link: partial overlaps fragment by fragment, summed for each pair."""
    a, b = _sized(able, "_a").withColumnRenamed("id_a", "a"), _sized(able, "_b").withColumnRenamed("id_b", "b")
    pairs = pairs.join(a, "a").join(b, "b").where(_possible("_a", "_b", num, den)).select("a", "b", F.col("n_a").alias("na"), F.col("n_b").alias("nb"))
    left = fragments.select(F.col("id").alias("a"), "fragment", F.col("keys").alias("ka"))
    right = fragments.select(F.col("id").alias("b"), "fragment", F.col("keys").alias("kb"))
    part = pairs.join(left, "a").join(right, ["b", "fragment"]).select("a", "b", "na", "nb", F.size(F.array_intersect("ka", "kb")).alias("o"))
    total = part.groupBy("a", "b", "na", "nb").agg(F.sum("o").alias("o"))
    return total.where(den * F.col("o") >= num * (F.col("na") + F.col("nb") - F.col("o"))).select("a", "b")


def linked_components(sets: DataFrame, num: int, den: int) -> DataFrame:
    """(node, component) of the reps that link with another; all links between components are found."""
    sizes = [F.size(F.get("parts", F.lit(i))).alias(c) for i, c in enumerate(SIZES)]
    able = sets.where(F.col("rep").isNotNull() & (F.size("prefix") > 0)).select(F.col("rep").alias("id"), "n", *sizes, "prefix", "parts")
    fragments = stored(able.select("id", F.posexplode("parts").alias("fragment", "keys")).where(F.size("keys") > 0))
    entries = stored(able.select(F.explode("prefix").alias("token"), "id", "n", *SIZES))
    able = able.select("id", "n", *SIZES)
    # each bucket to the member with the fewest n-grams outside the last fragments, the likeliest centre of near copies, and to its first
    unusual = F.col("n") - sum((F.col(c) for c in SIZES[FRAGMENTS // 2 :]), F.lit(0))
    bucket = entries.groupBy("token").agg(F.min_by("id", F.struct(unusual, F.col("id"))).alias("centre"), F.min("id").alias("low"), F.max("id").alias("high")).where("low < high")
    pairs = entries.join(bucket, "token").select("id", F.explode(F.array_distinct(F.array("centre", "low"))).alias("to")).where("id <> to")
    pairs = stored(pairs.select(F.least("id", "to").alias("a"), F.greatest("id", "to").alias("b")).distinct())
    links = stored(_verified(pairs, able, fragments, num, den))
    done = components(links)
    # what is left: members of one bucket in different components
    marked = entries.join(done, F.col("id") == F.col("node"), "left").select("token", "id", "n", *SIZES, F.coalesce("component", "id").alias("comp"))
    shortest = marked.groupBy("token").agg(F.min("n").alias("least"))
    partner = F.greatest(F.col("least"), F.ceil(F.col("n") * num / den))  # no partner in the bucket is shorter
    shared = sum((F.col(c) for c in SIZES), F.lit(0))
    marked = stored(marked.join(shortest, "token").where((num + den) * shared >= num * (F.col("n") + partner)).drop("least"))
    per = marked.groupBy("token", "comp").agg(F.count("*").alias("c"))
    mixed = per.groupBy("token").agg(F.max_by("comp", "c").alias("most"), F.count("*").alias("kinds")).where("kinds > 1")
    left = stored(marked.join(mixed.select("token", "most"), "token").withColumnRenamed("comp", "c"))
    small, other = _sized(left.where("c <> most").drop("most"), "_x"), _sized(left, "_y")
    met = small.join(other, "token").where(
        (F.col("c_x") != F.col("c_y")) & ((F.col("c_y") == F.col("most")) | (F.col("id_x") < F.col("id_y"))) & _possible("_x", "_y", num, den))
    met = met.select(F.col("id_x").alias("x"), F.col("id_y").alias("y"))
    rest = stored(met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    more = stored(_verified(rest, able, fragments, num, den))
    if more.isEmpty():
        return done
    return components(links.union(more))


def joined(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id reachable by links)."""
    rows, sets = classes_of(docs, width, num, den)
    comps = linked_components(sets, num, den)
    named = sets.select("h1", "h2", "n", "rep").join(comps, F.col("rep") == F.col("node"), "left").select("h1", "h2", "n", F.when(F.col("n") > 0, F.coalesce("component", "rep")).alias("component"))
    out = rows.join(named, ["h1", "h2"])
    alone = F.col("doc_id").isNull() | F.col("component").isNull()
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(alone, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"))
