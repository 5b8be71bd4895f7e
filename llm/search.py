"""Ranked lexical search by pipelined term partitioning.

The index.  Each Arrow batch of documents is a shard: one row names its documents and their lengths, and one row for each
query term holds the places and frequencies of the term in the shard.  Terms are the maximal runs of ASCII letters and
digits and of all other characters beyond ASCII, A-Z lower-cased.  Words that no query holds are left out by a bitmap of
``2 ** BITS`` bits, which is all that is sent to the tasks, whatever the number of queries; a word that passes by
chance finds no query later.

The pipeline.  The terms are dealt to ``len(OWNERS) + 1`` owners by how common they are, rare terms first.  A bundle holds
the queries of one group over one shard, with a sparse accumulator: (query, document, integer score).  It visits the
owners one after another; at each the bundle meets, by cogroup, the owner's postings of its shard, which add their
integer contributions.  After each stage a document is dropped from a query's accumulators only if ``k`` documents of its
shard already beat all it can still gain, so the result is exact: a contribution is below ``10**6`` times the weight,
and scores only grow; a dropped document that comes back stays below those ``k``.  The last owner selects the first
``k`` documents of each query and shard, and a window the first ``k`` of all shards.

A common term has a row in every shard, never a list in one task; a query group is at most ``GROUP`` queries and a shard at
most one batch, so a stage's matrix of scores is bounded.

Weights need the number of documents, of all terms and of a term's documents: sums over the stored index, all in one scan.

Null texts have no terms and no rank; queries without text, without terms or without matches return nothing.  Rows
that repeat an item with its text are one item; different texts of one item_id are one item with all their terms; a null
id is an id.  Each row of ``docs`` is a document: rows that repeat an id are ranked one by one.  Null doc_ids come first
among equal scores.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import LOWER, UPPER, prepare, slices, split_words, stored, word_hashes

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BITS = 24
# a term that fewer than one in so many documents hold goes to the first owner, and so on
OWNERS = (64, 8, 3)
GROUP = 256
K = 20
INDEX = "shard long, term string, docs array<int>, tfs array<int>, ids array<bigint>, lens array<bigint>"
BUNDLE = "shard long, grp int, ids array<bigint>, lens array<bigint>, query array<bigint>, doc array<int>, score array<bigint>, bound array<bigint>"
FOUND = "query long, doc_id long, score long"
MOST_GAIN = 1_000_000  # no term adds as much as its weight times this

_PLAIN = bytes.maketrans(UPPER.encode(), LOWER.encode())
_BREAKS = bytes(32 if c < 128 and not chr(c).isalnum() else _PLAIN[c] for c in range(256))


def spaced(texts: pa.Array) -> pa.Array:
    """The texts with A-Z lower-cased and a space for every ASCII character that is no letter or digit."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets, data = texts.buffers()[1:]
    if data is None or not len(texts):
        return texts
    cuts = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    plain = data[cuts[0] : cuts[-1]].to_pybytes().translate(_BREAKS)
    return pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer((cuts - cuts[0]).tobytes()), pa.py_buffer(plain)])


def terms_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(term number of every token, offsets per text, distinct terms)."""
    return split_words(spaced(texts))


def slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "text"):
        codes, offsets, terms = terms_of(b["text"])
        row = np.repeat(np.arange(b.num_rows), np.diff(offsets))
        pair, n = np.unique(row * max(len(terms), 1) + codes, return_counts=True)
        row, code = pair // max(len(terms), 1), pair % max(len(terms), 1)
        where = slot(word_hashes(terms))[code]
        yield pa.RecordBatch.from_arrays([b["item"].take(pa.array(row)), terms.take(pa.array(code)).cast(pa.string()), pa.array(n, pa.int64()), pa.array(where)], ["item", "term", "n", "slot"])


def query_bitmap(terms: DataFrame) -> bytes:
    """One bit for each slot that a query term takes: ``2 ** BITS`` bits at most reach the driver."""
    slots = terms.selectExpr("bitmap_bucket_number(slot + 1) as b", "bitmap_bit_position(slot + 1) as p")
    found = slots.groupBy("b").agg(F.expr("bitmap_construct_agg(p)").alias("bits"))
    out = bytearray(1 << (BITS - 3))
    for r in found.toLocalIterator():
        out[(r.b - 1) * 4096 : r.b * 4096] = r.bits
    return bytes(out)


def _lists(cuts, flat, kind) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat).cast(kind))


def _indexer(bitmap: bytes):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap, np.uint8)
        part = TaskContext.get().partitionId()
        for number, b in enumerate(slices(batches, "text")):
            codes, offsets, terms = terms_of(b["text"])
            lens = np.diff(offsets)
            ids, n = b["doc_id"].filter(pa.array(lens > 0)), int((lens > 0).sum())
            if not n:
                continue
            row = np.repeat(np.cumsum(lens > 0) - 1, lens)  # places among the documents that hold a term
            where = slot(word_hashes(terms))
            keep = ((bits[where >> 3] >> (where & 7).astype(np.uint8)) & 1 == 1)[codes]
            pair, tf = np.unique(codes[keep] * n + row[keep], return_counts=True)
            code, doc = pair // n, pair % n
            start = np.nonzero(np.diff(code, prepend=-1))[0]
            cuts, none = np.concatenate([[0], start, [len(code)]]), np.full(len(start), n)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(start) + 1, (part << 32) + number), pa.int64()),
                pa.array([None, *terms.take(pa.array(code[start])).to_pylist()], pa.string()),
                _lists(cuts, doc, pa.int32()), _lists(cuts, tf, pa.int32()),
                # only the first row names the documents
                _lists(np.concatenate([[0, n], none]), ids, pa.int64()), _lists(np.concatenate([[0, n], none]), lens[lens > 0], pa.int64()),
            ], ["shard", "term", "docs", "tfs", "ids", "lens"])

    return index


def contribution(tf: np.ndarray, m: np.ndarray, w: int) -> np.ndarray:
    return w * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))


def _longs(t: pa.Table, column: str, row: int = 0) -> np.ndarray:
    return t[column][row].values.to_numpy(zero_copy_only=False).astype(np.int64)


def _added(bundle: pa.Table, postings: pa.Table, docs_all: int, terms_all: int, last: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(queries, scores by query and document, bound by query) of a bundle after one owner's postings."""
    lens = _longs(bundle, "lens")
    m = 75 + (25 * lens * docs_all) // terms_all
    query, doc, score, bound = (_longs(bundle, c) for c in ("query", "doc", "score", "bound"))
    uses = postings["uses"].combine_chunks()
    flat = uses.flatten()
    named, times, later = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("query", "n", "later"))
    ends = np.cumsum(np.concatenate([[0], uses.value_lengths().to_numpy(zero_copy_only=False)])).astype(np.int64)
    queries, at = np.unique(np.concatenate([query, named]), return_inverse=True)
    scores, rest = np.zeros((len(queries), len(lens)), np.int64), np.zeros(len(queries), np.int64)
    scores[at[: len(query)], doc] = score
    rest[at[: len(query)]] = bound
    at = at[len(query) :]
    for r in range(postings.num_rows):
        docs, tfs, mine = _longs(postings, "docs", r), _longs(postings, "tfs", r), slice(ends[r], ends[r + 1])
        gain = contribution(tfs, m[docs], postings["w"][r].as_py())
        scores[np.ix_(at[mine], docs)] += times[mine, None] * gain
    rest[at] = later
    return queries, scores, rest * (not last)


def _stage(docs_all: int, terms_all: int, k: int):
    """One owner: adds its postings, then drops what ``k`` documents of the shard are sure to beat."""

    def work(bundle: pa.Table, postings: pa.Table) -> pa.Table:
        if not bundle.num_rows or not postings.num_rows:
            return bundle
        queries, scores, rest = _added(bundle, postings, docs_all, terms_all, False)
        if scores.shape[1] > k:
            floor = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
            scores[scores + rest[:, None] < floor[:, None]] = 0
        q, d = np.nonzero(scores)
        out = {"query": queries[q], "doc": d, "score": scores[q, d], "bound": rest[q]}
        names = bundle.schema.names
        return pa.table([bundle[c] if c not in out else pa.array([out[c]], bundle.schema.field(c).type) for c in names], schema=bundle.schema)

    return work


def _select(docs_all: int, terms_all: int, k: int):
    """The last owner: adds its postings, then the first ``k`` documents of the shard for each query."""
    kind = pa.schema([("query", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def work(bundle: pa.Table, postings: pa.Table) -> pa.Table:
        if not bundle.num_rows:
            return kind.empty_table()
        queries, scores, _ = _added(bundle, postings, docs_all, terms_all, True)
        ids = bundle["ids"][0].values
        by_id = np.argsort(ids.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False), kind="stable")
        best = by_id[np.argsort(-scores[:, by_id], axis=1, kind="stable")[:, :k]]
        q = np.repeat(np.arange(len(queries)), best.shape[1])
        d = best.ravel()
        found = scores[q, d] > 0
        q, d = q[found], d[found]
        return pa.table([pa.array(queries[q]), ids.take(pa.array(d)), pa.array(scores[q, d])], schema=kind)

    return work


def owner(df: Column, docs_all: int) -> Column:
    return sum((df * t >= docs_all).cast("int") for t in OWNERS)


def ranked(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: each item's ``k`` best documents with a score above 0."""
    spark = prepare(docs.sparkSession)
    kind = items.schema["item_id"].dataType.simpleString()
    texts = items.select(F.col("item_id").alias("item"), F.col("text").cast("string").alias("text")).where("text is not null").distinct()
    terms = texts.mapInArrow(_item_terms, f"item {kind}, term string, n long, slot long")
    terms = stored(terms.groupBy("item", "term", "slot").agg(F.sum("n").alias("n")))
    numbers = stored(terms.select("item").distinct().withColumn("query", F.monotonically_increasing_id()))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    index = stored(texts.mapInArrow(_indexer(query_bitmap(terms)), INDEX))
    named = index.where("term is null")
    docs_all, terms_all = named.agg(F.sum(F.size("ids")), F.sum(F.aggregate("lens", F.lit(0).cast("long"), lambda a, x: a + x))).first()
    groups = -(-numbers.count() // GROUP)
    if not docs_all or not groups:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    # each term's weight, its owner, and what the owners after it can add to a query
    held = index.where("term is not null").groupBy("term").agg(F.sum(F.size("docs")).alias("df"))
    weight = F.floor(1000 * F.log((F.lit(2.0) * docs_all + 2) / (2 * F.col("df") + 1))).cast("long")
    held = held.select("term", weight.alias("w"), owner(F.col("df"), docs_all).alias("owner"))
    used = terms.join(numbers, terms["item"].eqNullSafe(numbers["item"])).select("query", "term", "n").join(held, "term")
    after = Window.partitionBy("query").orderBy("owner").rangeBetween(1, Window.unboundedFollowing)
    used = used.withColumn("later", F.coalesce(F.sum(F.col("n") * F.col("w") * MOST_GAIN).over(after), F.lit(0)))
    grp = F.pmod(F.xxhash64("query"), F.lit(groups)).cast("int").alias("grp")
    used = used.groupBy("term", "w", "owner", grp).agg(F.collect_list(F.struct("query", "n", "later")).alias("uses"))
    postings = stored(index.where("term is not null").select("shard", "term", "docs", "tfs").join(used, "term").drop("term"))
    # bundles go from owner to owner
    empty = [F.array().cast(t).alias(c) for c, t in (("query", "array<bigint>"), ("doc", "array<int>"), ("score", "array<bigint>"), ("bound", "array<bigint>"))]
    bundles = named.select("shard", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("grp"), "ids", "lens", *empty)
    for at in range(len(OWNERS) + 1):
        step, out = (_select, FOUND) if at == len(OWNERS) else (_stage, BUNDLE)
        mine = postings.where(F.col("owner") == at).groupBy("shard", "grp")
        bundles = bundles.groupBy("shard", "grp").cogroup(mine).applyInArrow(step(docs_all, terms_all, k), out)
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
    best = bundles.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return best.join(numbers, "query").select(F.col("item").alias("item_id"), "rank", "doc_id", "score")
