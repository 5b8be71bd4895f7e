"""Benchmark decontamination by greedy string tiling.

Words are compared by their letters and digits, whatever the case and the punctuation around them.  Every window of
``min_match`` words of a test item is a seed (an item of fewer words is one seed).  A rolling Karp-Rabin hash finds the
seeds in the whole text of a document; seeds that lie on one diagonal join to maximal matches; the longest unmarked
match is marked again and again, until none of ``min_match`` words is left.  No word of the item or the document is
marked twice.  The share of the item's words under tiles is its coverage, so a passage whose sentences were reordered
counts as much as one left alone.  A document is contaminated if one item reaches ``threshold``.

Items are sent to the tasks in slices of at most ``SLICE_WORDS`` words; a larger benchmark takes more passes over the
rows, one after another in the same tasks.  Nothing is shuffled.  Null and empty texts and items match nothing; an
empty benchmark leaves every document clean; repeated rows are judged alike; other columns pass through, those with
the names of the result are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import WORD, split_words, widened, word_hashes
from llm.common import slices as cut

MIN_MATCH, THRESHOLD = 5, 0.6
SLICE_WORDS = 500_000
BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(BASE, -1, 1 << 64)
_NOISE = re.compile(r"[\W_]+")


def bare(words: pa.Array) -> list[str]:
    """Letters and digits of each word, in lower case."""
    return [_NOISE.sub("", w).lower() for w in words.to_pylist()]


def word_keys(texts) -> tuple[np.ndarray, np.ndarray]:
    """64-bit keys of the words of all texts that hold a letter or digit, and the offsets of the texts."""
    codes, offsets, words = split_words(texts)
    plain = bare(words)
    keys = word_hashes(pa.array(plain, pa.large_string()))
    real = np.array([bool(w) for w in plain], bool)
    if not len(codes):
        return np.zeros(0, np.uint64), offsets
    keep = real[codes]
    return keys[codes[keep]], np.concatenate([[0], np.cumsum(keep)])[offsets]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & (2**64 - 1), np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def rolling(keys: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin hash, modulo 2**64, of every window of ``width`` words."""
    n = len(keys)
    if n < width:
        return np.zeros(0, np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(keys * _powers(BASE, n), dtype=np.uint64)])
    return (sums[width:] - sums[:-width]) * _powers(_INVERSE, n - width + 1)


class Seeds:
    """The windows of some test items, by width: hash -> (item, place)."""

    def __init__(self, ids: list[int], texts: list[str | None], min_match: int):
        keys, offsets = word_keys(pa.array(texts, pa.large_string()))
        self.ids, self.min_match = ids, min_match
        self.items = [keys[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        self.by_width: dict[int, tuple] = {}
        for width in sorted({min(min_match, len(k)) for k in self.items if len(k)}):
            h, item, at = [], [], []
            for i, k in enumerate(self.items):
                if min(min_match, len(k)) == width:
                    w = rolling(k, width)
                    h.append(w)
                    item.append(np.full(len(w), i))
                    at.append(np.arange(len(w)))
            h, item, at = np.concatenate(h), np.concatenate(item), np.concatenate(at)
            by = np.argsort(h, kind="stable")
            h, item, at = h[by], item[by], at[by]
            first = np.nonzero(np.concatenate([[True], h[1:] != h[:-1]]))[0]
            filt = np.zeros(1 << 22, bool)
            filt[(h & np.uint64((1 << 22) - 1)).astype(np.int64)] = True
            self.by_width[width] = (h[first], np.concatenate([first, [len(h)]]), item, at, filt)

    def hits(self, keys: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in keys, item, place in item) of every seed that lies within one text."""
        out = [[], [], []]
        for width, (h, first, item, at, filt) in self.by_width.items():
            w = rolling(keys, width)
            maybe = np.nonzero(filt[(w & np.uint64((1 << 22) - 1)).astype(np.int64)])[0]
            j = np.minimum(np.searchsorted(h, w[maybe]), len(h) - 1)
            same = h[j] == w[maybe]
            pos, j = maybe[same], j[same]
            ends = offsets[np.searchsorted(offsets, pos, "right")]
            pos, j = pos[pos + width <= ends], j[pos + width <= ends]
            reps = first[j + 1] - first[j]
            spread = np.repeat(first[j] - np.concatenate([[0], np.cumsum(reps)[:-1]]), reps) + np.arange(reps.sum())
            out[0].append(np.repeat(pos, reps))
            out[1].append(item[spread])
            out[2].append(at[spread])
        return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)


def tiles(doc: np.ndarray, item: np.ndarray, at_doc: np.ndarray, at_item: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (place in document, place in item, words) from the seed places of one document and item."""
    by = np.lexsort((at_doc, at_doc - at_item))
    d, i = at_doc[by], at_item[by]
    new = np.concatenate([[True], (np.diff(d - i) != 0) | (np.diff(d) != 1)])
    start = np.nonzero(new)[0]
    runs = np.diff(np.concatenate([start, [len(d)]]))
    waiting: dict[int, list[tuple[int, int]]] = {}
    for s, n in zip(start.tolist(), runs.tolist(), strict=True):
        x, y, n = int(d[s]), int(i[s]), n + width - 1
        if (doc[x : x + n] == item[y : y + n]).all():  # the hash only proposes
            waiting.setdefault(n, []).append((y, x))
    used_doc, used_item, out = set(), np.zeros(len(item), bool), []
    while waiting:
        n = max(waiting)
        for y, x in sorted(waiting.pop(n)):
            free = [not used_item[y + k] and (x + k) not in used_doc for k in range(n)]
            if all(free):
                out.append((x, y, n))
                used_item[y : y + n] = True
                used_doc.update(range(x, x + n))
                continue
            k = 0
            while k < n:  # what is left of a match that others have cut
                e = k
                while e < n and free[e]:
                    e += 1
                if e - k >= width:
                    waiting.setdefault(e - k, []).append((y + k, x + k))
                k = e + 1
        if used_item.all():
            break
    return out


MATCHES = "array<struct<item_id:bigint,coverage:double,tiles:array<struct<doc_at:int,item_at:int,words:int>>>>"


def matches(texts, seeds: Seeds) -> list[list[dict]]:
    """For each text the items that share a seed with it, with coverage and tiles."""
    keys, offsets = word_keys(texts)
    pos, item, at = seeds.hits(keys, offsets)
    doc = np.searchsorted(offsets, pos, "right") - 1
    out: list[list[dict]] = [[] for _ in range(len(offsets) - 1)]
    if not len(doc):
        return out
    by = np.lexsort((item, doc))
    pos, item, at, doc = pos[by], item[by], at[by], doc[by]
    cut = np.nonzero(np.concatenate([[True], (np.diff(doc) != 0) | (np.diff(item) != 0)]))[0]
    for a, b in zip(cut, [*cut[1:], len(doc)], strict=True):
        x, it = int(doc[a]), seeds.items[item[a]]
        got = tiles(keys[offsets[x] : offsets[x + 1]], it, pos[a:b] - offsets[x], at[a:b], min(seeds.min_match, len(it)))
        out[x].append({"item_id": seeds.ids[item[a]], "coverage": sum(n for _, _, n in got) / len(it), "tiles": [dict(zip(("doc_at", "item_at", "words"), g, strict=True)) for g in got]})
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, threshold: float = THRESHOLD) -> DataFrame:
    """The documents with ``matches`` (all items that share a seed), the best ``item_id`` and ``coverage``, ``contaminated``."""
    sc = docs.sparkSession.sparkContext
    words = F.size(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"({WORD})"), 0))
    total = benchmark.agg(F.sum(words)).first()[0] or 0
    slices = max(1, -(-total // SLICE_WORDS))
    docs = docs.drop("matches", "item_id", "coverage", "contaminated")
    at, found = docs.columns.index("text"), []
    for i in range(slices):
        rows = benchmark.select("item_id", "text").where(F.pmod(F.xxhash64("item_id"), F.lit(slices)) == i).collect()  # one slice
        sent = sc.broadcast(Seeds([r[0] for r in rows], [r[1] for r in rows], min_match))
        name = f"_matches_{i}"

        def run(batches: Iterator[pa.RecordBatch], sent=sent, name=name) -> Iterator[pa.RecordBatch]:
            kind = pa.list_(pa.struct([("item_id", pa.int64()), ("coverage", pa.float64()), ("tiles", pa.list_(pa.struct([(c, pa.int32()) for c in ("doc_at", "item_at", "words")])))]))
            for b in cut(batches, "text"):
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(matches(b.column(at), sent.value), kind)], [*b.schema.names, name])

        docs = docs.mapInArrow(run, widened(docs, f"{name} {MATCHES}"))
        found.append(name)
    docs = docs.withColumn("matches", F.concat(*found)).drop(*found)
    best = F.array_sort("matches", lambda a, b: F.when(a["coverage"] > b["coverage"], -1).when(a["coverage"] < b["coverage"], 1).when(a["item_id"] < b["item_id"], -1).otherwise(1))
    docs = docs.withColumn("_best", F.get(best, 0))
    return docs.withColumns({
        "item_id": F.col("_best.item_id"), "coverage": F.coalesce("_best.coverage", F.lit(0.0)),
        "contaminated": F.coalesce(F.col("_best.coverage") >= threshold, F.lit(False)),
    }).drop("_best")
