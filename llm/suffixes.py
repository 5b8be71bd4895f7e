"""Suffix-array dedup by a depth-limited radix sort.

A byte goes if a string of ``LENGTH`` bytes over it also starts in a document with a smaller id.  Every suffix of every
text is ordered, but only through its first ``LENGTH`` bytes and only as far as it still shares a group with a suffix of
another document; the groups that are equal to that depth are exactly the repeated windows.

The most significant digit of a suffix is its signature: the least, by a fixed hash, of the ``GRAM``-byte strings that lie
within its first ``LENGTH`` bytes.  Equal windows have equal signatures, and neighbouring windows mostly share one, so a
run of windows with one signature travels as one piece of text.

* First pass, over signatures: each block of texts sends the distinct signatures of each key range once.  The range
  answers how to go on: a signature that only one document holds ends there (most do); one held by others stays.
* Second pass, over the bytes: the distinct pieces of the signatures that stay go to their ranges, with the smallest
  document of the block that holds them.  A signature with very many pieces is split by its next digit: its windows go
  one by one to the range of their own hash, so no range gets a hot phrase whole.  In a range equal pieces become one;
  where a signature has several, their windows are radix sorted by eight bytes at a time, most significant first, and
  groups of one are left out before each further digit.  The smallest document of an equal group decides for all of it.
* The answer, a bit for each window of a piece, goes back to the block, which marks the bytes of all its documents.

Copies of a text cost a block one set of pieces, however many they are.  Texts are shuffled once, compressed; keys once
for each block and range.  Windows are compared by their bytes; equal pieces are found by 128 bits of hash in a range, by
64 in a block.  The bytes of a block are worked on in slices of ``SLICE``, so a long text needs no more memory at once.

Null texts are empty.  Rows without id come after all ids and do not count against each other; rows that repeat an id do
not count against each other either, and each is answered.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import ASK, BOXES, ask_rows, boxed, pack_keys, partitions, prepare, scramble, shard_bounds, tally, unboxed

LENGTH, GRAM = 50, 26
REACH = LENGTH - GRAM + 1  # places of a signature in a window
SLICE = 1 << 20
HOT = 20_000  # pieces of one signature from which on they are split by window
NO_ID = (1 << 63) - 1
PIECES = "shard int, block int, pieces binary"
ANSWERS = "block int, shard int, masks binary"
FOUND = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

_U = np.uint64
_MIX = 0x9E3779B97F4A7C15
_BYTES = scramble(np.arange(1, 257, dtype=_U) * _U(_MIX))
_PLACE = _U((1 << 32) - 1)


def _power(n: int) -> np.uint64:
    return _U(pow(_MIX, n, 1 << 64))


def _grown(left: np.ndarray, n: int, right: np.ndarray, m: int) -> np.ndarray:
    """Hashes of all strings of n + m bytes from those of n and of m bytes."""
    size = len(left) - m
    return left[:size] * _power(m) + right[n : n + size]


class Windows:
    """The runs of windows with one signature at one place, of the windows that start in a slice of a block's bytes.

    ``start`` (in the slice) and ``count`` of the windows of a run, ``offset`` of the signature in the first window,
    ``text`` (whose), ``key`` (hash of the signature) and ``piece`` (hash of the run's bytes), in the order of the texts.
    """

    def __init__(self, data: np.ndarray, text: np.ndarray):
        """``text`` is the number of the text of each byte."""
        self.data, last = data, LENGTH - 1
        valid = text[:-last] == text[last:] if len(data) > last else np.zeros(0, bool)
        where = np.nonzero(valid)[0]
        if not len(where):
            none = np.zeros(0, np.int64)
            self.start, self.count, self.offset, self.text, self.key, self.piece = none, none, none, none, none.view(_U), none.view(_U)
            return
        one = _BYTES[data]
        two = _grown(one, 1, one, 1)
        four = _grown(two, 2, two, 2)
        eight = _grown(four, 4, four, 4)
        rest = _grown(_grown(eight, 8, eight, 8), 16, eight, 8)  # the LENGTH - GRAM bytes after a gram
        gram = _grown(rest, LENGTH - GRAM, two, 2)
        least = (scramble(gram) & ~_PLACE) | np.arange(len(gram), dtype=_U)
        have = 1
        while 2 * have <= REACH:
            least = np.minimum(least[:-have], least[have:])
            have *= 2
        least = np.minimum(least[: len(least) - REACH + have], least[REACH - have :])
        at = (least[where] & _PLACE).astype(np.int64)
        whose = text[where]
        begin = np.nonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (whose[1:] != whose[:-1])]))[0]
        count, start, at = np.diff(np.append(begin, len(where))), where[begin], at[begin]
        window = lambda p: gram[p] * _power(LENGTH - GRAM) + rest[p + GRAM]
        self.key = scramble(gram[at] ^ _U(_MIX))  # not the hash whose least values were chosen: those crowd one range
        # a run has at most REACH windows, so its first and its last window hold all its bytes
        self.piece = scramble(window(start) * _U(31) + window(start + count - 1)) + count.astype(_U)
        self.start, self.count, self.offset, self.text = start.astype(np.int32), count.astype(np.uint8), (at - start).astype(np.uint8), whose[begin].astype(np.int32)


def hashes(data: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes at each place."""
    out = np.zeros(len(start), _U)
    for i in range(size):
        out = out * _U(_MIX) + _BYTES[data[start + i]]
    return scramble(out)


class Block:
    """The texts of a block as one array of bytes, and the windows of its slices.

    The boxes of a block come in any order; the texts are sorted, so each use of the block sees the same array.
    """

    def __init__(self, boxes: pa.Table):
        t = unboxed(boxes).sort_by([("doc_id", "ascending"), ("text", "ascending")])
        texts = t["text"].combine_chunks().cast(pa.large_binary())
        cuts = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        self.number, self.docs = boxes["block"][0].as_py(), t["doc_id"].to_numpy()
        self.data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[cuts[0] : cuts[-1]]
        self.lens = np.diff(cuts)
        self.text = np.repeat(np.arange(len(self.lens), dtype=np.int32), self.lens)
        self.slices = []
        for a in range(0, len(self.data), SLICE):
            b = a + SLICE + LENGTH - 1
            self.slices.append((a, Windows(self.data[a:b], self.text[a:b])))


def _lowest(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, first place of each, smallest and largest document of each)."""
    by = np.argsort(keys, kind="stable")
    keys, docs = keys[by], docs[by]
    first = np.nonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[0] if len(keys) else np.zeros(0, np.int64)
    if not len(first):
        return keys, by, docs, docs
    return keys[first], by[first], np.minimum.reduceat(docs, first), np.maximum.reduceat(docs, first)


def _concat(parts: list[np.ndarray], kind) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, kind)


# ---------------------------------------------------------------- first pass: signatures


def _asker(shards: int):
    def ask(boxes: pa.Table) -> pa.Table:
        """For each signature of the block: its distinct pieces, twice, and one more if several documents hold it."""
        block = Block(boxes)
        keys, pieces, low, high = [], [], [], []
        for _, w in block.slices:
            piece, at, lo, hi = _lowest(w.piece, block.docs[w.text])
            keys.append(w.key[at]), pieces.append(piece), low.append(lo), high.append(hi)
        keys, pieces, low, high = _concat(keys, _U), _concat(pieces, _U), _concat(low, np.int64), _concat(high, np.int64)
        by = np.lexsort((pieces, keys))
        keys, pieces, low, high = keys[by], pieces[by], low[by], high[by]
        if not len(keys):
            return ask_rows(0, keys, low, shards)
        fresh = np.concatenate([[True], keys[1:] != keys[:-1]])
        first = np.nonzero(fresh)[0]
        kinds = np.add.reduceat((fresh | np.concatenate([[True], pieces[1:] != pieces[:-1]])).astype(np.int64), first)
        several = np.minimum.reduceat(low, first) != np.maximum.reduceat(high, first)
        return ask_rows(block.number, keys[first], 2 * kinds + several, shards)

    return ask


def _levels(t: pa.Table) -> pa.Table:
    """0: one document holds the signature; 1: more; 2: more, and its pieces are very many."""
    blocks, _, distinct, sums, places = tally(t)
    held = np.bincount(_concat(places, np.int64), minlength=len(distinct))
    level = ((held > 1) | (sums % 2 == 1)).astype(np.uint8)  # a signature of one block has one count: its last bit is kept
    level[(level > 0) & (sums // 2 >= HOT)] = 2
    shard = t["shard"][0].as_py()
    press = zstandard.ZstdCompressor()
    return pa.table({
        "block": pa.array(blocks, pa.int32()), "shard": pa.array([shard] * len(blocks), pa.int32()),
        "levels": pa.array([press.compress(np.packbits(np.unpackbits(level[p][:, None], axis=1)[:, 6:]).tobytes()) for p in places], pa.binary()),
    })


def _levels_of(answers: pa.Table, sizes: list[int]) -> np.ndarray:
    """The levels of a block's signatures, from the answers of the ranges it asked."""
    press, out = zstandard.ZstdDecompressor(), []
    blobs = answers["levels"].to_pylist()
    for i, size in zip(np.argsort(answers["shard"].to_numpy()), sizes, strict=True):
        two = np.unpackbits(np.frombuffer(press.decompress(blobs[i]), np.uint8))[: 2 * size].reshape(-1, 2)
        out.append(two[:, 0] * 2 + two[:, 1])
    return _concat(out, np.uint8)


# ---------------------------------------------------------------- second pass: the bytes


class Pieces:
    """The distinct pieces of a block that go on, shard by shard and in the order of the text: the same in both uses.

    ``name`` is the hash by which they are told apart, ``low`` the smallest document of the block that holds them.
    """

    def __init__(self, block: Block, answers: pa.Table, shards: int, texts: bool):
        self.bounds = shard_bounds(shards)
        keys = np.unique(_concat([np.unique(w.key) for _, w in block.slices], _U))
        cuts = np.concatenate([[0], np.searchsorted(keys, self.bounds), [len(keys)]])
        level = _levels_of(answers, [n for n in np.diff(cuts).tolist() if n])
        self.keys, self.level = keys[level > 0], level[level > 0]
        found, body = [[] for _ in range(5)], []
        for _, w in block.slices:
            name, start, count, offset, route, text = self.going(w)
            name, at, low, _ = _lowest(name, block.docs[text])
            by = np.argsort(at)
            at = at[by]
            for column, values in zip(found, (name[by], low[by], count[at], offset[at], route[at]), strict=True):
                column.append(values)
            if texts:
                whole = w.data.tobytes()
                body += [whole[a:b] for a, b in zip(start[at].tolist(), (start[at] + count[at] + LENGTH - 1).tolist(), strict=True)]
        name, low, count, offset, route = (_concat(x, np.int64) for x in found)
        name, at, low, _ = _lowest(name, low)
        by = np.lexsort((at, route[at])) if len(at) else at
        at = at[by]
        self.name, self.low, self.count, self.offset, self.route = name[by], low[by], count[at], offset[at], route[at]
        self.body = [body[i] for i in at.tolist()] if texts else []

    def going(self, w: Windows):
        """(name, start, windows, place of the signature, shard, text) of the pieces of a slice that go on."""
        level = np.zeros(len(w.key), np.uint8)
        if len(self.keys):
            place = np.minimum(np.searchsorted(self.keys, w.key), len(self.keys) - 1)
            level = np.where(self.keys[place] == w.key, self.level[place], level)
        one, hot = np.nonzero(level == 1)[0], np.nonzero(level == 2)[0]
        # a hot signature: its windows one by one, routed by their own hash
        count = w.count[hot].astype(np.int64)
        each = np.repeat(hot, count)
        nth = np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)
        start = w.start[each] + nth
        own = hashes(w.data, start, LENGTH)
        both = lambda a, b, kind=np.int64: np.concatenate([a.astype(kind), b.astype(kind)])
        route = np.searchsorted(self.bounds, both(w.key[one], own, _U), side="right")
        return both(w.piece[one], own, _U), both(w.start[one], start), both(w.count[one], np.ones(len(each))), both(w.offset[one], w.offset[each] - nth), route, both(w.text[one], w.text[each])


def _sender(shards: int):
    def send(boxes: pa.Table, answers: pa.Table) -> pa.Table:
        if not boxes.num_rows or not answers.num_rows:
            return pa.table({"shard": pa.array([], pa.int32()), "block": pa.array([], pa.int32()), "pieces": pa.array([], pa.binary())})
        block = Block(boxes)
        p = Pieces(block, answers, shards, True)
        press, out = zstandard.ZstdCompressor(), []
        to, first = np.unique(p.route, return_index=True)
        for a, b in zip(first.tolist(), [*first[1:].tolist(), len(p.route)]):
            head = np.array([b - a], np.int64).tobytes() + pack_keys(np.diff(p.low[a:b], prepend=0).view(_U))
            out.append(press.compress(head + p.count[a:b].astype(np.uint8).tobytes() + p.offset[a:b].astype(np.uint8).tobytes() + b"".join(p.body[a:b])))
        return pa.table({"shard": pa.array(to, pa.int32()), "block": pa.array([block.number] * len(to), pa.int32()), "pieces": pa.array(out, pa.binary())})

    return send


def _digit(data: np.ndarray, p: np.ndarray, depth: int) -> np.ndarray:
    """The eight bytes of each window from ``depth`` on, the first the most significant; zeros beyond the window."""
    out = np.zeros(len(p), _U)
    for i in range(depth, min(depth + 8, LENGTH)):
        out |= data[p + i].astype(_U) << _U(8 * (7 - i + depth))
    return out


def _groups(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, number of the group of each in that order) of rows with equal columns."""
    by = np.lexsort(columns[::-1]) if len(columns) > 1 else np.argsort(columns[0], kind="stable")
    new = np.zeros(len(by), bool)
    for c in columns:
        new[1:] |= c[by][1:] != c[by][:-1]
    return by, np.cumsum(new)


def radix_minima(data: np.ndarray, start: np.ndarray, group: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The smallest document among the windows that equal each one; ``group`` holds what is known of their order."""
    low = doc.copy()
    alive = np.arange(len(start))
    for depth in range(0, LENGTH, 8):
        by, number = _groups(group, _digit(data, start[alive], depth))
        alive, size = alive[by], np.bincount(number)
        more = size[number] > 1  # groups of one are done
        alive, group = alive[more], number[more]
        if not len(alive):
            return low
    first = np.nonzero(np.concatenate([[True], group[1:] != group[:-1]]))[0]
    low[alive] = np.repeat(np.minimum.reduceat(doc[alive], first), np.diff(np.append(first, len(alive))))
    return low


def _judge(t: pa.Table) -> pa.Table:
    """A bit for each window of each piece: is there a smaller document that holds it?"""
    press, blocks = zstandard.ZstdDecompressor(), t["block"].to_pylist()
    lows, counts, offsets, bodies, sizes = [], [], [], [], []
    for blob in t["pieces"].to_pylist():
        raw = press.decompress(blob)
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        planes = np.frombuffer(raw, np.uint8, 8 * n, 8).reshape(8, n)
        lows.append(np.cumsum(np.ascontiguousarray(planes.T).view(np.int64).ravel()))
        counts.append(np.frombuffer(raw, np.uint8, n, 8 + 8 * n).astype(np.int64))
        offsets.append(np.frombuffer(raw, np.uint8, n, 8 + 9 * n).astype(np.int64))
        bodies.append(np.frombuffer(raw, np.uint8, -1, 8 + 10 * n))
        sizes.append(n)
    low, count, offset, data = _concat(lows, np.int64), _concat(counts, np.int64), _concat(offsets, np.int64), _concat(bodies, np.uint8)
    del lows, counts, offsets, bodies
    data = np.concatenate([data, np.zeros(LENGTH + 8, np.uint8)])
    start = np.cumsum(np.concatenate([[0], count + LENGTH - 1]))[:-1]
    sign, whole = hashes(data, start + offset, GRAM), np.zeros(len(start), _U)
    for i in range(LENGTH + REACH - 1):
        whole = whole * _U(_MIX) + np.where(i < count + LENGTH - 1, _BYTES[data[start + i]], _U(0))
    # equal pieces are one
    by, number = _groups(sign, scramble(whole) + (count * 256 + offset).astype(_U))
    first = np.nonzero(np.concatenate([[True], np.diff(number) > 0]))[0]
    least = np.minimum.reduceat(low[by], first)
    reps = by[first]
    piece = np.empty(len(by), np.int64)
    piece[by] = number
    same_sign = np.concatenate([[True], sign[reps][1:] != sign[reps][:-1]])
    signs = np.cumsum(same_sign) - 1
    lone = np.bincount(signs)[signs] == 1
    # windows of the signatures with several pieces
    many = np.nonzero(~lone)[0]
    size = count[reps[many]]
    each, begin = np.repeat(many, size), np.cumsum(size) - size
    nth = np.arange(len(each)) - np.repeat(begin, size)
    before = (signs[each] * REACH + offset[reps[each]] - nth).astype(_U)  # signature, and its place in the window
    found = radix_minima(data, start[reps[each]] + nth, before, least[each])
    base = np.zeros(len(reps), np.int64)
    base[many] = begin
    masks = np.zeros(len(start), np.uint32)
    for i in range(REACH):
        has = np.nonzero(count > i)[0]
        if not len(has):
            break
        p = piece[has]
        smallest = least[p].copy()
        wide = ~lone[p]
        smallest[wide] = found[base[p[wide]] + i]
        masks[has] |= (smallest < low[has]).astype(np.uint32) << np.uint32(i)
    squeeze = zstandard.ZstdCompressor()
    cuts = np.cumsum(sizes)[:-1]
    return pa.table({
        "block": pa.array(blocks, pa.int32()), "shard": pa.array([t["shard"][0].as_py()] * len(blocks), pa.int32()),
        "masks": pa.array([squeeze.compress(m.tobytes()) for m in np.split(masks, cuts)], pa.binary()),
    })


# ---------------------------------------------------------------- the answer


def _marker(shards: int):
    kind = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def mark(boxes: pa.Table, answers: pa.Table) -> pa.Table:
        if not boxes.num_rows:
            return kind.empty_table()
        block = Block(boxes)
        hit = np.zeros(len(block.data) + LENGTH, np.uint8)  # windows that go
        if answers.num_rows:
            kept = lambda c: answers.filter(pc.is_valid(answers[c]))
            given, press = kept("masks"), zstandard.ZstdDecompressor()
            p, blobs = Pieces(block, kept("levels"), shards, False), given["masks"].to_pylist()
            masks = _concat([np.frombuffer(press.decompress(blobs[i]), np.uint32) for i in np.argsort(given["shard"].to_numpy())], np.uint32)
            by = np.argsort(p.name)
            names, masks, low = p.name[by], masks[by], p.low[by]
            for begin, w in block.slices:
                name, start, count, _, _, text = p.going(w)
                at = np.searchsorted(names, name)
                # a document after the block's first to hold a piece loses all its windows
                mask = np.where(block.docs[text] > low[at], np.uint32((1 << REACH) - 1), masks[at])
                go = mask > 0
                mask, start, count = mask[go], start[go] + begin, count[go]
                for i in range(REACH):
                    hit[start[(count > i) & ((mask >> np.uint32(i)) & 1 == 1)] + i] = 1
        upto = np.concatenate([np.zeros(LENGTH, np.int64), np.cumsum(hit[: len(block.data)], dtype=np.int64)])
        gone = upto[LENGTH:] > upto[:-LENGTH]  # covered by one of the windows that start at most LENGTH - 1 bytes before
        text, n = block.text, len(block.lens)
        begins = gone & ~np.concatenate([[False], gone[:-1] & (text[1:] == text[:-1])]) if len(gone) else gone
        removed, spans = np.bincount(text[gone], minlength=n), np.bincount(text[begins], minlength=n)
        stay, ends = block.data[~gone].tobytes(), np.cumsum(block.lens - removed).tolist()
        kept = [hashlib.sha256(stay[a:b]).hexdigest() for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        ids = pa.array(block.docs, pa.int64(), mask=block.docs == NO_ID)
        return pa.table([ids, pa.array(block.lens, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.string())], schema=kind)

    return mark


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    spark = prepare(docs.sparkSession)
    shards = partitions(spark)
    doc_id, text = F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    block = F.pmod(F.xxhash64(doc_id, text), F.lit(2 * shards)).cast("int").alias("block")
    texts = docs.select(F.coalesce(doc_id, F.lit(NO_ID)).alias("doc_id"), text.alias("text"), block).mapInArrow(boxed, BOXES).groupBy("block")
    asked = texts.applyInArrow(_asker(shards), ASK)
    levels = asked.groupBy("shard").applyInArrow(_levels, "block int, shard int, levels binary").repartition("block")  # used twice
    pieces = texts.cogroup(levels.groupBy("block")).applyInArrow(_sender(shards), PIECES)
    masks = pieces.groupBy("shard").applyInArrow(_judge, ANSWERS)
    both = levels.withColumn("masks", F.lit(None).cast("binary")).unionByName(masks.withColumn("levels", F.lit(None).cast("binary")))
    return texts.cogroup(both.groupBy("block")).applyInArrow(_marker(shards), FOUND)
