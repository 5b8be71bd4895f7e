"""Language-model scoring with an Elias-Fano n-gram trie.

The corpus is dealt into blocks by a hash of the id.  Each block counts its n-grams (orders 1 to ``order``; a text is
preceded and followed by the end token); each range of keys sums them over all blocks and answers every block with the
counts it asked for.  So a block learns the corpus counts of all the n-grams its texts hold and nothing else, whatever
the size of the corpus; nothing is broadcast.

The block then builds a trie of the seen ones: level n holds, context after context, the word numbers that follow,
made monotone by their context and Elias-Fano coded; the pointers from a context to its children are Elias-Fano coded
too; log10 probabilities and back-off weights are quantised.  Levels are written to an unlinked temporary file and
memory-mapped.  A lookup goes to the children of its context and searches the successor of the word number there.

Smoothing: p(w | context) = (c(context w) + mu p(w | shorter)) / (c(context) + mu), down to (c + 1) / (N + V + 1) for
single words, which leaves room for the unseen.  Null texts are empty: one end token.  Rows that repeat an id are
scored and counted each; a null id counts as empty text in the fold.  An empty table gives an empty result; without
training texts N and V are 0 and every token has probability 1.
"""

from __future__ import annotations

import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import BOXES, ask_rows, boxed, chain, pack_counts, partitions, scramble, split_words, tally, unboxed, unpack_counts, word_hashes

ORDER, MU, BITS = 3, (0.0, 20.0, 5.0), 12
KEY_BITS = 48  # of an n-gram of two words or more: of 10**9 distinct ones about 3 in a million share a key; words have 64
_KEY = np.uint64((2**64 - 1) ^ (2 ** (64 - KEY_BITS) - 1))
_END = np.uint64(0x5851F42D4C957F2D)
_SPAN = 12.0  # log10 probabilities from -12 to 0 are told apart


# ---------------------------------------------------------------- Elias-Fano


class Store:
    """An unlinked temporary file of arrays, mapped to memory."""

    def __init__(self):
        self.file = tempfile.TemporaryFile()

    def put(self, a: np.ndarray) -> np.ndarray:
        if not a.size:
            return a
        at = self.file.seek(0, 2)
        at += -at % 8
        self.file.seek(at)
        self.file.write(np.ascontiguousarray(a).tobytes())
        self.file.flush()
        return np.memmap(self.file, a.dtype, "r", at, a.shape)

    def close(self) -> None:
        self.file.close()


def _packed(bits: np.ndarray) -> np.ndarray:
    raw = np.packbits(bits, bitorder="little")
    return np.concatenate([raw, np.zeros(8 + -len(raw) % 8, np.uint8)]).view(np.uint64)


def _nth_set(words: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Place of the n-th set bit (from 0) in each word."""
    place, words, n = np.zeros(len(n), np.int64), words.copy(), n.astype(np.int64)
    for width in (32, 16, 8, 4, 2, 1):
        low = np.bitwise_count(words & np.uint64((1 << width) - 1)).astype(np.int64)
        up = n >= low
        n = np.where(up, n - low, n)
        words = np.where(up, words >> np.uint64(width), words)
        place += up * width
    return place


class EliasFano:
    """A non-decreasing sequence: low bits packed, high bits unary, with a running count of ones per word."""

    def __init__(self, values: np.ndarray, universe: int, store: Store):
        self.n, self.universe = len(values), max(int(universe), 1)
        self.low_bits = max(0, (self.universe // max(self.n, 1)).bit_length() - 1)
        values = values.astype(np.int64)
        l = self.low_bits
        low = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, count=l, bitorder="little").ravel()
        self.low = store.put(_packed(low).view(np.uint8))
        high = np.zeros(self.n + (self.universe >> l) + 2, np.uint8)
        high[(values >> l) + np.arange(self.n)] = 1
        self.high = store.put(_packed(high))
        self.ones = store.put(np.concatenate([[0], np.cumsum(np.bitwise_count(self.high).astype(np.int64))]))

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.int64)
        at = i * self.low_bits
        window = np.ndarray((len(self.low) - 7,), "<u8", self.low, strides=(1,))
        return ((window[at >> 3] >> (at & 7).astype(np.uint64)) & np.uint64((1 << self.low_bits) - 1)).astype(np.int64)

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.ones, i, "right") - 1
        at = word * 64 + _nth_set(self.high[word], i - self.ones[word])
        return ((at - i) << self.low_bits) | self._low(i)

    def _bucket(self, h: np.ndarray) -> np.ndarray:
        """How many values have high bits below ``h``."""
        zeros = np.arange(len(self.ones)) * 64 - self.ones
        k = np.maximum(h - 1, 0)
        word = np.searchsorted(zeros, k, "right") - 1
        at = word * 64 + _nth_set(~self.high[word], k - zeros[word])
        return np.where(h > 0, at + 1 - h, 0)

    def successor(self, x: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the first value >= x within [start, stop), and whether it equals x."""
        h, low = x >> self.low_bits, x & ((1 << self.low_bits) - 1)
        a, end = np.clip(self._bucket(h), start, stop), np.clip(self._bucket(h + 1), start, stop)
        b, todo = end.copy(), np.nonzero(a < end)[0]
        while len(todo):
            mid = (a[todo] + b[todo]) >> 1
            less = self._low(mid) < low[todo]
            a[todo] = np.where(less, mid + 1, a[todo])
            b[todo] = np.where(less, b[todo], mid)
            todo = todo[a[todo] < b[todo]]
        equal = a < end
        equal[equal] = self._low(a[equal]) == low[equal]
        return a, equal


def quantised(log10: np.ndarray, bits: int = BITS) -> np.ndarray:
    return np.rint(np.clip(-log10 / _SPAN, 0, 1) * ((1 << bits) - 1)).astype(np.uint16)


def restored(q: np.ndarray, bits: int = BITS) -> np.ndarray:
    return q.astype(np.float64) * (-_SPAN / ((1 << bits) - 1))


class Trie:
    """Levels of an n-gram trie over word numbers 0 .. words-1.

    ``grams[n]`` holds the distinct n-grams of order n + 2 as (context place in the level above, word number), in
    order; ``probs``/``backs`` their log10 probabilities and back-off weights, those of single words first.
    """

    def __init__(self, words: int):
        self.words, self.store = words, Store()
        self.levels: list[tuple[EliasFano, EliasFano]] = []
        self.probs: list[np.ndarray] = []
        self.backs: list[np.ndarray] = []

    def add_words(self, prob: np.ndarray, back: np.ndarray) -> None:
        self.probs.append(self.store.put(quantised(prob)))
        self.backs.append(self.store.put(quantised(back)))

    def add_level(self, context: np.ndarray, word: np.ndarray, prob: np.ndarray, back: np.ndarray) -> None:
        above = len(self.probs[-1])
        pointers = np.searchsorted(context, np.arange(above + 1))
        self.levels.append((EliasFano(pointers, len(context) + 1, self.store), EliasFano(context * self.words + word, above * self.words + 1, self.store)))
        self.add_words(prob, back)

    def find(self, level: int, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Place of each (context, word) in the level, -1 where it is not; a context of -1 has no children."""
        pointers, children = self.levels[level]
        out = np.full(len(word), -1, np.int64)
        ok = np.nonzero(context >= 0)[0]
        if len(ok) and children.n:
            c = context[ok]
            at, equal = children.successor(c * self.words + word[ok], pointers[c], pointers[c + 1])
            out[ok[equal]] = at[equal]
        return out

    def prob(self, level: int, at: np.ndarray) -> np.ndarray:
        return restored(self.probs[level][at])

    def back(self, level: int, at: np.ndarray) -> np.ndarray:
        return restored(self.backs[level][at])

    def close(self) -> None:
        self.store.close()


# ---------------------------------------------------------------- n-grams of a block


class Events:
    """The tokens of some texts, each with its n-grams; ``place[n]`` numbers the distinct ones of order n + 1."""

    def __init__(self, texts, order: int):
        codes, offsets, words = split_words(texts)
        h = word_hashes(words) if len(words) else np.zeros(0, np.uint64)
        lens = np.diff(offsets)
        self.starts = np.concatenate([[0], np.cumsum(lens + 1)])
        n = int(self.starts[-1])
        token = np.full(n, _END, np.uint64)
        inside = np.ones(n, bool)
        inside[self.starts[1:] - 1] = False
        token[inside] = h[codes]
        depth = np.arange(n) - np.repeat(self.starts[:-1], lens + 1)
        self.owner = np.repeat(np.arange(len(lens)), lens + 1)
        before = [token]
        for k in range(1, order):
            t = np.full(n, _END, np.uint64)
            t[k:] = token[:-k] if k else token
            t[depth < k] = _END
            before.append(t)
        self.keys, self.place, self.first, self.has = [], [], [], []
        for k in range(order):
            x = scramble(before[k] + np.uint64(1))
            for j in range(k - 1, -1, -1):
                x = chain(x, before[j])
            if k:
                x &= _KEY  # see KEY_BITS
            has = depth >= k - 1  # the end token before the text counts as one word of context
            at = np.nonzero(has)[0]
            x = x[at]
            by = np.argsort(x)
            x, at = x[by], at[by]
            new = np.ones(len(x), bool)
            new[1:] = x[1:] != x[:-1]
            whole = np.full(n, -1, np.int64)
            whole[at] = np.cumsum(new) - 1
            self.keys.append(x[new])
            self.place.append(whole)
            self.first.append(at[new])
            self.has.append(has)

    def counts(self, n: int, wanted: np.ndarray) -> np.ndarray:
        """How often each distinct n-gram of order n + 1 occurs in the texts wanted."""
        use = self.has[n] & wanted[self.owner]
        return np.bincount(self.place[n][use], minlength=len(self.keys[n])).astype(np.int64)


ASK = "shard int, block int, keys array<binary>, counts array<binary>"
ANSWER = "block int, shard int, counts array<binary>, total long, kinds long"
_NONE = (b"", pack_counts(np.zeros(0, np.int64)))
_BLOBS = pa.list_(pa.binary())


def _asker(order: int, shards: int):
    def ask(boxes: pa.Table) -> pa.Table:
        """One row for each key range, with the keys and counts of every order."""
        t, block = unboxed(boxes), boxes["block"][0].as_py()
        ev, train = Events(t["text"], order), ~t["held_out"].to_numpy().astype(bool)
        rows: dict[int, list] = {}
        for n in range(order):
            got = ask_rows(block, ev.keys[n], ev.counts(n, train), shards)
            for shard, keys, counts in zip(got["shard"].to_pylist(), got["keys"].to_pylist(), got["counts"].to_pylist(), strict=True):
                rows.setdefault(shard, [_NONE] * order)[n] = (keys, counts)
        return pa.table({
            "shard": pa.array(list(rows), pa.int32()), "block": pa.array([block] * len(rows), pa.int32()),
            "keys": pa.array([[k for k, _ in r] for r in rows.values()], _BLOBS), "counts": pa.array([[c for _, c in r] for r in rows.values()], _BLOBS),
        })

    return ask


def _answerer(order: int, blocks: int):
    def answer(t: pa.Table) -> pa.Table:
        """One row for every block, as each needs N and V, with the sums of what it asked for."""
        keys, counts, shard = t["keys"].to_pylist(), t["counts"].to_pylist(), t["shard"][0].as_py()
        blobs, total, kinds = [[_NONE[1]] * order for _ in range(blocks)], 0, 0
        for n in range(order):
            part = pa.table({"block": t["block"], "keys": pa.array([k[n] for k in keys], pa.binary()), "counts": pa.array([c[n] for c in counts], pa.binary())})
            asked, _, _, sums, places = tally(part)
            for b, p in zip(asked, places, strict=True):
                blobs[b][n] = pack_counts(sums[p])
            if n == 0:
                total, kinds = int(sums.sum()), int((sums > 0).sum())
        return pa.table({
            "block": pa.array(range(blocks), pa.int32()), "shard": pa.array([shard] * blocks, pa.int32()), "counts": pa.array(blobs, _BLOBS),
            "total": pa.array([total] * blocks, pa.int64()), "kinds": pa.array([kinds] * blocks, pa.int64()),
        })

    return answer


def block_scores(texts, counts: list[np.ndarray], total: int, kinds: int, order: int, mu=MU):
    """(tokens, known tokens, base score, score) of each text, from the corpus counts of the block's n-grams."""
    ev = Events(texts, order)
    docs = len(ev.starts) - 1
    c1, w = counts[0], ev.place[0]
    p1 = np.log10((c1 + 1) / (total + kinds + 1))
    size = np.diff(ev.starts)
    known = np.bincount(ev.owner, c1[w] > 0, docs).astype(np.int64)
    base = np.bincount(ev.owner, p1[w], docs)

    def back(c, n):  # of a context seen c times, to the order below n + 1
        return np.log10(mu[n] / (c + mu[n])) if n < order else np.zeros(len(c))

    trie = Trie(len(c1))
    trie.add_words(p1, back(c1, 1))
    node = [np.arange(len(c1))]  # of the distinct n-grams of each order, their place in the trie or -1
    score = [trie.prob(0, np.arange(len(c1)))]  # log10 probability of their last word after the rest
    end = int(np.searchsorted(ev.keys[0], scramble(np.array([_END + np.uint64(1)], np.uint64)))[0])
    for n in range(1, order):
        at = ev.first[n]
        prev = np.maximum(at - 1, 0)
        opening = ev.starts[ev.owner[at]] == at  # only for n = 1: the context is the end token
        ctx = np.where(opening, end, ev.place[0][prev]) if n == 1 else ev.place[n - 1][prev]
        word, low, c = w[at], ev.place[n - 1][at], counts[n]
        above = node[n - 1][ctx]
        by = np.lexsort((word, above))  # neighbours in the trie, for writing and for reading it
        seen = by[(c[by] > 0) & (above[by] >= 0)]
        lower = 10.0 ** score[n - 1][low]
        p = np.log10((c[seen] + mu[n] * lower[seen]) / (counts[n - 1][ctx[seen]] + mu[n]))
        trie.add_level(above[seen], word[seen], p, back(c[seen], n + 1))
        found = np.empty(len(word), np.int64)
        found[by] = trie.find(n - 1, above[by], word[by])
        hit = found >= 0
        s = score[n - 1][low] + np.where(above >= 0, trie.back(n - 1, np.maximum(above, 0)), 0.0)
        s[hit] = trie.prob(n, found[hit])
        node.append(found)
        score.append(s)
    best = score[0][w]
    for n in range(1, order):
        if len(score[n]):  # texts of one token have no longer n-gram
            best = np.where(ev.has[n], score[n][np.maximum(ev.place[n], 0)], best)
    trie.close()
    return size, known, base, np.bincount(ev.owner, best, docs)


def _scorer(order: int):
    def run(boxes: pa.Table, answers: pa.Table) -> pa.Table:
        kind = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
        if not boxes.num_rows:
            return kind.empty_table()
        t = unboxed(boxes)
        by, blobs = np.argsort(answers["shard"].to_numpy()), answers["counts"].to_pylist()
        counts = [np.concatenate([unpack_counts(blobs[i][n]) for i in by]) for n in range(order)]
        total, kinds = int(answers["total"].to_numpy().sum()), int(answers["kinds"].to_numpy().sum())
        size, known, base, score = block_scores(t["text"], counts, total, kinds, order)
        return pa.table([t["doc_id"].cast(pa.int64()), t["held_out"], pa.array(size, pa.int64()), pa.array(known), pa.array([total] * len(size), pa.int64()), pa.array(base), pa.array(score)], schema=kind)

    return run


def scored(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """Of every row of (doc_id, text, held_out): its tokens, the base score and the model's log10 probability.

    Rows with ``held_out`` false are what the model learns from.
    """
    shards = partitions(docs.sparkSession)
    blocks = 2 * shards
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    block = F.pmod(F.xxhash64("doc_id", text), F.lit(blocks)).cast("int")
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.coalesce("held_out", F.lit(False)).alias("held_out"), block.alias("block")).mapInArrow(boxed, BOXES)
    asked = dealt.groupBy("block").applyInArrow(_asker(order, shards), ASK)
    answers = asked.groupBy("shard").applyInArrow(_answerer(order, blocks), ANSWER)
    out = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_scorer(order), out)
