"""Language identification by segmentation-marginalised unigrams.

A fixed public vocabulary of sub-word pieces (a SentencePiece model file, ``vocabulary`` parameter) is given a
probability per language.  The probability of a word is the sum over all its segmentations into pieces, by the forward
algorithm; the score of a text is the sum over all words of the whole text.  Piece probabilities are learned by
expectation-maximisation (forward-backward) from word counts.

The classifier is fitted on at most about ``FIT_DOCS`` labelled documents of each language, chosen by a hash of the id,
and on their ``FIT_WORDS`` most frequent (language, word) pairs.  Words are runs of letters in lower case; runs over
``LONG`` letters are scored in parts of that length, so nothing is left out.  Words whose probability is near the smallest
number (long runs of letters no language has) are computed again in logarithms, so every score is finite.  A text that is null or has no letter is
``und`` with score 0.  With no labelled row at all every text is ``und``.  Ties go to the first language in order.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import owner_of, slices, split_words, widened

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
FIT_DOCS, FIT_WORDS, LONG, MARK = 1500, 150_000, 64, "▁"
LATTICE = 4_000  # words whose segmentations are summed at once
_LETTERS = re.compile(r"[^\W\d_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = pow(int(_BASE), -1, 1 << 64)
_SLOTS, _LAYERS = 1 << 19, 4
UNKNOWN = 1e-8
# Below this a probability may have lost digits, or be 0.
FLOOR = 1e-250


def letter_runs(word: str) -> list[str]:
    """The pieces of text that are scored for one white-space word; the first carries the word mark."""
    runs = _LETTERS.findall(word.lower())
    return [(MARK if i == 0 else "") + r[i : i + LONG] for r in runs for i in range(0, len(r), LONG)]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Pieces:
    """The letter pieces of the vocabulary, found by hash."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        names = (sp.id_to_piece(i).lower() for i in range(sp.get_piece_size()))
        self.names = sorted({n for n in names if n and n != MARK and all(c.isalpha() for c in n.removeprefix(MARK))} | {MARK})
        self.longest = max(map(len, self.names))
        self.hash = np.array([self._hash(n) for n in self.names], np.uint64)
        self.layers = np.full((_LAYERS, _SLOTS), -1, np.int32)
        for i, h in enumerate(self.hash.tolist()):
            slot = (h >> 40) % _SLOTS
            free = np.nonzero(self.layers[:, slot] < 0)[0]
            self.layers[free[0], slot] = i

    @staticmethod
    def _hash(s: str) -> int:
        return sum((ord(c) + 1) * pow(int(_BASE), i, 1 << 64) for i, c in enumerate(s)) * 0xD6E8FEB86659FD93 % (1 << 64)

    def find(self, h: np.ndarray) -> np.ndarray:
        slot = ((h >> np.uint64(40)) % np.uint64(_SLOTS)).astype(np.int64)
        out = np.full(len(h), -1, np.int64)
        for layer in self.layers:
            at = layer[slot]
            hit = (at >= 0) & (self.hash[at] == h)
            out[hit] = at[hit]
        return out

    def lattice(self, words: list[str]):
        """Every place where a piece fits: (end within word, length, word, piece), and the lengths of the words."""
        lens = np.array([len(w) for w in words], np.int64)
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        n = len(chars)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(chars * _powers(int(_BASE), n), dtype=np.uint64)])
        inv = _powers(_INVERSE, n)
        word = np.repeat(np.arange(len(words)), lens)
        at = np.arange(n) - np.repeat(np.cumsum(lens) - lens, lens)
        ends, sizes, who, piece = [], [], [], []
        for size in range(1, min(self.longest, int(lens.max(initial=0))) + 1):
            i = np.nonzero(at + size <= lens[word])[0]
            p = self.find((sums[i + size] - sums[i]) * inv[i] * np.uint64(0xD6E8FEB86659FD93))
            ok = (p >= 0) | (size == 1)  # a letter outside the vocabulary is a piece of its own
            ends.append(at[i[ok]] + size)
            sizes.append(np.full(ok.sum(), size))
            who.append(word[i[ok]])
            piece.append(p[ok])
        ends, sizes, who, piece = (np.concatenate(x) for x in (ends, sizes, who, piece))
        by = np.lexsort((sizes, ends))
        return ends[by], sizes[by], who[by], piece[by], lens


def _steps(ends: np.ndarray, sizes: np.ndarray, n: int) -> Iterator[tuple[int, int, int, int]]:
    """(end, length, from, to) of the runs of a lattice's pieces with one end and length, by end."""
    cuts = np.append(np.searchsorted(ends, np.arange(1, n + 1)), len(ends))
    for e in range(1, n):
        a, b = cuts[e - 1], cuts[e]
        for s in np.unique(sizes[a:b]):
            i, j = a + np.searchsorted(sizes[a:b], [s, s + 1])
            yield e, s, i, j


@dataclass
class Model:
    pieces: Pieces
    langs: list[str]
    prob: np.ndarray  # (pieces + 1, languages); the last row is a letter outside the vocabulary

    def forward(self, lat, keep: bool = False):
        """Probability of every word in every language, summed over its segmentations."""
        ends, sizes, who, piece, lens = lat
        alpha = np.zeros((int(lens.max(initial=0)) + 1, len(lens), len(self.langs)))
        alpha[0] = 1
        cuts = np.searchsorted(ends, np.arange(1, alpha.shape[0] + 1))
        sized = np.concatenate([cuts, [len(ends)]])
        for e in range(1, alpha.shape[0]):
            a, b = sized[e - 1], sized[e]
            for s in np.unique(sizes[a:b]):
                i, j = a + np.searchsorted(sizes[a:b], [s, s + 1])
                alpha[e, who[i:j]] += alpha[e - s, who[i:j]] * self.prob[piece[i:j]]
        whole = alpha[lens, np.arange(len(lens))]
        return (whole, alpha) if keep else whole

    def expected(self, words: list[str], counts: np.ndarray) -> np.ndarray:
        """Expected piece counts (pieces + 1, languages) of the words that occur ``counts`` (words, languages) times."""
        lat = self.pieces.lattice(words)
        whole, alpha = self.forward(lat, True)
        low = (whole < FLOOR).any(axis=1)
        if low.any():
            parts = [(f, [w for w, x in zip(words, low == k, strict=True) if x], counts[low == k]) for k, f in ((True, self._expected_in_logs), (False, self.expected))]
            return sum((f(w, c) for f, w, c in parts if w), np.zeros_like(self.prob))
        ends, sizes, who, piece, lens = lat
        beta = np.zeros_like(alpha)
        beta[lens, np.arange(len(lens))] = 1
        out = np.zeros_like(self.prob)
        bounds = np.searchsorted(ends, np.arange(1, alpha.shape[0] + 1))
        for e in range(alpha.shape[0] - 1, 0, -1):
            a, b = bounds[e - 1], bounds[e] if e < len(bounds) else len(ends)
            for s in np.unique(sizes[a:b]):
                i, j = a + np.searchsorted(sizes[a:b], [s, s + 1])
                w, p = who[i:j], piece[i:j]
                through = self.prob[p] * beta[e, w]
                share = alpha[e - s, w] * through / whole[w] * counts[w]
                for k in range(share.shape[1]):
                    out[:, k] += np.bincount(p % len(out), share[:, k], len(out))
                beta[e - s, w] += through
        return out

    def log_forward(self, lat, keep: bool = False):
        """The logarithm of what ``forward`` gives, at any size."""
        ends, sizes, who, piece, lens = lat
        logs = np.log(self.prob)
        alpha = np.full((int(lens.max(initial=0)) + 1, len(lens), len(self.langs)), -np.inf)
        alpha[0] = 0
        for e, s, i, j in _steps(ends, sizes, alpha.shape[0]):
            w = who[i:j]
            alpha[e, w] = np.logaddexp(alpha[e, w], alpha[e - s, w] + logs[piece[i:j]])
        whole = alpha[lens, np.arange(len(lens))]
        return (whole, alpha) if keep else whole

    def _expected_in_logs(self, words: list[str], counts: np.ndarray) -> np.ndarray:
        lat = self.pieces.lattice(words)
        ends, sizes, who, piece, lens = lat
        whole, alpha = self.log_forward(lat, True)
        logs = np.log(self.prob)
        beta = np.full_like(alpha, -np.inf)
        beta[lens, np.arange(len(lens))] = 0
        out = np.zeros_like(self.prob)
        for e, s, i, j in reversed(list(_steps(ends, sizes, alpha.shape[0]))):
            w, p = who[i:j], piece[i:j]
            through = logs[p] + beta[e, w]
            share = np.exp(alpha[e - s, w] + through - whole[w]) * counts[w]
            for k in range(share.shape[1]):
                out[:, k] += np.bincount(p % len(out), share[:, k], len(out))
            beta[e - s, w] = np.logaddexp(beta[e - s, w], through)
        return out

    def log_likelihood(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(texts, languages) log-likelihood of the whole texts, and the letters they have."""
        codes, offsets, words = split_words(texts)
        runs = [letter_runs(w) for w in words.to_pylist()]
        who = np.repeat(np.arange(len(runs)), np.fromiter(map(len, runs), np.int64, len(runs)))
        number: dict[str, int] = {}
        which = np.array([number.setdefault(r, len(number)) for rs in runs for r in rs], np.int64)
        flat, score = list(number), np.zeros((len(number), len(self.langs) + 1))
        by = sorted(range(len(flat)), key=lambda i: len(flat[i]))
        for i in range(0, len(by), LATTICE):
            part = by[i : i + LATTICE]
            whole = self.forward(self.pieces.lattice([flat[k] for k in part]))
            low = (whole < FLOOR).any(axis=1)
            score[part, :-1] = np.log(np.maximum(whole, FLOOR))
            if low.any():
                deep = [k for k, x in zip(part, low, strict=True) if x]
                score[deep, :-1] = self.log_forward(self.pieces.lattice([flat[k] for k in deep]))
        score[:, -1] = [len(r) - (r[0] == MARK) for r in flat]
        per = np.stack([np.bincount(who, score[which, k], len(runs)) for k in range(score.shape[1])], 1)
        text = owner_of(offsets)
        total = np.stack([np.bincount(text, per[codes, k], len(offsets) - 1) for k in range(per.shape[1])], 1)
        return total[:, :-1], np.rint(total[:, -1])


def learn(words: list[str], counts: np.ndarray, langs: list[str], pieces: Pieces, rounds: int = 3, smooth: float = 0.05) -> Model:
    prob = np.full((len(pieces.names) + 1, len(langs)), 1 / len(pieces.names))
    prob[-1] = UNKNOWN
    model = Model(pieces, langs, prob)
    by = sorted(range(len(words)), key=lambda i: len(words[i]))
    for _ in range(rounds):
        total = np.zeros_like(prob)
        for i in range(0, len(by), LATTICE):
            part = by[i : i + LATTICE]
            total += model.expected([words[k] for k in part], counts[part])
        total = total[:-1] + smooth
        model.prob = np.concatenate([total / total.sum(0), np.full((1, len(langs)), UNKNOWN)])
    return model


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "text"):
        got: Counter = Counter()
        langs = b["lang"].to_pylist()
        codes, offsets, words = split_words(b["text"])
        runs = [letter_runs(w) for w in words.to_pylist()]
        for i, lang in enumerate(langs):
            w, c = np.unique(codes[offsets[i] : offsets[i + 1]], return_counts=True)
            for x, n in zip(w.tolist(), c.tolist(), strict=True):
                for r in runs[x]:
                    got[lang, r] += n
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in got], pa.string()), pa.array([k[1] for k in got], pa.string()), pa.array(list(got.values()), pa.int64())], ["lang", "word", "n"])


def fit(labelled: DataFrame, vocabulary: str = VOCABULARY, docs: int = FIT_DOCS, words: int = FIT_WORDS) -> Model | None:
    """Fit on (doc_id, text, lang); rows without text or language are left out."""
    labelled = labelled.select("doc_id", "text", "lang").where("text is not null and lang is not null")
    n = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}  # one row a language
    if not n:
        return None
    rate = F.create_map(*[F.lit(y) for k, c in n.items() for y in (k, min(1.0, docs / c))])
    u = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)) / float(1 << 40)
    counted = labelled.where(u < F.element_at(rate, F.col("lang"))).select("lang", "text").mapInArrow(_count, "lang string, word string, n long")
    top = counted.groupBy("lang", "word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang", "word").limit(words).toArrow()
    langs = sorted(n)
    word, at = np.unique(np.array(top["word"].to_pylist(), object), return_inverse=True) if top.num_rows else (np.zeros(0, object), np.zeros(0, int))
    counts = np.zeros((len(word), len(langs)))
    counts[at, [langs.index(x) for x in top["lang"].to_pylist()]] = top["n"].to_numpy()
    return learn(word.tolist(), counts, langs, Pieces(vocabulary))


def identified(docs: DataFrame, model: Model | None, evidence: float = 60.0) -> DataFrame:
    """The documents with ``lang_pred`` and ``score``, the posterior probability of the prediction.

    The log-likelihood of a text longer than ``evidence`` letters is scaled to that many, so that the score tells a
    mixed text from a plain one.
    """
    docs = docs.drop("lang_pred", "score")
    if model is None:
        return docs.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)})
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in slices(batches, "text"):
            ll, letters = m.log_likelihood(b.column(at))
            ll = ll * np.minimum(1, evidence / np.maximum(letters, 1))[:, None]
            post = np.exp(ll - ll.max(axis=1, keepdims=True))
            post /= post.sum(axis=1, keepdims=True)
            best = post.argmax(axis=1)
            pred = [m.langs[k] if n > 0 else "und" for k, n in zip(best, letters, strict=True)]
            score = np.where(letters > 0, post[np.arange(len(best)), best], 0.0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(pred, pa.string()), pa.array(score)], [*b.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(run, widened(docs, "lang_pred string, score double"))
