"""Toxicity by a weighted finite-state pattern grammar.

A text is cut into clauses.  The lexicon turns its words into symbols: insults of three strengths, threats, targets,
negations, words of reported speech, and others.  Three weighted transducers read the symbols of a clause: the first
weakens an insult or threat within three words after a negation, the second one that follows a word of speech, the
third weighs what is left, more if the clause also has a target, a threat only if it has.  They are composed into one
machine; the weight of the path it takes is the clause's score, so a word never counts outside its clause.  The sum of
the clause scores becomes a probability by a logistic calibration.

The lexicon is learned: words and word beginnings found in toxic and hardly in clean labelled texts, beside a short
fixed list.  Of near copies in what it learns from (three-word shingles, similarity 0.8 or more, as the Jaccard join finds
them) the first counts; texts that merely share words or a passage all count, and copies less alike than that do too.  It is fitted on at most about ``FIT_ROWS`` labelled documents, chosen by a hash of the id, and holds at
most ``LEXICON`` entries, the best supported first.  Every text is scored whole.  Null and empty texts have weight 0
and get the probability of a text without any match.  Without labels the fixed list and a fixed calibration are used.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import jaccard
from llm.common import calibrate, slices, split_words, stored, widened

FIT_ROWS, LEXICON, MIN_DOCS, EVIDENCE = 30_000, 20_000, 5, 14.0
OTHER, WEAK, MILD, STRONG, THREAT, TARGET, NOT, SAID = range(8)
STEMS = (4, 5, 6)

# The word list everything starts from.
FIXED = {
    STRONG: "idiot idiots moron morons scum bastard bastards asshole bitch retard imbecile cretin",
    MILD: "stupid loser losers trash worthless pathetic disgusting clown dumb ugly vermin filth garbage fool crétin ordure salaud abruti dummkopf arschloch abschaum trottel estúpido imbécil basura escoria",
    THREAT: "kill murder shoot stab strangle destroy hurt burn beat tuer töten umbringen matar",
    TARGET: "you your yours u he him she her they them those these people tu toi te vous vos du dich ihr euch sie tú ti usted ustedes vosotros",
    NOT: "not no never none nobody isn't aren't don't doesn't didn't wasn't won't cannot pas jamais aucun nicht nie kein keine nunca jamás ningún",
    SAID: "said says say saying claimed claims wrote writes called quoted reported alleged dit disait sagte sagt schrieb dijo dice escribió",
}
_LETTERS = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
_STOP = re.compile(r"[.!?;:]")


# ---------------------------------------------------------------- transducers


@dataclass(frozen=True)
class Transducer:
    """Deterministic: (state, symbol) -> (state, symbol, weight); every state accepts, with a weight of its own."""

    start: object
    arcs: dict
    final: dict = field(default_factory=dict)

    def __rshift__(self, other: Transducer) -> Transducer:
        """Composition: what this one writes, the other reads; weights add up."""
        arcs, final, todo, seen = {}, {}, [(self.start, other.start)], {(self.start, other.start)}
        symbols = sorted({s for _, s in self.arcs})
        while todo:
            a, b = at = todo.pop()
            final[at] = self.final.get(a, 0.0) + other.final.get(b, 0.0)
            for s in symbols:
                a2, mid, w = self.arcs[a, s]
                b2, out, v = other.arcs[b, mid]
                arcs[at, s] = ((a2, b2), out, w + v)
                if (a2, b2) not in seen:
                    seen.add((a2, b2))
                    todo.append((a2, b2))
        return Transducer((self.start, other.start), arcs, final)

    def weigh(self, symbols) -> float:
        state, total = self.start, 0.0
        for s in symbols:
            state, _, w = self.arcs[state, s]
            total += w
        return total + self.final.get(state, 0.0)


_WEAKER = {STRONG: WEAK, MILD: OTHER, WEAK: OTHER, THREAT: OTHER}
_LESS = {STRONG: MILD, MILD: WEAK, WEAK: OTHER, THREAT: WEAK}


def negation(window: int = 3) -> Transducer:
    arcs = {}
    for left in range(window + 1):
        for s in range(8):
            arcs[left, s] = (window, OTHER, 0.0) if s == NOT else (max(0, left - 1), _WEAKER.get(s, s) if left else s, 0.0)
    return Transducer(0, arcs)


def speech() -> Transducer:
    arcs = {}
    for told in (False, True):
        for s in range(8):
            arcs[told, s] = (True, OTHER, 0.0) if s == SAID else (told, _LESS.get(s, s) if told else s, 0.0)
    return Transducer(False, arcs)


def clause(insult=(0.0, 0.5, 1.5, 3.0), threat: float = 3.0, aimed: float = 1.0) -> Transducer:
    """State: (a target was read, an insult was read, a threat was read); the final weight joins what belongs together."""
    states = [(y, i, t) for y in (0, 1) for i in (0, 1) for t in (0, 1)]
    arcs, final = {}, {}
    for y, i, t in states:
        final[y, i, t] = aimed * (y and i) + threat * (y and t)
        for s in range(8):
            w = insult[s] if s in (WEAK, MILD, STRONG) else 0.0
            arcs[(y, i, t), s] = ((int(y or s == TARGET), int(i or s in (WEAK, MILD, STRONG)), int(t or s == THREAT)), s, w)
    return Transducer((0, 0, 0), arcs, final)


MACHINE = negation() >> speech() >> clause()


# ---------------------------------------------------------------- lexicon and texts


def parts(word: str) -> list[str]:
    return _LETTERS.findall(word.lower())


def units(word: str) -> set[str]:
    """What a word may be known by: itself, and its beginnings, marked by a star."""
    out = set()
    for p in parts(word):
        out.add(p)
        out.update(p[:n] + "*" for n in STEMS if len(p) > n)
    return out


@dataclass
class Model:
    lexicon: dict[str, int]
    slope: float = 2.0
    offset: float = -2.2

    def symbol(self, word: str) -> int:
        best = OTHER
        for p in parts(word):
            s = self.lexicon.get(p, OTHER)
            if s == OTHER:
                s = max((self.lexicon.get(p[:n] + "*", OTHER) for n in STEMS if len(p) > n), default=OTHER)
            best = max(best, s) if best in (OTHER, WEAK, MILD, STRONG) and s in (OTHER, WEAK, MILD, STRONG) else (s or best)
        return best

    def weights(self, texts) -> np.ndarray:
        """Sum of the clause scores of each whole text."""
        texts = pc.replace_substring(pc.fill_null(texts.cast(pa.large_string()), ""), "\n", " . ")
        codes, offsets, words = split_words(texts)
        known = words.to_pylist()
        symbols = np.array([self.symbol(w) for w in known], np.int8)
        stops = np.array([bool(_STOP.search(w)) for w in known], bool)
        out = np.zeros(len(offsets) - 1)
        if not len(codes):
            return out
        sym, stop = symbols[codes], stops[codes]
        ends = np.unique(np.concatenate([np.nonzero(stop)[0] + 1, offsets[1:]]))
        hot = np.nonzero((sym >= WEAK) & (sym <= THREAT))[0]
        for c in np.unique(np.searchsorted(ends, hot, "right")).tolist():
            a, b = int(ends[c - 1]) if c else 0, int(ends[c])
            out[np.searchsorted(offsets, a, "right") - 1] += MACHINE.weigh(sym[a:b].tolist())
        return out

    def probability(self, weights: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * np.log1p(weights) + self.offset, -50, 50)))


def _fixed() -> dict[str, int]:
    return {w: s for s, line in FIXED.items() for w in line.split()}


def evidence(t: int, c: int, toxic: int, clean: int) -> float:
    """Log-likelihood ratio of a unit's toxic and clean documents against the share of toxic ones overall."""
    base = (toxic + 1) / (toxic + clean + 2)
    n = t + c
    return (t * np.log(t / (n * base)) if t else 0.0) + (c * np.log(c / (n * (1 - base))) if c else 0.0)


def lexicon_of(counts: list[tuple[str, int, int]], toxic: int, clean: int) -> dict[str, int]:
    """Symbols of the units from (unit, toxic documents, clean documents)."""
    out, seen = _fixed(), {}
    for unit, t, c in counts:
        if evidence(t, c, toxic, clean) >= EVIDENCE:
            rate = t / (t + c)
            seen[unit] = STRONG if rate >= 0.95 else MILD if rate >= 0.8 else WEAK if rate >= 0.5 else OTHER
        elif c > 3 * t:
            seen[unit] = OTHER  # clean texts use a word of the fixed list
    for unit, s in seen.items():
        if out.get(unit, OTHER) in (OTHER, WEAK, MILD, STRONG, THREAT):
            out[unit] = s
    return {u: s for u, s in out.items() if s != OTHER}


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "text"):
        toxic = np.array(b["toxic"].to_pylist(), bool)
        codes, offsets, words = split_words(b["text"])
        who = np.repeat(np.arange(len(toxic)), np.diff(offsets))
        mine = [units(w) for w in words.to_pylist()]
        names: dict[str, int] = {}
        flat = np.array([names.setdefault(u, len(names)) for us in mine for u in us], np.int64)
        size = np.array([len(us) for us in mine], np.int64)
        start = np.cumsum(size) - size
        pair = np.unique(who * max(len(mine), 1) + codes)  # distinct words of each text
        who, code = pair // max(len(mine), 1), pair % max(len(mine), 1)
        n = size[code]
        spread = np.repeat(start[code] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        pair = np.unique(np.repeat(who, n) * max(len(names), 1) + flat[spread])
        who, unit = pair // max(len(names), 1), pair % max(len(names), 1)
        t = np.bincount(unit[toxic[who]], minlength=len(names))
        c = np.bincount(unit[~toxic[who]], minlength=len(names))
        yield pa.RecordBatch.from_arrays([pa.array(list(names), pa.string()), pa.array(t), pa.array(c)], ["unit", "t", "c"])


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Fit on documents (doc_id, text) and labels (doc_id, toxic); rows with a null id or label are left out."""
    labels = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = labels.count()
    if not n:
        return Model(_fixed())
    u = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / float(1 << 40)
    sample = labels.where(u < min(1.0, rows / n))  # bounded, so it may be sent to the tasks
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id").select("doc_id", "text", (F.col("toxic") > 0).alias("toxic"), (F.pmod(F.crc32(F.concat(F.lit("calibrate"), F.col("doc_id").cast("string"))), F.lit(5)) == 0).alias("held"))
    split = n >= 5000
    learn = stored(found.where(~F.col("held")) if split else found)  # no more than the sample; the join reads it again
    # the words of a group of copies would look like a lexicon: of near copies the first counts
    firsts = jaccard.joined(learn.select("doc_id", "text"), width=3, num=80, den=100).where("doc_id = component_id").select("doc_id").distinct()
    learn = learn.join(F.broadcast(firsts), "doc_id")
    total = learn.groupBy("toxic").count().collect()  # two rows
    size, fixed = {r["toxic"]: r["count"] for r in total}, [w for w, s in _fixed().items() if s <= THREAT]
    counts = (
        learn.select("text", "toxic").mapInArrow(_count, "unit string, t long, c long").groupBy("unit").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
        .where((F.col("t") >= MIN_DOCS) & (F.col("c") <= F.col("t")) | F.col("unit").isin(*fixed) & (F.col("c") > 3 * F.col("t"))).orderBy(F.desc("t"), "unit").limit(LEXICON)
    )
    # what the labels say of the fixed list counts too, so a fixed word that clean texts use is dropped
    model = Model(lexicon_of([tuple(r) for r in counts.collect()], size.get(True, 0), size.get(False, 0)))
    held = found.where("held") if split else found
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([pa.array(sent.value.weights(b["text"])), b["toxic"]], ["weight", "toxic"])

    got = held.select("text", "toxic").mapInArrow(weigh, "weight double, toxic boolean").toArrow()  # at most the sample
    if got.num_rows:
        a, b = calibrate(np.log1p(got["weight"].to_numpy()), got["toxic"].to_numpy().astype(float))
        if a > 0:
            model.slope, model.offset = a, b
    return model


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with ``weight`` (sum of clause scores) and ``toxicity`` (0 to 1); columns of those names are replaced."""
    docs = docs.drop("weight", "toxicity")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            w = sent.value.weights(b.column(at))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(w), pa.array(sent.value.probability(w))], [*b.schema.names, "weight", "toxicity"])

    return docs.mapInArrow(run, widened(docs, "weight double, toxicity double"))
