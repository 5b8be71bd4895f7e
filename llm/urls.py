"""URL filter: rules first, then a ratio of two character language models.

Accepted and rejected URLs each get a variable-order Markov model over a 64-symbol alphabet: counts of all contexts up
to ``order`` symbols, pruned to those seen ``min_count`` times, smoothed by the Witten-Bell rule down to the uniform
distribution, so any URL has a probability.  The score is the difference of the two log-likelihoods divided by the
length; a logistic calibration fitted on a held-out fold turns it into the probability of rejection.

The models are fitted on at most about ``FIT_ROWS`` labelled URLs of each class, chosen by a hash of the URL; every
URL is scored.  The bound caps the size of the model that is sent to the tasks.  Null or empty URLs score 0.  With one
class lacking (an empty table too) every score is 0 and the verdict is the default ``allow``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import calibrate, widened

FIT_ROWS = 40_000
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789.-/_?=&#%:~+@,;!*'()$[]|"  # then any other character, and the end
OTHER, END, BITS = 62, 63, 6

_CODE = np.full(65536, OTHER, np.uint8)
for _i, _c in enumerate(ALPHABET):
    _CODE[ord(_c)] = _CODE[ord(_c.upper())] = _i


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://`` or for null."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    host, path = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 1), F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 2)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """struct<rule, verdict> of the longest (verdict, "host/path") rule that fits, else null.

    A rule fits its host and all subdomains where the path starts with the rule's.  The list is a short parameter.
    """
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        h, slash, p = rule.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(slash + p)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def symbols(urls: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all URLs, each followed by the end, and where each URL starts."""
    raw = [(u or "").encode("utf-16-le", "surrogatepass") for u in urls]
    lens = np.array([len(r) // 2 for r in raw], np.int64)
    chars = _CODE[np.frombuffer(b"".join(raw), np.uint16)]
    starts = np.concatenate([[0], np.cumsum(lens + 1)])
    out = np.full(starts[-1], END, np.uint8)
    keep = np.ones(len(out), bool)
    keep[starts[1:] - 1] = False
    out[keep] = chars
    return out, starts


def grams(sym: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """For every symbol the packed last ``length`` symbols up to it; before the start of a URL stands the end symbol."""
    n = len(sym)
    place = np.arange(n) - np.repeat(starts[:-1], np.diff(starts))
    out = np.zeros(n, np.int64)
    for back in range(length - 1, -1, -1):
        s = np.full(n, END, np.int64)
        s[back:] = sym[: n - back] if back else sym
        s[place < back] = END
        out = (out << BITS) | s
    return out


class Markov:
    """Counts of contexts of one class, and their smoothed probabilities."""

    def __init__(self, counts: list[tuple[np.ndarray, np.ndarray]], min_count: int = 2):
        """``counts``: for lengths 1, 2, ... the sorted packed grams and how often each was seen."""
        self.levels = []
        for n, (key, count) in enumerate(counts, 1):
            ctx, first = np.unique(key >> BITS, return_index=True)
            total = np.add.reduceat(count, first) if len(key) else np.zeros(0, np.int64)
            kinds = np.diff(np.concatenate([first, [len(key)]]))
            keep = (total >= min_count) | (n <= 2)
            grams_kept = np.repeat(keep, kinds)
            self.levels.append((key[grams_kept], count[grams_kept].astype(float), ctx[keep], total[keep].astype(float), kinds[keep].astype(float)))

    def log_prob(self, sym: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Natural log probability of every symbol after those before it."""
        p = np.full(len(sym), 1.0 / 64)
        for n, (key, count, ctx, total, kinds) in enumerate(self.levels, 1):
            if not len(ctx):
                continue
            g, where = np.unique(grams(sym, starts, n), return_inverse=True)
            c = g >> BITS
            i = np.minimum(np.searchsorted(ctx, c), len(ctx) - 1)
            known = ctx[i] == c
            j = np.minimum(np.searchsorted(key, g), len(key) - 1)
            seen = np.where(key[j] == g, count[j], 0.0)
            t, k = np.where(known, total[i], 1.0), np.where(known, kinds[i], 0.0)
            seen, t, k, known = (x[where] for x in (seen, t, k, known))
            p = np.where(known, (seen + k * p) / (t + k), p)
        return np.log(p)


@dataclass
class UrlModel:
    accepted: Markov
    rejected: Markov
    slope: float = 1.0
    offset: float = 0.0

    def difference(self, urls: Sequence[str | None]) -> np.ndarray:
        """Log-likelihood under the rejected less under the accepted model, per symbol; 0 for an empty URL."""
        if not len(urls):
            return np.zeros(0)
        sym, starts = symbols(urls)
        d = np.add.reduceat(self.rejected.log_prob(sym, starts) - self.accepted.log_prob(sym, starts), starts[:-1])
        lens = np.diff(starts)
        return np.where(lens > 1, d / lens, 0.0)

    def p_reject(self, difference: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * difference + self.offset, -50, 50)))


def _bounded(df: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` rows of each label at most, the ones whose URL hashes lowest: the same rows on every run."""
    n = df.groupBy("rejected").count()
    share = F.least(F.lit(1.0), F.lit(float(rows)) / F.col("n"))
    rates = {r["rejected"]: r["s"] for r in n.withColumnRenamed("count", "n").select("rejected", share.alias("s")).collect()}  # two rows
    u = F.pmod(F.xxhash64("url"), F.lit(1 << 40)) / float(1 << 40)
    cut = F.when(F.col("rejected"), rates.get(True, 0.0)).otherwise(rates.get(False, 0.0))
    return df.where(u < cut)


def _count(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rej = b["rejected"].to_numpy(zero_copy_only=False).astype(bool)
            urls = b["url"].to_pylist()
            for side in (False, True):
                mine = [u for u, r in zip(urls, rej, strict=True) if r == side]
                if mine:
                    sym, starts = symbols(mine)
                    for n in range(1, length + 1):
                        key, count = np.unique(grams(sym, starts, n), return_counts=True)
                        yield pa.RecordBatch.from_arrays([pa.array([side] * len(key)), pa.array([n] * len(key), pa.int32()), pa.array(key), pa.array(count)], ["rejected", "n", "key", "c"])

    return run


def fit(labelled: DataFrame, order: int = 4, rows: int = FIT_ROWS, min_count: int = 2) -> UrlModel | None:
    """Fit on (url, rejected boolean); one URL in five calibrates.  None if a class is missing.  Null rows are left out."""
    labelled = labelled.select("url", "rejected").where("url is not null and rejected is not null")
    sample = _bounded(labelled, rows).withColumn("held", F.pmod(F.crc32("url"), F.lit(5)) == 0)
    learn = sample.where(~F.col("held")).select("url", "rejected")
    table = learn.mapInArrow(_count(order + 1), "rejected boolean, n int, key long, c long").groupBy("rejected", "n", "key").agg(F.sum("c").alias("c"))
    got = table.toArrow()  # bounded by the rows above
    side, n, key, c = (got[x].to_numpy() for x in ("rejected", "n", "key", "c"))
    models = []
    for s in (False, True):
        counts = []
        for k in range(1, order + 2):
            mine = (side == s) & (n == k)
            by = np.argsort(key[mine])
            counts.append((key[mine][by], c[mine][by]))
        if not len(counts[0][0]):
            return None
        models.append(Markov(counts, min_count))
    model = UrlModel(*models)
    held = sample.where("held").select("url", "rejected").toArrow()  # a fifth of the same bound
    if held.num_rows:
        model.slope, model.offset = calibrate(model.difference(held["url"].to_pylist()), held["rejected"].to_numpy().astype(float))
    return model


def judge(pages: DataFrame, model: UrlModel | None, threshold: float = 0.5) -> DataFrame:
    """The rows with ``llr`` (per symbol), ``p_reject`` and ``verdict``: block at ``threshold`` or more."""
    pages = pages.drop("llr", "p_reject", "verdict")
    if model is None:
        return pages.withColumns({"llr": F.lit(0.0), "p_reject": F.lit(0.0), "verdict": F.lit("allow")})
    sent = pages.sparkSession.sparkContext.broadcast(model)
    at = pages.columns.index("url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in batches:
            d = m.difference(b.column(at).to_pylist())
            p = m.p_reject(d)
            verdict = np.where(p >= threshold, "block", "allow")
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(d), pa.array(p), pa.array(verdict.astype(object), pa.string())], [*b.schema.names, "llr", "p_reject", "verdict"])

    schema = widened(pages, "llr double, p_reject double, verdict string")
    return pages.mapInArrow(run, schema)
