"""Mixing sources to target weights: iterative proportional fitting over (source, language, topic), in Spark SQL.

Tokens of all documents are summed per cell, the cells are raked to the three target marginals, and each document is
kept with the probability its cell's ratio of fitted to present tokens asks for.  A value that has no target (null
too) joins the rest cell ``*``; where ``*`` has no target it keeps its present share and the listed values divide what
is left.  So no document is lost by being unlisted, and there are at most
``(sources + 1) * (languages + 1) * (topics + 1)`` cells whatever the data hold: the fit is one row of that bound.
Targets of absent values are spread over the present ones.  A cell without any token keeps all its documents.  Empty tables give empty results.  Equal ids get equal draws, so repeated rows stay or go
together.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import WORD

DIMENSIONS = ("source", "lang", "topic")
ROUNDS = 20


def tokens(text: Column) -> Column:
    """Words of the whole text; 0 for null."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(f"({WORD})"), 0)), F.lit(0)).cast("long")


def topic_of(text: Column) -> Column:
    """A plain topic rule for tables without a topic column: the layout of the text."""
    t = F.coalesce(text, F.lit(""))
    return F.when(F.contains(t, F.lit(" | ")), "table").when(F.contains(t, F.lit("Licensed under")), "licensed").when(
        F.contains(t, F.lit("\n")), "article").otherwise("note")


def listed(value: Column, targets: Mapping[str, float]) -> Column:
    """The value itself if it has a target, else ``*``."""
    return F.when(value.isin(*[k for k in targets if k != "*"]), value).otherwise("*") if targets else F.lit("*")


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once: a lambda's argument is bound, an expression would be repeated."""
    return F.transform(F.array(value), use)[0]


def _total(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)


def _held(cells: Column, key: Column, i: Column) -> Column:
    """Weight of the cells whose i-th key is ``key``."""
    return F.aggregate(cells, F.lit(0.0), lambda a, x: a + F.when(x["keys"][i] == key, x["w"]).otherwise(0.0))


def fitted(cells: DataFrame, targets: Mapping[str, Mapping[str, float]], rounds: int = ROUNDS) -> DataFrame:
    """Rake the cells (source, lang, topic, tokens): returns their ``share`` of all tokens, the fitted ``weight`` and the ``ratio`` of the two.

    The bounded cells meet in one row; each step of one aggregate rakes one dimension.  ``ratio`` is null for a cell
    without tokens.
    """
    keys = F.array(*[F.concat(F.lit(f"{d}|"), F.col(d)) for d in DIMENSIONS])
    one = cells.agg(F.array_sort(F.collect_list(F.struct(keys.alias("keys"), F.col("tokens").cast("double").alias("w")))).alias("c"))
    names = F.create_map(*[F.lit(y) for d in DIMENSIONS for k, g in targets.get(d, {}).items() for y in (f"{d}|{k}", float(g))])

    def shares(c):
        return _let(F.greatest(_total(F.transform(c, lambda x: x["w"])), F.lit(1e-300)), lambda n: F.transform(
            c, lambda x: F.struct(x["keys"].alias("keys"), (x["w"] / n).alias("w"))))

    def goals_of(s, i):
        """(key, goal) of one dimension: unlisted keys keep their share, listed ones divide the rest by their targets."""
        present = F.array_sort(F.array_distinct(F.transform(s, lambda x: x["keys"][i])))
        known = F.transform(present, lambda k: F.struct(k.alias("key"), F.element_at(names, k).alias("t"), _held(s, k, F.lit(i)).alias("p")))
        return _let(known, lambda y: _let(_total(F.transform(y, lambda x: F.coalesce(x["t"], F.lit(0.0)))), lambda total: _let(
            _total(F.transform(y, lambda x: F.when(x["t"].isNull(), x["p"]).otherwise(0.0))), lambda free: F.transform(y, lambda x: F.struct(
                x["key"].alias("key"), F.when(x["t"].isNull() | (total <= 0), x["p"]).otherwise(x["t"] / total * (1 - free)).alias("goal"))))))

    def rake(s, i, goals):
        factors = F.map_from_entries(F.transform(goals[i], lambda g: _let(_held(s, g["key"], i), lambda h: F.struct(
            g["key"].alias("key"), F.when(h > 0, g["goal"] / h).otherwise(0.0).alias("f")))))
        return _let(factors, lambda f: F.transform(s, lambda x: F.struct(x["keys"].alias("keys"), (x["w"] * f[x["keys"][i]]).alias("w"))))

    steps = F.sequence(F.lit(0), F.lit(3 * rounds - 1))
    fit = _let(shares(F.col("c")), lambda s: _let(F.array(*[goals_of(s, i) for i in range(3)]), lambda goals: F.transform(F.arrays_zip(
        s.alias("s"), F.aggregate(steps, s, lambda acc, i: rake(acc, i % 3, goals)).alias("fit")), lambda z: F.struct(
            z["s"]["keys"].alias("keys"), z["s"]["w"].alias("share"), z["fit"]["w"].alias("weight")))))
    z = one.select(F.explode(fit).alias("z"))
    value = [F.substring(F.col("z.keys")[i], len(d) + 2, 2**31 - 1).alias(d) for i, d in enumerate(DIMENSIONS)]
    return z.select(*value, F.col("z.share").alias("share"), F.col("z.weight").alias("weight"), F.when(F.col("z.share") > 0, F.col("z.weight") / F.col("z.share")).alias("ratio"))


def calibrated(fit: DataFrame, keep: float) -> DataFrame:
    """The cells with ``prob`` = min(1, scale * ratio), the scale such that ``keep`` of all tokens are expected.

    Going down the ratios, the cells above are kept whole and the scale spreads what they leave over the rest; the
    first cell that the scale does not overfill settles it.  The windows run over the bounded cells only.
    """
    down = Window.orderBy(F.desc("ratio"), *DIMENSIONS)
    held = fit.where("ratio is not null")
    held = held.withColumns({
        "full": F.coalesce(F.sum("share").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "rest": F.sum("weight").over(down.rowsBetween(0, Window.unboundedFollowing)),
    }).withColumn("scale", (F.lit(float(keep)) - F.col("full")) / F.when(F.col("rest") > 0, F.col("rest")))
    fits = F.when(F.col("scale") * F.col("ratio") <= 1, F.col("scale"))
    every = down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    held = held.withColumn("prob", F.least(F.lit(1.0), F.coalesce(F.first(fits, ignorenulls=True).over(every) * F.col("ratio"), F.lit(1.0))))
    return held.select(*DIMENSIONS, "prob").union(fit.where("ratio is null").select(*DIMENSIONS, F.lit(1.0)))


def mixed(docs: DataFrame, targets: Mapping[str, Mapping[str, float]], keep: float = 0.5, seed: int = 0, topic: Column | None = None, rounds: int = ROUNDS) -> DataFrame:
    """The documents with ``cell`` (struct), ``prob`` and ``kept``; columns of those names are replaced.

    The expected tokens are ``keep`` of all, in the fitted shares unless a cell has too few tokens for its part and is
    kept whole.  The draw is the md5 of seed and id, so a task that runs again draws the same.
    """
    topic = topic_of(F.col("text")) if topic is None else topic
    cell = F.struct(
        listed(F.col("source"), targets.get("source", {})).alias("source"), listed(F.col("lang"), targets.get("lang", {})).alias("lang"),
        listed(topic, targets.get("topic", {})).alias("topic"),
    )
    docs = docs.withColumn("cell", cell)
    sums = docs.select("cell.*", tokens(F.col("text")).alias("tokens")).groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens"))
    fit = fitted(sums, targets, rounds)
    probs = calibrated(fit, keep).select(F.struct(*DIMENSIONS).alias("cell"), "prob")
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 13), 16, 10).cast("double") / float(2**52)
    # the cells are bounded by the targets, so is what is broadcast
    return docs.drop("prob", "kept").join(F.broadcast(probs), "cell").withColumn("kept", draw < F.col("prob"))
