"""Keep-first / keep-last / top-k per key and exact medians, all skew-safe.

``row_number() <= k`` lets Spark cut every map task to k rows per key before the
shuffle, so a key that holds a third of the rows still ships k rows per task.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.session import stored

_STEPS = 64  # buckets per e-fold of magnitude
_SLICES = 4096
_MIDDLE = 1 << 20  # values around the middle that are counted one by one


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows per key in ``order``, with their rank as ``rank``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ("ord",)) -> DataFrame:
    return top_k(df, keys, [F.col(c).asc() for c in order], 1).drop("rank")


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ("ord",)) -> DataFrame:
    return top_k(df, keys, [F.col(c).desc() for c in order], 1).drop("rank")


def smallest_distinct(df: DataFrame, keys: Sequence[str], value: str, k: int) -> DataFrame:
    """The ``k`` smallest distinct values per key, joined into one sorted array."""
    few = top_k(df.select(*keys, value).distinct(), keys, [F.col(value).asc()], k)
    return few.groupBy(*keys).agg(F.array_sort(F.collect_list(value)).alias("examples"))


def value_bucket(value: Column) -> Column:
    """A step function that never decreases with ``value``; NULL for NULL and NaN."""
    size = F.log1p(F.abs(value) * 1e6) * _STEPS
    return F.when(~F.isnan(value), F.floor(F.signum(value) * F.least(size, F.lit(1e15))))


def histogram(
    df: DataFrame, keys: Sequence[str], value: str, weight: Column | None = None, more: Sequence[Column] = ()
) -> DataFrame:
    """Per key and bucket of ``value``: weight ``__c``, range ``__lo`` to ``__hi``, and the aggregates ``more``.

    A few thousand buckets per key at most, so the map tasks send no more than that.
    """
    v = F.col(value).cast("double")
    one = F.lit(1) if weight is None else weight
    return df.groupBy(*keys, value_bucket(v).alias("__b")).agg(
        F.sum(one).alias("__c"), F.min(v).alias("__lo"), F.max(v).alias("__hi"), *more
    )


def exact_median(
    df: DataFrame, keys: Sequence[str], value: str, weight: Column | None = None
) -> DataFrame:
    """Exact median per key by rank selection, without shuffling what lies off the middle.

    A histogram counts the buckets of each key; a running sum names the one or two that
    hold the middle ranks.  Only values in their range are counted further, in finer
    slices as long as a range holds more than ``_MIDDLE``, and then one by one.  A
    recomputed task always agrees with the first run, as no sampling is involved.  NULL
    and NaN values are left out.  Returns ``keys, n, median``.
    """
    one = F.lit(1) if weight is None else weight
    hist = histogram(df.filter(F.col(value).isNotNull()), keys, value, weight).filter("__b is not null")
    return median_by_rank(df, hist, keys, value, one)


def median_by_rank(
    df: DataFrame, hist: DataFrame, keys: Sequence[str], value: str, weight: Column | None = None
) -> DataFrame:
    """The median of ``df`` whose ``histogram`` is known."""
    keys = list(keys)
    by = [f"`{k}`" for k in keys]
    middle = stored(_middle(hist.selectExpr(*by, "__b as __s", "__c", "__lo", "__hi", "0L as __from", "cast(null as bigint) as __n"), keys))
    one = F.lit(1) if weight is None else weight
    values = df.select(*keys, F.col(value).cast("double").alias("__v"), one.alias("__w")).filter("not isnan(__v)")
    inside = lambda: _join_on(values, middle, keys, F.col("__v").between(F.col("__lo"), F.col("__hi")))
    while not middle.filter(f"__c > {_MIDDLE} and __lo < __hi").isEmpty():
        part = F.floor(F.try_divide(F.col("__v") - F.col("__lo"), F.col("__hi") - F.col("__lo")) * _SLICES)
        finer = inside().groupBy(*keys, "__n", "__from", F.coalesce(part, F.lit(0)).alias("__s")).agg(
            F.sum("__w").alias("__c"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi")
        )
        middle = stored(_middle(finer, keys))
    end = f"__from + sum(__c) over (partition by {', '.join([*by, '__from'])} order by __v rows between unbounded preceding and current row) as __to"
    ranked = inside().groupBy(*keys, "__n", "__from", "__v").agg(F.sum("__w").alias("__c")).selectExpr(*by, "__v", "__n", "__c", end)
    holds = "max(case when __to - __c <= {0} and __to > {0} then __v end)"
    return ranked.groupBy(*keys).agg(
        F.expr("max(__n) as n"),
        F.expr(f"({holds.format('(__n - 1) div 2')} + {holds.format('__n div 2')}) / 2 as median"),
    )


def _middle(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The parts that hold a middle rank: ``keys, __n, __from, __c, __lo, __hi``.

    ``__from`` counts what lies before the part, ``__n`` the whole group (NULL: the parts are all of it).
    """
    by = ", ".join([*[f"`{k}`" for k in keys], "__from"])
    running = "rows between unbounded preceding and current row"
    return (
        parts.selectExpr(
            "*", f"__from + sum(__c) over (partition by {by} order by __s {running}) as __to",
            f"coalesce(__n, sum(__c) over (partition by {by})) as __all",
        )
        .filter("__to - __c <= __all div 2 and __to > (__all - 1) div 2")
        .selectExpr(*[f"`{k}`" for k in keys], "__all as __n", "__to - __c as __from", "__c", "__lo", "__hi")
    )


def positions(df: DataFrame, keys: Sequence[str], order: str, name: str) -> DataFrame:
    """``row_number`` per key (from 1) along a numeric ``order`` column, for groups of any size.

    Rows are numbered inside equal-width slices of ``order``; a small histogram of
    the slices supplies what to add.  Ties in ``order`` are not allowed.
    """
    keys = list(keys)
    span = df.groupBy(*keys).agg(
        F.min(order).cast("double").alias("__lo"), F.max(order).cast("double").alias("__hi")
    )
    width = F.col("__hi") - F.col("__lo")
    part = F.when(
        width > 0, F.floor((F.col(order) - F.col("__lo")) / width * _SLICES)
    ).otherwise(F.lit(0)).cast("int")
    sliced = _join_on(df, span, keys).withColumn("__b", part).drop("__lo", "__hi")
    before = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(*keys, "__b").agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__add", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        .drop("__n")
    )
    within = Window.partitionBy(*keys, "__b").orderBy(order)
    return (
        _join_on(sliced.withColumn(name, F.row_number().over(within)), offsets, [*keys, "__b"])
        .withColumn(name, F.col(name) + F.col("__add"))
        .drop("__b", "__add")
    )


def _join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], where: Column | None = None) -> DataFrame:
    """Inner join whose keys may be NULL (a NULL group is a group)."""
    right = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    cond = F.lit(True) if where is None else where
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__r_{k}"))
    return left.join(right, cond).drop(*[f"__r_{k}" for k in keys])
