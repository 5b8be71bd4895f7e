"""Alignment to a yearly grain, static layers and time tags."""

import calendar
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ANNUAL_METHODS = ("mean", "max", "min", "sum", "last")


def is_time_independent(obs_type: Column, time_start: Column) -> Column:
    return F.coalesce(obs_type == "event", F.lit(False)) | time_start.isNull()


def default_group() -> list[Column]:
    """Variable and rounded place: three decimals for degrees, two for metres."""
    return [
        F.col("variable"),
        F.round("latitude", 3).alias("latitude"),
        F.round("longitude", 3).alias("longitude"),
        F.round("depth_m", 2).alias("depth_m"),
    ]


def aggregate_to_annual(
    obs: DataFrame,
    method: str = "mean",
    group: Sequence[Column] | None = None,
    order: Sequence[str] = ("ord",),
) -> DataFrame:
    """One value per (group, year); time-independent rows are left out.

    ``last`` takes the row that comes last in ``order`` and is, like the rest, a
    partial aggregate.
    """
    value = F.col("value")
    reducers = {
        "mean": F.avg(value),
        "max": F.max(value),
        "min": F.min(value),
        "sum": F.sum(value),
        "last": F.max_by(value, F.struct(*order)),
    }
    if method not in reducers:
        raise ValueError(f"method must be one of {ANNUAL_METHODS}, got {method!r}")
    timed = obs.filter(~is_time_independent(F.col("obs_type"), F.col("time_start")))
    keys = default_group() if group is None else list(group)
    return timed.groupBy(*keys, F.year("time_start").alias("year")).agg(
        reducers[method].alias("value")
    )


def broadcast_static(df: DataFrame, years: Sequence[int]) -> DataFrame:
    """Repeat every row once per year."""
    return df.withColumn("year", F.explode(F.array(*[F.lit(int(y)) for y in years])))


def time_bound(text: str, upper: bool) -> datetime:
    """A full ISO bound as it is; ``YYYY`` and ``YYYY-MM`` padded to the period."""
    text = text.strip()
    parts = text.split("-")
    if len(parts) <= 2 and all(p.isdigit() for p in parts) and len(parts[0]) == 4:
        year = int(parts[0])
        month = int(parts[1]) if len(parts) == 2 else (12 if upper else 1)
        if upper:
            return datetime(year, month, calendar.monthrange(year, month)[1], 23, 59, 59)
        return datetime(year, month, 1)
    return datetime.fromisoformat(text)


def tag_bbox(obs: DataFrame, bbox: tuple[float, float, float, float]) -> DataFrame:
    """Mark rows inside (west, south, east, north), edges included; keeps every row."""
    west, south, east, north = bbox
    inside = F.col("longitude").between(west, east) & F.col("latitude").between(south, north)
    return obs.withColumn("in_bbox", inside)


def tag_time_range(obs: DataFrame, time_range: tuple[str, str]) -> DataFrame:
    """Mark rows inside the period; NULL for rows without a time."""
    lo, hi = time_bound(time_range[0], False), time_bound(time_range[1], True)
    t = F.coalesce("time_start", "time_end")
    return obs.withColumn(
        "in_time_range",
        t.between(F.lit(lo.isoformat(" ")).cast("timestamp"), F.lit(hi.isoformat(" ")).cast("timestamp")),
    )
