"""Unit harmonisation to one canonical unit per variable."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.dims import CANONICAL_UNIT, UNIT_ALIAS, UNIT_CONVERSION
from cairn.functions.lookup import lookup
from cairn.functions.parse import strip

_ARROW = "->"
_SCALE = {f"{a}{_ARROW}{b}": k for (a, b), (k, _) in UNIT_CONVERSION.items()}
_OFFSET = {f"{a}{_ARROW}{b}": o for (a, b), (_, o) in UNIT_CONVERSION.items()}


def canonical_unit(variable: Column) -> Column:
    """Canonical unit, NULL for a categorical variable."""
    return lookup(variable, CANONICAL_UNIT)


def normal_unit(unit: Column) -> Column:
    """Fold alias spellings (any case); other units keep their spelling."""
    u = strip(unit)
    return F.coalesce(lookup(F.lower(u), UNIT_ALIAS), u)


def _factors(src: Column, dst: Column) -> tuple[Column, Column]:
    pair = F.concat(src, F.lit(_ARROW), dst)
    return lookup(pair, _SCALE), lookup(pair, _OFFSET)


def convert(value: Column, from_unit: Column, to_unit: Column) -> Column:
    """Linear conversion; a pair without a known conversion fails the job."""
    src, dst = normal_unit(from_unit), normal_unit(to_unit)
    scale, offset = _factors(src, dst)
    failure = F.raise_error(
        F.concat(F.lit("no unit conversion from "), from_unit, F.lit(" to "), to_unit)
    ).cast("double")
    return (
        F.when(src == dst, value)
        .when(scale.isNotNull(), value * scale + offset)
        .otherwise(failure)
    )


def to_canonical(obs: DataFrame, strict: bool = False) -> DataFrame:
    """Rewrite ``value`` and ``unit`` to the canonical unit of each row's variable.

    Categorical rows are untouched and a mere alias is respelled.  A unit without
    a conversion keeps its row as it is, or fails the job when ``strict``.
    """
    known = obs.withColumns(
        {"__target": canonical_unit(F.col("variable")), "__unit": normal_unit(F.col("unit"))}
    )
    scale, offset = _factors(F.col("__unit"), F.col("__target"))
    known = known.withColumns({"__scale": scale, "__offset": offset})
    unknown = (
        "double(raise_error(concat('no unit conversion from ', unit, ' to ', __target)))"
        if strict
        else "value"
    )
    return known.withColumns(
        {
            "value": F.expr(
                "case when __target is null or __unit = __target then value "
                f"when __scale is not null then value * __scale + __offset else {unknown} end"
            ),
            "unit": F.expr("if(__unit = __target or __scale is not null, __target, unit)"),
        }
    ).drop("__target", "__unit", "__scale", "__offset")


def unit_problems(obs: DataFrame) -> DataFrame:
    """One row per observation whose unit is not the canonical one."""
    target = canonical_unit(F.col("variable"))
    return obs.filter(target.isNotNull() & (F.col("unit") != target)).select(
        "obs_id",
        "variable",
        "unit",
        target.alias("canonical_unit"),
        F.concat_ws(
            "",
            F.col("obs_id"), F.lit(": "), F.col("variable"), F.lit(" has unit "),
            F.col("unit"), F.lit(", canonical is "), target,
        ).alias("message"),
    )
