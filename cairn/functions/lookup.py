"""Constant tables as literal expressions: no join, no exchange, codegen-friendly."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def sql_literal(value) -> str:
    """A constant as SQL text."""
    if isinstance(value, str):
        quoted = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{quoted}'"
    return f"{value!r}D" if isinstance(value, float) else repr(value)


def lookup(key: Column, table: Mapping) -> Column:
    """``table[key]``, NULL for an unknown key.

    The table folds to one constant map, so ``key`` is evaluated once (a ``map()``
    call would be unrolled into a CASE that repeats the key in every branch).
    """
    keys = ", ".join(sql_literal(k) for k in table)
    values = ", ".join(sql_literal(v) for v in table.values())
    return F.expr(f"map_from_arrays(array({keys}), array({values}))")[key]


def member(key: Column, values: Sequence[str]) -> Column:
    """Membership in a constant list; NULL keys are not members."""
    return F.coalesce(F.array_contains(list_literal(values), key), F.lit(False))


def list_literal(values: Sequence[str]) -> Column:
    return F.expr(f"array({', '.join(sql_literal(v) for v in values)})")
