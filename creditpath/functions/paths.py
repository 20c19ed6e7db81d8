"""Column builders for path text and state transitions (built-in expressions only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import CONVERSION_STATE, NULL_STATE, PATH_SEPARATOR


def terminal_state(conversion: Column | str) -> Column:
    """``Conversion`` when the flag is 1, else ``Null`` (a NULL flag too)."""
    c = F.col(conversion) if isinstance(conversion, str) else conversion
    return F.when(c == 1, F.lit(CONVERSION_STATE)).otherwise(F.lit(NULL_STATE))


def path_states(path: Column | str) -> Column:
    """Path text -> array of trimmed state names."""
    p = F.col(path) if isinstance(path, str) else path
    return F.transform(F.split(p, ">"), lambda s: F.trim(s))


def transition_array(path: Column | str) -> Column:
    """Path text -> array of ``'A > B'`` for every consecutive pair (self-loops kept).

    Native replacement for a row-at-a-time Python UDF. A NULL path gives NULL
    (so ``explode`` yields no rows); a one-state path gives an empty array.
    """
    states = path_states(path)
    n = F.size(states)
    heads = F.slice(states, 1, F.greatest(n - 1, F.lit(0)))
    tails = F.when(n > 1, F.slice(states, 2, F.greatest(n - 1, F.lit(1)))).otherwise(
        F.array().cast("array<string>")
    )
    return F.zip_with(heads, tails, lambda a, b: F.concat(a, F.lit(PATH_SEPARATOR), b))


def split_transition(transition: Column | str, part: int) -> Column:
    """``trim(split(t, '>')[part])``: start (0) or end (1) state of ``'A > B'``."""
    t = F.col(transition) if isinstance(transition, str) else transition
    return F.trim(F.split(t, ">").getItem(part))


def register_sql_functions(spark) -> None:
    """Make ``transition_array(path)`` callable from SQL.

    A SQL function whose body is built-in expressions, so Catalyst inlines it
    and no Python worker is needed. Higher-order functions are interpreted,
    outside generated code.
    """
    states = "transform(split(path, '>'), s -> trim(s))"
    n = "size(split(path, '>'))"
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION transition_array(path STRING) "
        "RETURNS ARRAY<STRING> RETURN "
        f"zip_with(slice({states}, 1, greatest({n} - 1, 0)), "
        f"slice({states}, 2, greatest({n} - 1, 1)), "
        f"(a, b) -> concat(a, '{PATH_SEPARATOR}', b))"
    )
