"""Literal cases dealt over the rows of a table: row k has case k modulo their number, in Spark and in SQL alike.

The expected results are literal too, so a wrong word list or pattern in the library can't pass its own check."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from vacantia.plans.postings import table
from vacantia.registry import register


def dealt(key: str, values: list) -> Column:
    """The value of the row's case."""
    kind = next((k for t, k in ((bool, "boolean"), (int, "long"), (float, "double"), (str, "string")) if any(isinstance(v, t) for v in values)), "string")
    return F.element_at(F.array(*(F.lit(v).cast(kind) for v in values)), (F.pmod(F.col(key), F.lit(len(values))) + 1).cast("int"))


def dealt_sql(key: str, values: list) -> str:
    """The same in SQL."""

    def lit(v: object) -> str:
        if v is None:
            return "NULL"
        return str(v).lower() if isinstance(v, bool) else repr(v) if isinstance(v, (int, float)) else "'" + str(v).replace("'", "''") + "'"

    return f"([{', '.join(map(lit, values))}])[1 + {key} % {len(values)}]"


def register_cases(name: str, source: str, key: str, inputs: list, make: Callable, **expected: list) -> None:
    """The query applies ``make`` (of one column for each part of an input; it gives columns in the order of ``expected``) to every row."""
    parts = [list(p) for p in zip(*inputs)] if isinstance(inputs[0], tuple) else [inputs]
    if any(len(v) != len(inputs) for v in expected.values()):
        raise ValueError(name)

    def run(s, d):
        out = make(*(dealt(key, p) for p in parts))
        out = out if isinstance(out, (tuple, list)) else [out]
        return table(s, d, source).select(key, *(c.alias(n) for c, n in zip(out, expected, strict=True)))

    register(name, run, f"SELECT {key}, {', '.join(f'{dealt_sql(key, v)} AS {n}' for n, v in expected.items())} FROM {source}")
