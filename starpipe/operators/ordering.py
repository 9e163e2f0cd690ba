"""Order specifications shared by the window-style operators.

An order item is a column name (ascending) or ``(name, "asc"|"desc")``.
NULLs always sort last, which is how every ordering of the pipeline is
written (latest record: desc nulls last; surrogate key: asc nulls last).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

OrderItem = str | tuple[str, str]


def normalize(order: Sequence[OrderItem]) -> list[tuple[str, str]]:
    out = []
    for item in order:
        if isinstance(item, str):
            out.append((item, "asc"))
        else:
            name, direction = item
            direction = direction.lower()
            if direction not in ("asc", "desc"):
                raise ValueError(f"bad direction {direction!r} for {name}")
            out.append((name, direction))
    return out


def sort_columns(order: Sequence[OrderItem]) -> list[Column]:
    cols = []
    for name, direction in normalize(order):
        c = F.col(name)
        cols.append(c.asc_nulls_last() if direction == "asc" else c.desc_nulls_last())
    return cols
