"""Column choice, search and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellwatt.functions.scalars import quoted
from tellwatt.vocabulary import RESULT_SCHEMA


def resolve_columns(columns: Sequence[str], spec: str | None) -> list[str]:
    """Columns named by a list such as ``1-10,name,first-last``; all for None or ``*``.

    Positions count from 1 and are clamped; the ends of a range of names may
    come in any order; unknown names give nothing. Each column appears once.
    """
    if spec is None or spec.strip() == "*":
        return list(columns)
    chosen: dict[str, None] = {}
    for part in (p.strip() for p in spec.split(",")):
        ends = [e.strip() for e in part.split("-", 1)]
        if all(e.isascii() and e.isdigit() for e in ends):
            low, high = int(ends[0]), int(ends[-1])
            inside = [c for i, c in enumerate(columns, 1) if low <= i <= high]
        elif all(e in columns for e in ends):
            low, high = sorted(columns.index(e) for e in (ends[0], ends[-1]))
            inside = list(columns[low:high + 1])
        else:
            inside = []
        chosen.update(dict.fromkeys(inside))
    return list(chosen)


def select_columns(df: DataFrame, spec: str | None) -> DataFrame:
    chosen = resolve_columns(df.columns, spec)
    if not chosen:
        raise ValueError(f"no column matches {spec!r}")
    return df.select(*(quoted(c) for c in chosen))


def canonical_order(df: DataFrame, first: Sequence[str] = tuple(RESULT_SCHEMA.names)) -> DataFrame:
    """Known columns in their usual order, others behind."""
    known = [c for c in first if c in df.columns]
    return df.select(*(quoted(c) for c in known + [c for c in df.columns if c not in known]))


def search(df: DataFrame, column: str, text: str) -> DataFrame:
    """Rows whose ``column``, as text, contains ``text``."""
    return df.where(F.col(quoted(column)).cast("string").contains(text))


def sample_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows."""
    return df.limit(n)
