"""Keys, readings and ratios as SQL text.

A wide table needs hundreds of these expressions. Spark parses a text at once; the
same tree of Python calls takes seconds to build.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def quoted(name: str) -> str:
    """A column name that holds spaces, dots or slashes."""
    return "`" + name.replace("`", "``") + "`"


def normalize_key(key: str) -> str:
    """Key as text without leading zeros; its last character always stays."""
    text = f"cast({key} AS string)"
    return f"coalesce(nullif(trim(LEADING '0' FROM {text}), ''), right({text}, 1))"


def to_number(cell: str) -> str:
    """A reading as double, with comma or point; null when it is not a number.

    No letter but an exponent's is part of a number: ``1d`` and ``NaN`` are none.
    """
    text = f"replace(cast({cell} AS string), ',', '.')"
    return f"CASE WHEN {text} NOT RLIKE '[a-df-zA-DF-Z]' THEN try_cast({text} AS double) END"


def number_in(df: DataFrame, name: str) -> str:
    """``to_number`` of a column, skipping the text step where it is numeric already."""
    numeric = isinstance(df.schema[name].dataType, T.NumericType)
    return f"cast({quoted(name)} AS double)" if numeric else to_number(quoted(name))


def binarize(number: str) -> str:
    """1 for a positive reading, 0 for any other and for null."""
    return f"CASE WHEN {number} > 0 THEN 1 ELSE 0 END"


def to_flag(number: str) -> str:
    """A number as tinyint, fraction cut off; null when it does not fit."""
    return f"try_cast({number} AS tinyint)"


def cell_level(number: str, binary: bool) -> str:
    """What one reading adds to its day's flag."""
    return to_flag(binarize(number) if binary else number)


def rejected(cell: str, plain: bool = False) -> str:
    """True for a cell that holds something other than a number.

    Of a ``plain`` origin, also for a number that does not fit a flag.
    """
    wanted = to_flag(to_number(cell)) if plain else to_number(cell)
    return f"({cell} IS NOT NULL AND {wanted} IS NULL)"


def ratio(part: str, whole: str) -> str:
    """Quotient to four decimals, ties to the even digit."""
    return f"bround({part} / {whole}, 4)"
