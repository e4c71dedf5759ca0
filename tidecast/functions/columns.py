"""Scalar column expressions. All are built-in Spark functions, so they stay
inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quoted_name(name: str) -> str:
    """A column's name as SQL text."""
    return "`" + name.replace("`", "``") + "`"


def series_key(*parts: ColumnOrName, sep: str = "_", suffix: str | None = None) -> Column:
    """``item_store_evaluation`` style id; null when any part is null."""
    cols: list[Column] = []
    for i, part in enumerate(parts):
        if i:
            cols.append(F.lit(sep))
        cols.append(_col(part))
    if suffix is not None:
        cols += [F.lit(sep), F.lit(suffix)]
    return F.concat(*cols)


def dept_key(item: ColumnOrName, sep: str = "_", parts: int = 2, join: str = "_") -> Column:
    """First ``parts`` pieces of a delimited id, rejoined (HOBBIES_1_001 ->
    HOBBIES_1). Null when the id has fewer pieces: ``get`` is null-safe
    under ANSI where ``[]`` would raise."""
    pieces = F.split(_col(item), _regex_literal(sep))
    out: list[Column] = []
    for i in range(parts):
        if i:
            out.append(F.lit(join))
        out.append(F.get(pieces, i))
    return F.concat(*out)


def _regex_literal(sep: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\/" else ch for ch in sep)


def day_index(label: ColumnOrName, prefix: str = "d_") -> Column:
    """Number after an anchored prefix (``d_17`` -> 17); null when it is not
    a number, instead of an ANSI cast error."""
    stripped = F.regexp_replace(_col(label), "^" + _regex_literal(prefix), "")
    return stripped.try_cast("int")


def day_number(date: ColumnOrName, origin: str = "1995-01-01") -> Column:
    """1-based day count from an origin date (origin itself is day 1)."""
    return (F.datediff(_col(date), F.lit(origin).cast("date")) + 1).cast("int")


def saturday_wday(date: ColumnOrName) -> Column:
    """Weekday number with Saturday = 1 ... Friday = 7."""
    return (F.dayofweek(_col(date)) % 7 + 1).cast("int")


def revenue(quantity: ColumnOrName, price: ColumnOrName) -> Column:
    return _col(quantity) * _col(price)
