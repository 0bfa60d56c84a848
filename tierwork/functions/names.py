"""Column names: quoting, renaming, cleaning."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class NameCollision(ValueError):
    """Two columns would end up under one name."""


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def named(name: str) -> Column:
    """The column called ``name``, whatever characters the name holds."""
    return F.col(quoted(name))


def free_name(stem: str, taken: Iterable[str]) -> str:
    """``stem``, lengthened until it clashes with none of ``taken`` (names match without case)."""
    used = {name.lower() for name in taken}
    while stem.lower() in used:
        stem += "_"
    return stem


class UnknownColumn(ValueError):
    """A column that is asked for by name is not there."""


def spelled(names: Iterable[str], columns: Iterable[str]) -> list[str]:
    """The names as the columns spell them; names match without case."""
    known = {column.lower(): column for column in columns}
    names = list(names)
    missing = [name for name in names if name.lower() not in known]
    if missing:
        raise UnknownColumn(f"no column {', '.join(missing)}")
    return [known[name.lower()] for name in names]


def _checked(df: DataFrame, names: list[str]) -> DataFrame:
    seen: dict[str, str] = {}
    for old, new in zip(df.columns, names):
        other = seen.setdefault(new.lower(), old)
        if other != old:
            raise NameCollision(f"columns {other!r} and {old!r} would both be named {new!r}")
    return df.toDF(*names)


def rename_columns(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """Rename by a fixed list; names the frame does not have are left out of account."""
    return _checked(df, [renames.get(name, name) for name in df.columns])


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Turn every run of characters other than letters, digits, underscores into one underscore."""
    return _checked(df, [re.sub(r"[^0-9A-Za-z_]+", "_", name) for name in df.columns])
