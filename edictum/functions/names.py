"""Names for helper columns that no column of the caller has."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def fresh(df: DataFrame | Iterable[str], *names: str) -> list[str]:
    """The names, with underscores before those that are taken; case does not tell names apart."""
    taken = {c.lower() for c in (df.columns if isinstance(df, DataFrame) else df)}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found
