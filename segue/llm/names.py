"""Column names that do not clash with those of the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame


def unused(df: DataFrame, *names: str) -> list[str]:
    """The given names, lengthened where ``df`` has a column of that name."""
    held = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in held:
            name += "_"
        found.append(name)
    return found
