"""Names for helper columns that a table does not have."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Each wanted name, with a number behind it where ``df`` has a column of that name (in any case)."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in wanted:
        free = next(n for i in count() if (n := f"_{name}_{i}" if i else f"_{name}").lower() not in taken)
        taken.add(free.lower())
        found.append(free)
    return found
