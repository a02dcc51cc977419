"""What several test modules use; a module of its own, since ``conftest`` is a name that folders below take too."""

from __future__ import annotations


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    df = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in df.collect()), key=repr)
