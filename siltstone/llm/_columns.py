"""Column names of tables that may hold any."""

from __future__ import annotations


def quoted(columns: list[str]) -> list[str]:
    """References to columns by their plain names, dots and back ticks included."""
    return ["`" + c.replace("`", "``") + "`" for c in columns]
