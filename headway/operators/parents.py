"""Joining realtime rows to the message or entity they belong to."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Folder column of tables written batch by batch.
BATCH = "batch_id"


def parent_key(child: DataFrame, parent: DataFrame, key: str) -> list[str]:
    """Columns to join ``child`` to ``parent`` on.

    A row is always written in the same batch as its parent. Where both tables are stored by
    batch, joining on the batch too lets a filter on the parent (say, the last half hour) prune
    the child's folders before they are read.
    """
    stored = BATCH in child.columns and BATCH in parent.columns
    return [key, BATCH] if stored else [key]


def to_parent(child: DataFrame, parent: DataFrame, key: str, *columns, how: str = "inner") -> DataFrame:
    """``child`` joined to ``columns`` of ``parent``."""
    on = parent_key(child, parent, key)
    return child.join(parent.select(*on, *columns), on, how)
