"""Right-closed bins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def bin_label(col: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the bin (edge, next edge]; the last bin is open.

    Values at or below the first edge, and NULL, get no label.
    """
    if len(edges) != len(labels) or list(edges) != sorted(set(edges)):
        raise ValueError("need rising edges and one label for the bin above each")
    label = F.when(col <= edges[0], F.lit(None).cast("string"))
    for upper, name in zip(edges[1:], labels):
        label = label.when(col <= upper, F.lit(name))
    return label.when(col > edges[-1], F.lit(labels[-1]))
