"""Connected components, each round's table stored in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from paperloom.llm.common import stored
from paperloom.operators import components as plain


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a long, b long); root: the smallest node it reaches."""
    return plain.components(edges, lambda df: stored(df, "edges"), max_rounds=max_rounds)
