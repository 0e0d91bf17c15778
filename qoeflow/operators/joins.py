"""Left-deep N-way join chains."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def join_chain(frames: list[DataFrame], how: str, key) -> DataFrame:
    """``f1 ⋈ f2 ⋈ … ⋈ fn`` with one join type on the same using-columns (left-deep)."""
    if len(frames) < 2:
        raise ValueError("join_chain needs at least two frames")
    return reduce(lambda a, b: a.join(b, on=key, how=how), frames)
