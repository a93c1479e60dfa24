"""Unions of event streams."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def stacked(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, columns matched by name."""
    return reduce(DataFrame.unionByName, frames)


def united(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows once; NULLs compare equal."""
    return stacked(frames).distinct()


def united_by_position(frames: Sequence[DataFrame]) -> DataFrame:
    """As ``united`` for frames with unlike names: the first frame's are kept."""
    names = frames[0].columns
    return united([f.toDF(*names) for f in frames])
