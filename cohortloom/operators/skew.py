"""Keys that hold many rows: found in one pass, and dealt to tasks in proportion.

The pass is a sketch of frequent keys. It shuffles one small row per task, and the driver
gets at most ``most`` keys of each kind, however large the table. A key with more than
3.5 / ``tracked`` of the rows is certainly found, with a count that is off by no more than
that. Keys are known by a 64-bit hash. A wrong count or two keys of one hash cost a
slice too many or too few, never a row: rows meet by the keys themselves.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Slices = Mapping[int, int]  # hash of a key: number of slices its rows are dealt to

_SLICE = "_slice"


def heavy_keys(
    frames: Sequence[tuple[DataFrame, Mapping[str, Sequence[str]]]],
    rows_each: int,
    most: int = 200,
    tracked: int = 4096,
) -> dict[str, Slices]:
    """By name, the keys with more than ``rows_each`` rows, and into how many slices of about
    that many rows they are to be dealt. A frame is read once for all its named keys,
    and all frames in one job.

    Of more than ``most`` such keys the largest are given; each of the others holds less than
    1 / ``most`` of the rows, no more than a task's fair share.
    """
    parts = [
        df.agg(*[_frequent(keys, most, tracked).alias(name) for name, keys in kinds.items()])
        .select(F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("top")) for n in kinds])).alias("r"))
        .select("r.*")
        for df, kinds in frames
    ]
    if not parts:
        return {}
    found = reduce(DataFrame.unionByName, parts).collect()  # a row per name
    return {
        r["name"]: {t["item"]: -(-t["count"] // rows_each) for t in r["top"] if t["count"] > rows_each} for r in found
    }


def _frequent(keys: Sequence[str], most: int, tracked: int) -> Column:
    columns = ", ".join(f"`{k}`" for k in keys)
    return F.expr(f"approx_top_k(xxhash64({columns}), {most}, {tracked})")


def merged(found: Sequence[Slices]) -> Slices:
    """Slices for the rows of several frames together."""
    total: dict[int, int] = {}
    for slices in found:
        for key, n in slices.items():
            total[key] = total.get(key, 0) + n
    return total


def dealt(
    many: DataFrame, one: DataFrame, keys: Sequence[str], slices: Slices, spread_by: Sequence[str]
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides of a join and the columns to join them by. Rows of ``many`` with a heavy key
    are dealt to its slices by a hash of ``spread_by``, so that a retried task sends each where it went
    before; rows of ``one`` with that key are repeated per slice. All other rows
    stay single. Each row of ``many`` is in one slice, so it may also be the kept side of an outer join.
    """
    if not slices:
        return many, one, list(keys)
    hashes = list(slices)
    table = F.create_map(*[F.lit(v) for key in hashes for v in (key, slices[key])])

    def count(df: DataFrame) -> Column:
        key = F.xxhash64(*[F.col(k).cast(many.schema[k].dataType) for k in keys])
        return F.when(key.isin(hashes), F.element_at(table, key)).otherwise(F.lit(1))

    row = F.xxhash64(*[F.col(c) for c in spread_by])
    left = many.withColumn(_SLICE, F.pmod(row, count(many)).cast("int"))
    right = one.withColumn(_SLICE, F.explode(F.sequence(F.lit(0), (count(one) - 1).cast("int"))))
    return left, right, [*keys, _SLICE]


def sliced_join(
    many: DataFrame,
    one: DataFrame,
    keys: Sequence[str],
    slices: Slices,
    spread_by: Sequence[str],
    how: str = "inner",
) -> DataFrame:
    """``many`` joined with ``one``, inner or left, with the rows of heavy keys in ``slices``."""
    left, right, on = dealt(many, one, keys, slices, spread_by)
    return left.join(right, on, how).drop(_SLICE)
