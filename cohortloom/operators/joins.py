"""Joins with the skew handling their callers need."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def salted_join(
    many: DataFrame, one: DataFrame, keys: Sequence[str], salts: int, spread_by: Sequence[str]
) -> DataFrame:
    """Inner join where one key may hold much of ``many``.

    A key's rows in ``many`` go to ``salts`` tasks by a hash of ``spread_by``;
    the narrow side ``one`` is repeated per salt. The salt is a function of
    the row, so a retried task sends each row where it went before. The extra
    key also puts an exchange directly below both sides, the shape in which AQE
    can split what is still too large (such as copies of one row).
    """
    if salts <= 1:
        return many.join(one, list(keys), "inner")
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in spread_by]), F.lit(salts)).cast("int")
    left = many.withColumn("_salt", salt)
    right = one.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*keys, "_salt"], "inner").drop("_salt")
