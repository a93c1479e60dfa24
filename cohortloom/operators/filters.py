"""Bloom filters as small tables, for sides of joins with more keys than Catalyst's own filters are to hold.

A filter of Catalyst's is a value in the plan: the driver holds it several times for every stage that tests it,
and sends it with that stage's tasks. Here it is a row per block of bits, which a query broadcasts
once. What passes is joined as before; a filter only keeps rows that meet nothing out of the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.operators.staging import staged

MAX_BITS = 1 << 26  # 8 MB
_BLOCK_BITS = 4096  # 64 words of 64 bits
_MAX_PROBES = 5  # 12 bits of a 64-bit hash each


@dataclass(frozen=True)
class KeyFilter:
    """The keys of one side: ``table`` has the words of each block that holds any."""

    table: DataFrame
    keys: Sequence[str]
    types: Sequence[str]  # of the keys when they were hashed
    blocks: int
    probes: int

    def passing(self, df: DataFrame) -> DataFrame:
        """``df`` without most of the rows whose key the side lacks. No row that has one is lost."""
        key = _hash(self.keys, self.types)
        bits = F.broadcast(self.table)
        tests = [
            F.getbit(F.get("_words", F.shiftright(at, 6)), at.bitwiseAND(63)) == 1 for at in _places(key, self.probes)
        ]
        # A semi-join: Catalyst does not move the exact join below it, as it would below an inner one.
        return df.join(bits, reduce(lambda a, b: a & b, tests, _block(key, self.blocks) == F.col("_block")), "left_semi")


def filter_of(side: DataFrame, keys: Sequence[str], rows: int, name: str, max_bits: int = MAX_BITS) -> KeyFilter | None:
    """A filter of the keys of ``side``, which has ``rows`` rows, staged. Ten bits a key, 1 % of other rows
    pass, up to a bound; beyond it more pass, and None where most would."""
    bits = min(10 * max(rows, 1), max_bits)
    if 2 * bits < 3 * rows:
        return None
    blocks = -(-bits // _BLOCK_BITS)
    probes = min(max(round(0.69 * bits / max(rows, 1)), 1), _MAX_PROBES)
    types = [side.schema[k].dataType.simpleString() for k in keys]
    key = F.col("_key")
    words = (
        side.select(_hash(keys, types).alias("_key"))
        .select(_block(key, blocks).alias("_block"), F.array(*_places(key, probes)).alias("_places"))
        .repartition("_block")  # the keys move once; both groupings follow within the task
        .select("_block", F.explode("_places").alias("_at"))
        .groupBy("_block", F.shiftright("_at", 6).alias("_word"))
        .agg(F.expr("bit_or(shiftleft(1L, _at & 63))").alias("_bits"))
        .groupBy("_block")
        .agg(F.map_from_entries(F.collect_list(F.struct("_word", "_bits"))).alias("_found"))
    )
    none = F.lit(0).cast("long")
    every = F.transform(
        F.sequence(F.lit(0), F.lit(_BLOCK_BITS // 64 - 1)), lambda i: F.coalesce(F.try_element_at("_found", i), none)
    )
    return KeyFilter(staged(words.select("_block", every.alias("_words")), name), list(keys), types, blocks, probes)


def _hash(keys: Sequence[str], types: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k).cast(t) for k, t in zip(keys, types, strict=True)])


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(key, F.lit(blocks)).cast("int")


def _places(key: Column, probes: int) -> list[Column]:
    """The bits of a key within its block, by a second hash."""
    return [F.shiftright(F.xxhash64(key), 12 * i).bitwiseAND(_BLOCK_BITS - 1).cast("int") for i in range(probes)]
