"""Distinct counts that roll up (A03 / A11): exact bitmap states over dense keys.

A count of distinct patients per day cannot be added up to months. A *state* can be merged: per group and block of 32,768
keys, a bitmap of the keys that occur. States are merged by OR to any coarser grain (days to months, departments to
regions) without reading the facts again, and counted by their bits. Keys are D01's dense numbers, so a group has as many
bitmaps as its keys fill blocks. Merging combines map-side, bitmap by bitmap: no task holds a group's keys.

Use it for grains with many keys a group (a day of a region, a month of a department): a bitmap takes 4 KB before
compression however few keys it has, so fine grains are counted by ``measures.grain_totals``.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK, BITS = "bitmap_block", "bitmap"


def distinct_state(df: DataFrame, keys: Sequence[str], member: str) -> DataFrame:
    """(keys.., bitmap_block, bitmap): the ``member`` keys (integers; NULL does not count) of every group."""
    m = F.col(member).cast("bigint")
    return (df.where(m.isNotNull()).groupBy(*keys, F.bitmap_bucket_number(m).alias(BLOCK))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(m)).alias(BITS)))


def roll_up(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The state of a coarser grain; ``state`` has its keys as columns."""
    return state.groupBy(*keys, BLOCK).agg(F.bitmap_or_agg(BITS).alias(BITS))


def count_members(state: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Distinct members per group: the bits of its bitmaps."""
    return state.groupBy(*keys).agg(F.sum(F.bitmap_count(BITS)).alias(name))
