"""Expressions on parking lots and their counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words in lot names, in order of precedence.
LOT_TYPE_WORDS = [("단기", "short"), ("장기", "long"), ("예약", "reservation")]
TERMINALS = ["T1", "T2"]
DIRECTIONS = ["arrival", "departure"]


def occupancy_ratio(occupied: Column, total: Column) -> Column:
    """Occupied share; may exceed 1 and is null for a closed lot."""
    return occupied / F.nullif(total, F.lit(0))


def is_operating(total: Column) -> Column:
    return total > 0


def lot_terminal(lot_name: Column) -> Column:
    prefix = F.regexp_extract(lot_name, "^(T[12])", 1)
    return F.when(prefix == "", F.lit("unknown")).otherwise(prefix)


def lot_terminal_strict(lot_name: Column) -> Column:
    """Terminal code, or null where the name does not start with one."""
    prefix = F.substring(lot_name, 1, 2)
    return F.when(prefix.isin(TERMINALS), prefix)


def lot_type(lot_name: Column) -> Column:
    chain = None
    for word, kind in LOT_TYPE_WORDS:
        chain = (F if chain is None else chain).when(lot_name.contains(word), kind)
    return chain.otherwise("unknown")


def clamp_non_negative(value: Column) -> Column:
    """Lower bound of zero that keeps null as null."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(0.0)))


def whole_spaces(ratio: Column, total: Column) -> Column:
    """Estimated count, rounding halves to even."""
    return F.rint(ratio * total).cast("int")
