"""Keep-latest deduplication (one row per key, newest version first)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

_RN = "__rn"


def tiebreak_columns(df: DataFrame, keys: Sequence[str], used: Sequence[str]) -> list[Column]:
    """Every other column, ascending, NULLs last, in schema order.

    Makes the pick deterministic when the ordering columns tie; complex columns
    are compared through their JSON text.
    """
    out = []
    for f in df.schema.fields:
        if f.name in keys or f.name in used or f.name == _RN:
            continue
        c = F.col(f.name)
        if isinstance(f.dataType, (StructType, ArrayType, MapType)):
            c = F.to_json(c)
        out.append(c.asc_nulls_last())
    return out


def _order_names(order: Sequence[str | Column]) -> list[str]:
    names = []
    for o in order:
        if isinstance(o, str):
            names.append(o)
    return names


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                tiebreak: bool = True, used: Sequence[str] = ()) -> DataFrame:
    """One row per ``keys``: the first by ``order`` (then by every other column).

    ``row_number() == 1`` plans as a partial ``WindowGroupLimit`` before the
    shuffle and a final one after it, so a key that holds a third of all rows
    is cut to one row per map task before anything moves.  All rows with a
    NULL key collapse to one, as in the reference.
    """
    order_cols = [F.col(o).desc_nulls_last() if isinstance(o, str) else o for o in order]
    if tiebreak:
        order_cols += tiebreak_columns(df, keys, list(used) + _order_names(order))
    w = Window.partitionBy(*keys).orderBy(*order_cols)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)
