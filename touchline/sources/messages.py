"""Keyed JSON messages: publish rows as messages, parse received ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from touchline.schemas import PAYLOAD_META

# Key of a standings document: its competition.
COMPETITION_KEY = (f"{PAYLOAD_META}.competition_id",)


def to_messages(df: DataFrame, topic: str, key_cols: Sequence[str] = ("id", "idEvent"),
                default_key: str = "unknown") -> DataFrame:
    """``(topic, key, value)``: key is the first non-NULL key column (as text)
    else ``default_key``; value is the whole row as JSON (NULL fields kept).
    A key column may be a field of a struct (``COMPETITION_KEY``)."""
    present = [c for c in key_cols if c.split(".")[0] in df.columns]
    key = F.coalesce(*[F.col(c).cast("string") for c in present], F.lit(default_key))
    return df.select(F.lit(topic).alias("topic"), key.alias("key"),
                     F.to_json(F.struct(*[F.col(c) for c in df.columns]),
                               {"ignoreNullFields": "false"}).alias("value"))


def parse_messages(df: DataFrame, value_col: str = "value",
                   observation: Observation | str | None = None) -> DataFrame:
    """Drop messages whose value is not valid JSON (any JSON value is kept,
    objects or not).  Works the same on a stream.

    ``observation`` (an ``Observation`` for batch, a name for a stream, whose
    metrics then appear in the query progress) counts ``received`` and
    ``dropped`` rows in the same pass, without a second job.
    """
    valid = F.try_parse_json(F.col(value_col)).isNotNull()
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("received"),
                        F.sum(F.when(valid, 0).otherwise(1)).alias("dropped"))
    return df.filter(valid)
