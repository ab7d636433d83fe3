"""Publishing keyed events: the data half of a message gateway."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventbase.functions.keys import message_key


def to_messages(
    df: DataFrame, app_key: Column, event_type: Column, fields: Sequence[str | Column], *carried: str
) -> DataFrame:
    """(key, JSON body) per row, plus any carried columns."""
    return df.select(
        message_key(app_key, event_type).alias("key"),
        F.to_json(F.struct(*fields)).alias("value"),
        *carried,
    )
