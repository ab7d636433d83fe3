"""Realtime aggregation: windows over event time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from eventbase.operators.analysis import Measures, aggregate
from eventbase.operators.keyed_table import ORDER, KeyedTable
from eventbase.session import prepare
from eventbase.streaming.ingest import stream_of


def windowed(
    events: DataFrame,
    event_time: str,
    measures: Measures,
    *,
    size: str | None = None,
    slide: str | None = None,
    session_gap: str | None = None,
    watermark: str | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Tumbling (``size``), sliding (``size`` and ``slide``) or session windows per key.

    With a watermark, state of windows older than it is dropped, and so are late events.
    """
    if (size is None) == (session_gap is None):
        raise ValueError("give either size or session_gap")
    # Event time must be a timestamp with the session's zone to carry a watermark.
    events = events.withColumn(event_time, F.col(event_time).cast("timestamp"))
    if watermark:
        events = events.withWatermark(event_time, watermark)
    if session_gap:
        window = F.session_window(event_time, session_gap)
    else:
        window = F.window(event_time, size, slide)
    result = aggregate(events, [window.alias("window"), *keys], measures)
    return result.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *keys,
        *measures,
    )


def write_results(
    result: DataFrame,
    path: str,
    *,
    checkpoint: str,
    keys: Sequence[str] = (),
    mode: str = "append",
    available_now: bool = False,
    batch_ms: int = 4000,
    compact_every: int = 50,
) -> StreamingQuery:
    """Keep the rows of a stream under ``path``.

    "append" adds rows once they are final (a window, when the watermark has passed it), in
    one folder per stream and batch (``read_appended``), so a stream with a new checkpoint adds to what is there. "update", for windowed aggregates, upserts every window that a batch changed into a keyed table, so a batch costs
    what it changes and the newest value of all windows can be read at any time.
    """
    if mode not in ("append", "update"):
        raise ValueError("mode is 'append' or 'update'")

    def append(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={stream_of(rows)}-{batch_id:09d}")

    def update(rows: DataFrame, batch_id: int) -> None:
        table = KeyedTable(prepare(rows.sparkSession), path)
        if not table.exists():
            order = T.StructType([T.StructField("__run", T.LongType()), T.StructField("__batch", T.LongType())])
            table.create(rows.schema, ["window_start", *keys], order)
        # A new checkpoint counts from the start: its results replace those of the stream before it.
        run = table.run_number(stream_of(rows))
        order = F.struct(F.lit(run).cast("long").alias("__run"), F.lit(batch_id).cast("long").alias("__batch"))
        batch = f"{stream_of(rows)}-{batch_id:09d}"
        if len(table.state().deltas) >= compact_every:
            table.compact(keep=[batch])
        table.upsert(rows.withColumn(ORDER, order), batch)

    writer = result.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{batch_ms} milliseconds")
    return writer.foreachBatch(append if mode == "append" else update).start()


def read_appended(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{path}/batch=*")
