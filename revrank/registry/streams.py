"""Streaming queries; each must equal the batch result over the same rows."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from revrank.registry.base import query, text
from revrank.registry.sequences import NEWEST, grams
from revrank.session import ensure_checkpoint_dir
from revrank.sources import tables
from revrank.streaming import incremental


def _folders(spark):
    ensure_checkpoint_dir(spark)
    base = f"{spark.sparkContext.getCheckpointDir()}/stream-{uuid.uuid4().hex}"
    return f"{base}/out", f"{base}/state"


def _log_stream(spark, d):
    return tables.events_as_log(incremental.event_stream(spark, d))


def _sliced_stream(spark, d, slices: int = 3):
    """The events in several files, one slice each; a user's rows lie in all of them, in no order of time."""
    folder = f"{_folders(spark)[0]}-slices"
    events = spark.read.parquet(f"{d}/events.parquet")
    part = F.pmod(F.xxhash64("event_id"), F.lit(slices)).cast("int").alias("slice")
    # One range of slice numbers a task, so one file a slice.
    events.repartitionByRange(slices, part).write.parquet(folder)
    return tables.events_as_log(incremental.event_stream(spark, folder, "*.parquet"))


@query(
    "stream_user_history",
    f", r AS (SELECT user_idx, item_idx, event_id, relevance, {NEWEST} AS n FROM elog) SELECT user_idx, item_idx, event_id, relevance FROM r WHERE n <= 50",
)
def _(spark, d):
    out, state = _folders(spark)
    kept = incremental.stream_user_history(_sliced_stream(spark, d), 50, tables.EVENT_ORDER, out, state)
    return kept.select("user_idx", "item_idx", "event_id", "relevance")


@query("stream_ngram_counts", grams("elog") + " SELECT ctx, item_idx, c FROM counts")
def _(spark, d):
    out, state = _folders(spark)
    counts = incremental.stream_ngram_counts(_sliced_stream(spark, d), 2, tables.EVENT_ORDER, out, state)
    return counts.select(text("ctx").alias("ctx"), "item_idx", "c")


@query("stream_item_popularity", "SELECT item_idx, sum(relevance) AS score FROM elog GROUP BY 1")
def _(spark, d):
    out, state = _folders(spark)
    return incremental.stream_item_popularity(_sliced_stream(spark, d), out, state)


@query(
    "stream_windowed_popularity",
    """SELECT CAST(date_diff('day', TIMESTAMP '2024-01-01', "timestamp") AS INTEGER) AS "day", item_idx, sum(relevance) AS score, count(*) AS n FROM elog GROUP BY ALL""",
)
def _(spark, d):
    out, state = _folders(spark)
    daily = incremental.stream_windowed_popularity(_log_stream(spark, d), out, state)
    day = F.floor(F.unix_seconds("start") / 86400) - F.unix_date(F.lit("2024-01-01").cast("date"))
    return daily.select(day.cast("int").alias("day"), "item_idx", "score", "n")
