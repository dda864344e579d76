"""Stateful and upserting streams over the events."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.base import Catalogue, table
from oreflow.session import state_session, work_dir
from oreflow.streaming import (
    apply_changes, dedup_with_late, dedup_within_watermark, read_current, read_kept, read_late, read_progress, run_available_now,
)

CATALOGUE = Catalogue()
register = CATALOGUE.register


@register("stream_dedup_watermark", "SELECT event_id, ts, user_id, event_type, value FROM events")
def stream_dedup_watermark(spark, sf_dir):
    """The events arrive twice, as two republished file sets; each event is kept once."""
    root = work_dir(spark, "stream-dedup")
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    for _ in range(2):
        events.write.mode("append").parquet(f"{root}/in")
    stream = state_session(spark).readStream.schema(events.schema).parquet(f"{root}/in")
    # the delay spans the whole history, so nothing is late
    origin = F.concat_ws("@", F.col("_metadata.file_path"), F.col("_metadata.file_block_start"))
    once = dedup_within_watermark(stream, ["event_id"], "ts", "60 days", spread=origin)
    run_available_now(once, f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out")


@register(
    "stream_cdc_upsert",
    """SELECT user_id, event_id, ts, event_type, value FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
       WHERE rn = 1""",
)
def stream_cdc_upsert(spark, sf_dir):
    """The newest event per user, upserted over several micro-batches."""
    root = work_dir(spark, "stream-cdc")
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    for day in ("ts < '2024-01-10'", "ts >= '2024-01-20'", "ts >= '2024-01-10' AND ts < '2024-01-20'"):
        events.filter(day).write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 4).parquet(f"{root}/in")
    apply_changes(stream, f"{root}/users", f"{root}/checkpoint", ["user_id"], "ts", compact_every=2)
    return read_current(spark, f"{root}/users", ["user_id"], "ts")


@register(
    "stream_cdc_deletes",
    """SELECT user_id, event_id, ts, value FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, (event_type = 'signup') DESC, event_id DESC) AS rn FROM events)
       WHERE rn = 1 AND event_type <> 'signup'""",
)
def stream_cdc_deletes(spark, sf_dir):
    """A signup deletes its user. Late days come after newer ones were compacted, and revive nobody."""
    root = work_dir(spark, "stream-deletes")
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    for day in ("ts >= '2024-01-20'", "ts < '2024-01-10'", "ts >= '2024-01-10' AND ts < '2024-01-20'"):
        events.filter(day).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{root}/in")
        apply_changes(
            stream, f"{root}/users", f"{root}/checkpoint", ["user_id"], "ts", compact_every=1, deleted="event_type = 'signup'"
        )
    return read_current(spark, f"{root}/users", ["user_id"], "ts").select("user_id", "event_id", "ts", "value")


FIRST, AGAIN, LAST = "ts < '2024-01-12'", "ts >= '2024-01-05' AND ts < '2024-01-15'", "ts >= '2024-01-13'"
LATE = f"{AGAIN} AND ts < (SELECT max(ts) FROM events WHERE {FIRST}) - INTERVAL 3 DAY"


def _late_run(spark, sf_dir):
    """Three runs of one stream: days, then days again of which the oldest are late, then the rest."""
    root = work_dir(spark, "stream-late")
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    for days in (FIRST, AGAIN, LAST):
        events.filter(days).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{root}/in")
        dedup_with_late(stream, f"{root}/out", f"{root}/checkpoint", ["event_id"], "ts", "3 days")
    return f"{root}/out"


@register(
    "stream_late_rows",
    f"""SELECT 'kept' AS status, event_id, ts, user_id, value FROM events WHERE ({FIRST}) OR ({AGAIN}) OR ({LAST})
        UNION ALL SELECT 'late', event_id, ts, user_id, value FROM events WHERE {LATE}""",
)
def stream_late_rows(spark, sf_dir):
    target = _late_run(spark, sf_dir)
    kept, late = read_kept(spark, target), read_late(spark, target)
    return kept.select(F.lit("kept").alias("status"), "*").unionByName(late.select(F.lit("late").alias("status"), "*"))


@register(
    "stream_late_counts",
    f"""SELECT CAST(0 AS BIGINT) AS batch, count(*) AS rows, CAST(0 AS BIGINT) AS late, count(*) AS kept FROM events WHERE {FIRST}
        UNION ALL SELECT 1, count(*), count(*) FILTER ({LATE}), count(*) FILTER (NOT ({FIRST})) FROM events WHERE {AGAIN}
        UNION ALL SELECT 2, count(*), 0, count(*) FILTER (NOT ({AGAIN})) FROM events WHERE {LAST}""",
)
def stream_late_counts(spark, sf_dir):
    return read_progress(spark, _late_run(spark, sf_dir)).select("batch", "rows", "late", "kept")
