"""Layout of stored rows by several columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.operators.layout import clustered, files_touched
from siltstone.plans.session import fresh_dir
from workload.base import instant, iso, query, table

FILES = 64


@query(
    "layout_by_two_columns",
    """
    WITH b AS (SELECT min(epoch_us(ts)) AS low, max(epoch_us(ts)) AS high, min(user_id) AS u, max(user_id) AS v FROM events)
    SELECT event_id, user_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time, true AS fewer_files
    FROM events, b
    WHERE epoch_us(ts) BETWEEN low AND low + (high - low) // 2 AND user_id BETWEEN u AND u + (v - u) // 8""",
)
def layout_by_two_columns(spark, sf):
    """A stretch of time and of users, read from files laid out by both; by time alone more files hold some."""
    events = table(spark, sf, "events").select("event_id", "user_id", instant("ts").alias("time"))
    events = events.withColumn("at", F.unix_micros("time"))
    low, high, u, v = events.agg(F.min("at"), F.max("at"), F.min("user_id"), F.max("user_id")).first()
    wanted = {"at": (low, low + (high - low) // 2), "user_id": (u, u + (v - u) // 8)}
    stored = []
    for columns in (["at"], ["at", "user_id"]):
        folder = fresh_dir(spark, "layout")
        clustered(events, columns, FILES).write.parquet(folder)
        stored.append(spark.read.parquet(folder))
    by_time, by_both = (files_touched(df, wanted) for df in stored)
    rows = stored[1]
    for name, (least, most) in wanted.items():
        rows = rows.filter(F.col(name).between(least, most))
    return rows.select("event_id", "user_id", iso("time").alias("time"), F.lit(by_both < by_time).alias("fewer_files"))
