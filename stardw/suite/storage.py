"""Table versions, layout jobs and continuous loads (X, streams)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from stardw.functions import date_key
from stardw.operators import buckets, incremental, layout, versions
from stardw.session import work_folder
from stardw.sources import manifest
from stardw.streaming import stream_append, stream_changes

from .registry import query
from .scans import LATEST_EVENT
from .sql import with_


def published(m) -> str:
    """The customer snapshots of all loads as versions 0, 1, 2 and so on."""
    path = work_folder(m.spark, "customer-versions")
    for number, day in enumerate(m.load_dates()):
        moment = datetime(day.year, day.month, day.day, 6, 0)
        versions.publish(m.customer_snapshot(day), path, number, moment, f"load {number}")
    return path


@query("x01_load_history", with_("loads", """
SELECT CAST(row_number() OVER (ORDER BY load_date) - 1 AS INTEGER) AS version,
       load_date || ' 06:00:00.000000' AS load_ts,
       'load ' || (row_number() OVER (ORDER BY load_date) - 1) AS operation, count(*) AS "rows"
FROM loads GROUP BY load_date"""))
def load_history(m):
    return versions.history(m.spark, published(m))


@query("x02_read_version", with_("loads", """
SELECT customer_id, priority, status FROM loads WHERE load_date = :first_load"""))
def read_version(m):
    return versions.read_version(m.spark, published(m), 0)


@query("x03_read_as_of", with_("loads", """
SELECT customer_id, priority, status FROM loads WHERE load_date = DATE '1998-01-01'"""))
def read_as_of(m):
    return versions.read_as_of(m.spark, published(m), datetime(1998, 7, 1))


@query("x04_version_difference", with_("loads", """
, a AS (SELECT customer_id, priority, status FROM loads WHERE load_date = :first_load),
  b AS (SELECT customer_id, priority, status FROM loads WHERE load_date = :last_load)
SELECT *, 'removed' AS change FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
UNION ALL SELECT *, 'added' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)"""))
def version_difference(m):
    path = published(m)
    return versions.difference(
        versions.read_version(m.spark, path, 0),
        versions.read_version(m.spark, path, len(m.load_dates()) - 1),
    )


@query("x04_restore", with_("loads", """
SELECT customer_id, priority, status FROM loads WHERE load_date = :first_load"""))
def restore(m):
    path = published(m)
    newest = versions.restore(m.spark, path, 0, datetime(2000, 1, 1))
    return versions.read_version(m.spark, path, newest)


@query("x05_compaction", """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
       true AS fewer_files FROM orders""")
def compaction(m):
    """Many small files rewritten by size, without a shuffle; there are fewer of them then."""
    small, large = work_folder(m.spark, "orders-small"), work_folder(m.spark, "orders-large")
    m.orders().select("order_id", "customer_id", "status").repartition(24).write.parquet(small)
    layout.compact(m.spark, small, large)
    before, after = (layout.file_sizes(m.spark, p).agg(F.count("*")).scalar() for p in (small, large))
    return m.spark.read.parquet(large).withColumn("fewer_files", after < before)


@query("x06_clustered", with_("l", """
SELECT order_id, product_id, employee_id, line_number,
       CAST(strftime(ship_date, '%Y%m%d') AS INTEGER) AS ship_date_key FROM l"""))
def clustered(m):
    path = work_folder(m.spark, "lines-clustered")
    lines = m.lines().select(
        "order_id", "product_id", "employee_id", "line_number",
        date_key(F.col("ship_date")).alias("ship_date_key"),
    )
    layout.cluster(lines, ["ship_date_key", "product_id"], path, files=16)
    return m.spark.read.parquet(path)


@query("x06_clustered_by_rank", with_("l", """
SELECT order_id, product_id, employee_id, line_number,
       CAST(strftime(ship_date, '%Y%m%d') AS INTEGER) AS ship_date_key, true AS few_files FROM l"""))
def clustered_by_rank(m):
    """With one line of a far day among them; a month must not touch more than half of the files."""
    path, given = work_folder(m.spark, "lines-by-rank"), work_folder(m.spark, "lines-given")
    lines = m.lines().select(
        "order_id", "product_id", "employee_id", "line_number",
        date_key(F.col("ship_date")).alias("ship_date_key"),
    )
    far = lines.limit(1).withColumns({"ship_date_key": F.lit(99991231), "order_id": F.lit(-1).cast("bigint")})
    lines.unionByName(far).write.parquet(given)
    files = max(64, layout.files_for(m.spark, given, 128 << 20))
    layout.cluster_by_rank(m.spark.read.parquet(given), ["ship_date_key", "product_id"], path, files)
    stored = m.spark.read.parquet(path)
    touched = stored.groupBy(F.col("_metadata.file_path").alias("f")).agg(
        ((F.min("ship_date_key") <= 19980131) & (F.max("ship_date_key") >= 19980101)).alias("hit"))
    few = touched.agg(F.count_if("hit") * 2 <= F.count("*")).scalar()
    return stored.filter("order_id >= 0").withColumn("few_files", few)


def event_stream(m):
    schema = m.given("events").schema
    source = m.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    return source.parquet(m.folder).select("event_id", "ts", "user_id", "event_type", "value")


@query("a19_stream_append", """
SELECT event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM events GROUP BY event_type""")
def streamed_append(m):
    path, state = work_folder(m.spark, "events"), work_folder(m.spark, "events-state")
    stream_append(event_stream(m), path, state).awaitTermination()
    stored = m.spark.read.parquet(path)
    return stored.groupBy("event_type").agg(
        F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).alias("total")
    )


@query("a20_stream_changes", f"SELECT * FROM ({LATEST_EVENT}) WHERE event_type <> 'error'")
def streamed_changes(m):
    path, state = work_folder(m.spark, "users"), work_folder(m.spark, "users-state")
    stream_changes(
        event_stream(m), path, state, ["user_id"], ["ts", "event_id"],
        F.col("event_type") == "error",
    ).awaitTermination()
    users = incremental.live(buckets.state(m.spark, path, m.events().schema))
    return users.select("user_id", "event_id", "event_type", "value", "ts")


@query("a20_bucketed_changes", f"""
SELECT u.*, CAST(b.buckets AS BOOLEAN) AS touched_only
FROM (SELECT * FROM ({LATEST_EVENT}) WHERE event_type <> 'error') u, (SELECT true AS buckets) b""")
def bucketed_changes(m):
    """A feed in two batches, the second one of few users: it may rewrite no more buckets than it has users."""
    events, path = m.events(), work_folder(m.spark, "users-buckets")
    keys, order, deleted = ["user_id"], ["ts", "event_id"], F.col("event_type") == "error"
    late = F.pmod(F.xxhash64("user_id"), F.lit(64)) == 0
    newest = events.agg(F.max("ts")).scalar()
    second = late & (F.col("ts") > newest - F.expr("interval 5 days"))
    buckets.apply_batch(path, events.filter(~second), keys, order, deleted, "first", 64)
    before = manifest.newest(m.spark, path)
    buckets.apply_batch(path, events.filter(second), keys, order, deleted, "second")
    after = manifest.newest(m.spark, path)
    rewritten = [p for p in after.pieces if after.pieces[p][0] != before.pieces.get(p, ("",))[0]]
    users = incremental.live(buckets.state(m.spark, path, events.schema))
    return users.select("user_id", "event_id", "event_type", "value", "ts").withColumn(
        "touched_only", F.lit(rewritten in ([], ["0"])))
