import random
from datetime import datetime

import pytest
from conftest import rows, same_rows
from pyspark.sql import functions as F

from stardw.operators import buckets, incremental, layout, versions
from stardw.operators.merge import current_state
from stardw.plans import load
from stardw.sources import manifest
from stardw.streaming import stream_append, stream_changes

T = [datetime(2024, 1, d) for d in (1, 2, 3)]


def test_versions_round_trip(frame, spark, tmp_path):
    path, ddl = str(tmp_path / "t"), "id int, v string"
    one, two = frame([(1, "a"), (2, "b"), (2, "b")], ddl), frame([(1, "a"), (2, "b"), (3, "c")], ddl)
    versions.publish(one, path, 0, T[0], "load")
    versions.publish(two, path, 1, T[2], "load")
    assert rows(versions.history(spark, path), "version", "rows") == [(0, 3), (1, 3)]
    assert versions.latest_version(spark, path) == 1
    assert same_rows(versions.read_as_of(spark, path, T[1]), one)
    with pytest.raises(LookupError):
        versions.latest_version(spark, path, datetime(2000, 1, 1))
    change = versions.difference(
        versions.read_version(spark, path, 0), versions.read_version(spark, path, 1)
    )
    assert rows(change) == [(2, "b", "removed"), (3, "c", "added")]
    assert versions.restore(spark, path, 0, T[2]) == 2
    assert same_rows(versions.read_version(spark, path, 2), one)


def test_unlogged_folder_is_no_version(frame, spark, tmp_path):
    path = str(tmp_path / "t")
    versions.publish(frame([(1,)], "id int"), path, 0, T[0], "load")
    frame([(2,)], "id int").write.parquet(f"{path}/data/version=1")  # a write that failed
    assert versions.latest_version(spark, path) == 0
    versions.publish(frame([(3,)], "id int"), path, 1, T[1], "load")
    assert rows(versions.read_version(spark, path, 1)) == [(3,)]


def test_compaction_keeps_rows(spark, tmp_path):
    small, large = str(tmp_path / "s"), str(tmp_path / "l")
    spark.range(1000).repartition(20).write.parquet(small)
    # What compaction returns is the layout before and after.
    report = layout.compact(spark, small, large).first()
    assert (report.files_before, report.files_after) == (20, 1)
    assert report.bytes_before > report.bytes_after == layout.file_sizes(spark, large).agg(F.sum("length")).first()[0]
    assert same_rows(spark.read.parquet(large), spark.range(1000).toDF("id"))
    third = layout.compact(spark, small, str(tmp_path / "m"), target_bytes=report.bytes_before // 3).first()
    assert third.files_after in (3, 4)


def test_compaction_of_a_partitioned_table(spark, tmp_path):
    small, large = str(tmp_path / "s"), str(tmp_path / "l")
    df = spark.range(300).select("id", (F.col("id") % 3).alias("day"), F.lit("a b").alias("city"))
    df.repartition(6).write.partitionBy("day").parquet(small)
    report = layout.compact(spark, small, large, partition_by=["day"]).first()
    assert (report.files_before, report.files_after) == (18, 3)
    assert same_rows(spark.read.parquet(large).select(df.columns), df.withColumn("day", F.col("day").cast("int")))
    with pytest.raises(ValueError):
        layout.compact(spark, small, str(tmp_path / "x"))


def test_clustering_narrows_both_columns(spark, tmp_path):
    df = spark.range(20000).select(
        (F.xxhash64("id") % 1000).alias("a"), (F.xxhash64(F.col("id") + 1) % 1000).alias("b"),
        F.lit(1).alias("c"),
    )
    path = str(tmp_path / "z")
    layout.cluster(df, ["a", "b"], path, files=16)
    back = spark.read.parquet(path)
    assert same_rows(back, df)
    wide = back.groupBy(F.input_file_name().alias("f")).agg(
        (F.max("a") - F.min("a")).alias("wa"), (F.max("b") - F.min("b")).alias("wb")
    )
    mean_a, mean_b = wide.agg(F.avg("wa"), F.avg("wb")).first()
    assert mean_a < 1400 and mean_b < 1400  # the full range is 2000 in every unclustered file


def test_z_value_interleaves(frame):
    df = frame([(0, 0), (3, 0), (0, 3), (3, 3), (1, 2)], "a int, b int")
    assert [r["z"] for r in layout.with_z(df, ["a", "b"], bits=2).collect()] == [0, 5, 10, 15, 9]


def test_one_frequent_value_is_cut_into_files(spark, tmp_path):
    df = spark.range(9000).select(F.lit(1).alias("a"), F.col("id").alias("b"))
    path = str(tmp_path / "z")
    layout.cluster(df.withColumn("k", F.lit(7)), ["a", "k"], path, files=6)
    assert layout.file_sizes(spark, path).count() >= 5


EVENT = "id int, n int, kind string, v int"


def random_events(count=400):
    rng = random.Random(3)
    # A third of the events belong to one key.
    return [
        (0 if rng.random() < 1 / 3 else rng.randrange(1, 40), n,
         rng.choice(["set", "set", "delete"]), rng.randrange(100))
        for n in range(count)
    ]


def replay(events):
    state = {}
    for key, n, kind, v in sorted(events, key=lambda e: e[1]):
        if kind == "delete":
            state.pop(key, None)
        else:
            state[key] = (key, n, kind, v)
    return sorted(state.values(), key=repr)


def test_change_feed_equals_replay_in_any_batching(frame, spark):
    events = random_events()
    deleted = F.col("kind") == "delete"
    for cuts in ([400], [100, 250, 400]):
        state = spark.createDataFrame([], EVENT + ", is_deleted boolean")
        start = 0
        for cut in cuts:
            batch = frame(events[start:cut], EVENT)
            state = current_state(
                incremental.apply_changes(state, batch, ["id"], ["n"], deleted)
            )
            start = cut
        assert rows(incremental.live(state)) == replay(events)


def test_late_and_repeated_batches_do_no_harm(frame, spark):
    events = random_events()
    deleted = F.col("kind") == "delete"
    state = spark.createDataFrame([], EVENT + ", is_deleted boolean")
    for part in (events[200:], events[:200], events[200:]):
        state = current_state(
            incremental.apply_changes(state, frame(part, EVENT), ["id"], ["n"], deleted)
        )
    assert rows(incremental.live(state)) == replay(events)


def test_high_water_mark(frame):
    source = frame([(1, 5), (2, 6), (3, 7)], "id int, n int")
    # Rows that carry the mark itself come again: others with its stamp may have arrived since.
    assert rows(incremental.new_rows(source, source.filter("n < 7"), "n")) == [(2, 6), (3, 7)]
    tied = frame([(1, 5), (2, 6), (4, 6)], "id int, n int")
    again = incremental.upsert_latest(
        source.filter("n < 7"), incremental.new_rows(tied, source.filter("n < 7"), "n"), ["id"], ["n"])
    assert rows(current_state(again)) == [(1, 5), (2, 6), (4, 6)]
    assert incremental.new_rows(source, source.filter("false"), "n").count() == 3


def test_streams_equal_the_batch_form(spark, frame, tmp_path):
    events = random_events(300)
    inbox = str(tmp_path / "in")
    (tmp_path / "in").mkdir()
    schema = frame([], EVENT).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(inbox)
    for start in (0, 100, 200):
        frame(events[start:start + 100], EVENT).coalesce(1).write.mode("append").parquet(inbox)
        stream_append(stream, str(tmp_path / "all"), str(tmp_path / "c1")).awaitTermination()
        stream_changes(
            stream, str(tmp_path / "state"), str(tmp_path / "c2"), ["id"], ["n"],
            F.col("kind") == "delete",
        ).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "all")), "id", "n", "kind", "v") == sorted(
        events, key=repr)
    # Three batches, three manifests, numbered from 0.
    assert manifest.newest(spark, str(tmp_path / "state")).number == 2
    assert rows(incremental.live(buckets.state(spark, str(tmp_path / "state"), schema))) == replay(events)


def size_of(folder):
    return sum(f.stat().st_size for f in folder.rglob("*.parquet")) if folder.exists() else 0


def test_a_batch_rewrites_the_buckets_it_touches(spark, frame, tmp_path):
    path, deleted = str(tmp_path / "t"), F.col("kind") == "delete"
    many = [(k, k, "set", k) for k in range(5000)]
    assert buckets.apply_batch(path, frame(many, EVENT), ["id"], ["n"], deleted, "a", 32)
    first = size_of(tmp_path / "t" / "data" / "load=0")
    assert buckets.apply_batch(path, frame([(7, 9000, "set", 1), (7, 9001, "delete", 2)], EVENT), ["id"], ["n"], deleted, "b")
    # One key lies in one of 32 buckets.
    assert len(list((tmp_path / "t" / "data" / "load=1").glob("_bucket=*"))) == 1
    assert 0 < size_of(tmp_path / "t" / "data" / "load=1") < first / 16
    found = incremental.live(buckets.state(spark, path, frame([], EVENT).schema))
    assert rows(found) == replay([*many, (7, 9001, "delete", 2)])
    assert sum(n for _, n in manifest.newest(spark, path).pieces.values()) == 5000


def test_a_repeated_batch_is_passed_over_and_a_broken_one_applied_again(spark, frame, tmp_path, monkeypatch):
    path, deleted = str(tmp_path / "t"), F.col("kind") == "delete"
    events = random_events()
    schema = frame([], EVENT).schema
    buckets.apply_batch(path, frame(events[:200], EVENT), ["id"], ["n"], deleted, "a", 8)

    def broken(*_):
        raise OSError("lost")

    whole = buckets.switch
    monkeypatch.setattr(buckets, "switch", broken)
    with pytest.raises(OSError):
        buckets.apply_batch(path, frame(events[200:], EVENT), ["id"], ["n"], deleted, "b")
    # Written but not switched to: readers see the first batch.
    assert rows(incremental.live(buckets.state(spark, path, schema))) == replay(events[:200])
    monkeypatch.setattr(buckets, "switch", whole)
    assert buckets.apply_batch(path, frame(events[200:], EVENT), ["id"], ["n"], deleted, "b")
    assert not buckets.apply_batch(path, frame(events[:5], EVENT), ["id"], ["n"], deleted, "b")
    assert rows(incremental.live(buckets.state(spark, path, schema))) == replay(events)


def test_folders_of_expired_manifests_are_removed(spark, frame, tmp_path):
    path, never = str(tmp_path / "a b"), F.lit(False)
    for n in range(5):
        buckets.apply_batch(path, frame([(k, n, "set", n) for k in range(20)], EVENT), ["id"], ["n"], never, f"l{n}", 2)
    assert [m.number for m in manifest.manifests(spark, path)] == [3, 4]
    left = {f.parent.parent.name for f in (tmp_path / "a b" / "data").rglob("*.parquet")}
    assert left == {"load=3", "load=4"}
    buckets.apply_batch(path, frame([], EVENT), ["id"], ["n"], never, "none")
    assert buckets.state(spark, path, frame([], EVENT).schema).count() == 20


ONE = "n int"


def graph(frame, value, log, fail=()):
    """Three tables that build on each other; `log` notes which steps are built."""
    schema = frame([], ONE).schema

    def step(name, needs):
        def build(stored):
            log.append(name)
            df = frame([(value,)], ONE)
            for need in needs:
                df = df.unionByName(stored(need))
            return df.select(F.raise_error(F.lit("broken")).cast("int").alias("n")) if name in fail else df
        return load.Step(name, schema, build, needs)

    # Given out of order on purpose.
    return [step("c", ("a", "b")), step("b", ("a",)), step("a", ())]


def seen(spark, folder, frame):
    return {t: rows(load.table(spark, folder, t, frame([], ONE).schema)) for t in "abc"}


def test_a_load_killed_midway_continues_and_readers_see_the_load_before(frame, spark, tmp_path):
    folder, log = str(tmp_path / "w"), []
    assert load.run_steps(spark, folder, graph(frame, 1, log), T[0]) == ["a", "b", "c"]
    old = {"a": [(1,)], "b": [(1,), (1,)], "c": [(1,), (1,), (1,), (1,)]}
    assert seen(spark, folder, frame) == old
    log.clear()
    with pytest.raises(Exception, match="broken"):
        load.run_steps(spark, folder, graph(frame, 2, log, fail={"b"}), T[1])
    assert log == ["a", "b"]
    assert seen(spark, folder, frame) == old

    def last():
        return load.run_log(spark, folder).filter(F.col("load") == "20240102T000000")

    assert rows(last(), "step", "status", "rows") == [("a", "ok", 1), ("b", "error", None)]
    assert "broken" in last().filter("status = 'error'").first().message
    log.clear()
    assert load.run_steps(spark, folder, graph(frame, 2, log), T[1]) == ["b", "c"]
    assert log == ["b", "c"]  # what was done is not built again
    assert seen(spark, folder, frame) == {"a": [(2,)], "b": [(2,), (2,)], "c": [(2,)] * 4}
    assert rows(last(), "step", "status", "rows") == [("a", "ok", 1), ("b", "ok", 2), ("c", "ok", 4)]
    assert load.run_steps(spark, folder, graph(frame, 9, log), T[1]) == []  # a complete load stays


def test_steps_come_after_what_they_need(frame):
    schema = frame([], ONE).schema
    with pytest.raises(LookupError):
        load.in_order([load.Step("a", schema, lambda _: None, ("x",))])
    with pytest.raises(ValueError):  # a circle
        load.in_order([load.Step("a", schema, lambda _: None, ("b",)), load.Step("b", schema, lambda _: None, ("a",))])


def test_a_step_reads_only_what_it_needs(frame, spark, tmp_path):
    schema = frame([], ONE).schema
    sly = load.Step("b", schema, lambda stored: stored("a"))
    with pytest.raises(LookupError):
        load.run_steps(spark, str(tmp_path / "w"), [load.Step("a", schema, lambda _: frame([(1,)], ONE)), sly], T[0])


def test_loads_before_the_last_two_are_removed(frame, spark, tmp_path):
    folder = str(tmp_path / "w")
    for n, when in enumerate(T):
        load.run_steps(spark, folder, graph(frame, n, []), when)
    assert sorted(p.name for p in (tmp_path / "w" / "data").iterdir() if any(p.rglob("*.parquet"))) == [
        "load=20240102T000000", "load=20240103T000000"]


def test_tables_of_a_load_are_written_by_the_closer_codec(spark, tmp_path):
    from datetime import datetime

    from stardw.plans import load

    step = load.Step("t", spark.range(1).schema, lambda _: spark.range(10))
    load.run_steps(spark, str(tmp_path), [step], datetime(2024, 1, 1))
    assert list(tmp_path.glob("data/*/t/*.zstd.parquet"))
    found = load.table(spark, str(tmp_path), "t", step.schema)
    assert sorted(r.id for r in found.collect()) == list(range(10))
