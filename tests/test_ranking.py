import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from stardw.functions import grown_keys
from stardw.operators import layout, quality, ranking


def values(n=500):
    rng = random.Random(5)
    # A third of the rows have one value, some none.
    return [(i, None if i % 50 == 7 else 3.0 if i % 3 == 0 else float(rng.randrange(40))) for i in range(n)]


@pytest.mark.parametrize("parts", [1, 7, 60])
def test_positions_and_groups_equal_a_window(frame, parts):
    data = values()
    df = frame(data, "id int, v double")
    ordered = sorted(data, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))
    found = ranking.numbered(df, ["v", "id"], "at", parts)
    assert rows(found, "at", "id") == sorted(((i, r[0]) for i, r in enumerate(ordered, 1)), key=repr)
    for tiles in (1, 4, 7, 499, 501):
        size, more = divmod(len(data), tiles)
        groups = [g for g in range(1, tiles + 1) for _ in range(size + (g <= more))]
        tiled = ranking.tiled(df, tiles, ["v", "id"], "g", parts)
        assert rows(tiled, "g", "id") == sorted(zip(groups, (r[0] for r in ordered)), key=repr), tiles


def test_ranks_equal_a_window(frame):
    data = values()
    df = frame(data, "id int, v double")
    for by, up in (("v", True), ("-v", False)):
        found = ranking.ranked_all(df, by, "place", 9)
        keyed = {i: (v is not None, v or 0) for i, v in data}
        places = {i: 1 + sum((k < keyed[i]) if up else (k > keyed[i]) for k in keyed.values()) for i in keyed}
        assert rows(found, "id", "place") == sorted(places.items(), key=repr)


def test_no_window_gathers_the_frame(frame):
    found = ranking.tiled(frame(values(50), "id int, v double"), 4, ["v", "id"], "g", 5)
    plan = found._jdf.queryExecution().executedPlan().toString()
    # The one window without a partition adds up one row per range.
    single = [x for x in plan.split("\n") if "Window [" in x and "row_number()" not in x]
    assert "ntile" not in plan and all("_n" in x for x in single)


def test_empty_frames(frame):
    none = frame([], "id int, v double")
    assert ranking.tiled(none, 4, ["v"], "g").count() == 0
    assert ranking.ranked_all(none, "v", "place").count() == 0


def test_keys_of_old_members_never_change(frame):
    loads = [["b", "a", None], ["a", "b", "c", "c"], ["b", "a", "c"]]
    known, before = None, {}
    for members in loads:
        known = grown_keys(known, frame([(m,) for m in members], "id string"), "id", "no")
        now = {r.id: r.no for r in known.collect()}
        assert all(now[m] == no for m, no in before.items())
        assert sorted(now.values()) == list(range(1, len(now) + 1))
        before = now
    assert set(before) == {"a", "b", "c"} and before["c"] == 3


def read_by_a_range(spark, df, path, write):
    write(df, ["a", "b"], path, 16)
    files = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("f")).agg(F.min("a").alias("lo"), F.max("a").alias("hi"))
    return files.filter("lo <= 620 and hi >= 600").count()


def test_an_outlier_does_not_change_what_a_range_reads(spark, tmp_path):
    df = spark.range(20000).select((F.pmod(F.xxhash64("id"), F.lit(1000))).alias("a"), (F.pmod(F.xxhash64(F.col("id") + 1), F.lit(1000))).alias("b"))
    far = df.unionByName(spark.createDataFrame([(10**12, 10**12)], df.schema))
    plain = read_by_a_range(spark, df, str(tmp_path / "p"), layout.cluster_by_rank)
    shifted = read_by_a_range(spark, far, str(tmp_path / "f"), layout.cluster_by_rank)
    assert abs(plain - shifted) <= 3  # ranges are cut by a sample
    # Cells of equal width collapse under the outlier.
    assert shifted < read_by_a_range(spark, far, str(tmp_path / "w"), layout.cluster)
    assert spark.read.parquet(str(tmp_path / "f")).count() == 20001


def test_nulls_and_one_value_are_clustered(spark, frame, tmp_path):
    df = frame([(None, 1), (2, 1), (3, 1)], "a int, b int")
    layout.cluster_by_rank(df, ["a", "b"], str(tmp_path / "n"), 2)
    assert rows(spark.read.parquet(str(tmp_path / "n"))) == rows(df)
    assert layout.files_for(spark, str(tmp_path / "n"), 1 << 30) == 1


def test_content_names_the_partition_that_differs(frame):
    ddl = "day int, a int, b string"
    data = [(d, i, None if i % 4 == 0 else f"x{i}") for d in (1, 2, None) for i in range(30)]
    left = frame(data, ddl)
    same = quality.reconcile_content(left, frame(data[::-1], ddl), ["a", "b"], "day")
    assert {r.ok for r in same.collect()} == {True}
    spoiled = [(d, i, "y" if (d, i) == (2, 8) else b) for d, i, b in data]
    found = quality.reconcile_content(left, frame(spoiled, ddl), ["a", "b"], "day")
    assert rows(found) == sorted([(1, 30, 30, True), (2, 30, 30, False), (None, 30, 30, True)], key=repr)
    # A value that moves from one column to another, and a partition of one layer alone.
    swap = quality.reconcile_content(
        frame([(1, 5, None), (3, 1, "q")], ddl), frame([(1, None, "5")], ddl), ["a", "b"], "day")
    assert rows(swap, "day", "source_rows", "target_rows", "ok") == [(1, 1, 1, False), (3, 1, 0, False)]
    with pytest.raises(TypeError):
        quality.reconcile_content(left, left.withColumn("a", F.col("a").cast("long")), ["a"], "day")
