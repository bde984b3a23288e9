import pytest
from conftest import rows
from pyspark.sql import functions as F

from stardw.operators import merge

DDL = "id int, name string, city string"


@pytest.fixture
def target(frame):
    return frame([(1, "a", "x"), (2, "b", None), (3, "c", "z")], DDL)


@pytest.fixture
def source(frame):
    return frame([(2, "b", "y"), (3, "c", "z"), (4, "d", "w")], DDL)


def test_scd1_updates_inserts_never_deletes(target, source):
    merged = merge.scd1_merge(target, source, "id")
    assert rows(merged) == [
        (1, "a", "x", "kept"), (2, "b", "y", "updated"), (3, "c", "z", "updated"),
        (4, "d", "w", "inserted"),
    ]


def test_only_changes_compares_null_safe(target, source):
    merged = merge.scd1_merge(target, source, "id", only_changes=True)
    assert rows(merge.action_counts(merged)) == [("inserted", 1), ("kept", 2), ("updated", 1)]


def test_second_run_changes_nothing(target, source):
    once = merge.current_state(merge.scd1_merge(target, source, "id"))
    twice = merge.scd1_merge(once, source, "id", only_changes=True)
    assert rows(merge.current_state(twice)) == rows(once)
    assert rows(merge.action_counts(twice)) == [("kept", 4)]


def test_source_with_a_key_twice_is_rejected(target, frame):
    twice = frame([(2, "p", "q"), (2, "r", "s")], DDL)
    with pytest.raises(Exception, match="merge source has a key twice"):
        merge.scd1_merge(target, twice, "id").collect()


def test_update_columns_and_condition(target, source):
    merged = merge.merge_rows(
        target, source, ["id"], update_cols=["city"],
        update_when=lambda t, s: t("city").isNull(),
    )
    assert rows(merge.current_state(merged)) == [
        (1, "a", "x"), (2, "b", "y"), (3, "c", "z"), (4, "d", "w"),
    ]


def test_update_from_leaves_unmatched_rows_and_adds_none(target, source):
    merged = merge.current_state(merge.update_from(target, source, ["id"], ["city"]))
    assert rows(merged) == [(1, "a", "x"), (2, "b", "y"), (3, "c", "z")]


def test_delete_when(target, source):
    merged = merge.merge_rows(target, source, ["id"], delete_when=lambda t, s: s("city") == "z")
    assert ("deleted", 1) in rows(merge.action_counts(merged))
    assert [r[0] for r in rows(merge.current_state(merged))] == [1, 2, 4]


def test_source_with_fewer_columns(target, frame):
    merged = merge.scd1_merge(target, frame([(1, "n"), (9, "m")], "id int, name string"), "id")
    assert rows(merge.current_state(merged)) == [
        (1, "n", "x"), (2, "b", None), (3, "c", "z"), (9, "m", None),
    ]


def test_insert_only(target, source):
    merged = merge.insert_only(target, source, ["id"])
    assert rows(merged, "id", "city", "_action") == [
        (1, "x", "kept"), (2, None, "kept"), (3, "z", "kept"), (4, "w", "inserted"),
    ]


def test_update_and_delete_by_predicate(target):
    changed = merge.update_where(target, F.col("id") > 1, {"city": F.lit("new")})
    assert rows(changed, "city") == [("new",), ("new",), ("x",)]
    # A predicate that is NULL keeps the row.
    assert rows(merge.delete_where(target, F.col("city") == "x"), "id") == [(2,), (3,)]
