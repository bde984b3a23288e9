import random
from datetime import date, timedelta

import pytest
from conftest import D, rows, same_rows
from pyspark.sql import functions as F

from stardw.functions import FIRST_DAY, LAST_DAY
from stardw.operators import quality, scd

DDL = "id string, company string, contact string, city string"
V1 = [("A", "Alfa", "Maria", "Berlin"), ("B", "Beta", "Ana", None), ("C", "Ceta", "Tom", None)]
V2 = [("A", "Alfa", "Marta", "Berlin"), ("B", "Beta", "Ana", ""), ("C", "Ceta2", "Tom", None)]
TRACKED = ["contact", "city"]
L1, L2, L3 = D("2020-01-01"), D("2021-01-01"), D("2022-01-01")


@pytest.fixture
def initial(frame):
    return scd.scd2_initial(frame(V1, DDL), "id", "sk")


def apply(dim, snapshot, load_date, **options):
    return scd.scd2_apply(dim, snapshot, "id", TRACKED, load_date, "sk", **options)


def test_initial_load_is_open(initial):
    assert rows(initial, "id", "valid_from", "valid_to", "is_current") == [
        (k, FIRST_DAY, LAST_DAY, True) for k in "ABC"
    ]


def test_change_expires_and_opens(initial, frame):
    after = apply(initial, frame(V2, DDL), L2)
    assert rows(after, "id", "contact", "city", "valid_from", "valid_to", "is_current",
                "_action") == sorted([
        ("A", "Maria", "Berlin", FIRST_DAY, date(2020, 12, 31), False, "expired"),
        ("A", "Marta", "Berlin", L2, LAST_DAY, True, "inserted"),
        # NULL to empty text is a change.
        ("B", "Ana", None, FIRST_DAY, date(2020, 12, 31), False, "expired"),
        ("B", "Ana", "", L2, LAST_DAY, True, "inserted"),
        ("C", "Tom", None, FIRST_DAY, LAST_DAY, True, "kept"),
    ], key=repr)


def test_untracked_column_of_unchanged_member_stays(initial, frame):
    after = apply(initial, frame(V2, DDL), L2).filter("id = 'C'")
    assert rows(after, "company") == [("Ceta",)]


def test_version_keys_are_unique(initial, frame):
    after = apply(initial, frame(V2, DDL), L2)
    assert quality.duplicates(after, ["sk"]).isEmpty()


def test_second_run_of_a_load_changes_nothing(initial, frame):
    once = apply(initial, frame(V2, DDL), L2).drop("_action")
    twice = apply(once, frame(V2, DDL), L2)
    assert same_rows(once, twice.drop("_action"))
    assert rows(twice.select("_action").distinct()) == [("kept",)]


def test_second_change_on_one_day_overwrites_in_place(initial, frame):
    once = apply(initial, frame(V2, DDL), L2).drop("_action")
    v3 = [("A", "Alfa", "Mia", "Bonn"), *V2[1:]]
    twice = apply(once, frame(v3, DDL), L2).filter("id = 'A'")
    assert rows(twice, "contact", "valid_from", "valid_to", "_action") == [
        ("Maria", FIRST_DAY, date(2020, 12, 31), "kept"), ("Mia", L2, LAST_DAY, "updated"),
    ]


def test_load_older_than_a_version_is_rejected(initial, frame):
    once = apply(initial, frame(V2, DDL), L2).drop("_action")
    with pytest.raises(Exception, match="later than load date"):
        apply(once, frame(V1, DDL), L1).collect()


def test_snapshot_with_a_key_twice_is_rejected(initial, frame):
    with pytest.raises(Exception, match="key twice"):
        apply(initial, frame([V1[0], V1[0]], DDL), L2).collect()


def test_new_member_starts_on_load_date_or_as_told(initial, frame):
    new = frame([*V1, ("N", "New", "x", "y")], DDL)
    assert rows(apply(initial, new, L2).filter("id = 'N'"), "valid_from", "_action") == [
        (L2, "inserted")
    ]
    early = apply(initial, new, L2, new_member_from=FIRST_DAY)
    assert rows(early.filter("id = 'N'"), "valid_from") == [(FIRST_DAY,)]


def test_missing_member_stays_open_unless_closed(initial, frame):
    only_a = frame(V1[:1], DDL)
    kept = apply(initial, only_a, L2)
    assert rows(kept.filter("is_current"), "id") == [("A",), ("B",), ("C",)]
    closed = apply(initial, only_a, L2, close_missing=True)
    assert rows(closed.filter("is_current"), "id") == [("A",)]


def test_closed_member_that_returns_is_opened_once(initial, frame):
    closed = apply(initial, frame(V2[:1], DDL), L2, close_missing=True).drop("_action")
    back = apply(closed, frame(V1, DDL), L3, close_missing=True)
    b = rows(back.filter("id = 'B'"), "valid_from", "valid_to", "is_current")
    assert b == sorted(
        [(FIRST_DAY, date(2020, 12, 31), False), (L3, LAST_DAY, True)], key=repr
    )
    assert quality.duplicates(back.filter("is_current"), ["id"]).isEmpty()


def test_history_equals_loads_in_turn(frame, initial):
    v3 = [("A", "Alfa", "Maria", "Berlin"), V2[1], V2[2]]
    loaded = initial
    for day, snapshot in ((L2, V2), (L3, v3)):
        loaded = apply(loaded, frame(snapshot, DDL), day).drop("_action")
    events = [
        (*row, day) for day, snap in ((L1, V1), (L2, V2), (L3, v3)) for row in snap
    ]
    history = scd.scd2_history(
        frame(events, DDL + ", day date"), "id", TRACKED, "day", ["day"], "sk"
    )
    assert same_rows(loaded.select(*history.columns), history)


def test_history_takes_the_last_event_of_a_day(frame):
    events = frame(
        [("A", 1, L1, "x"), ("A", 2, L1, "y"), ("A", 3, L2, "y"), ("A", 4, L3, "z")],
        "id string, n int, day date, v string",
    )
    out = scd.scd2_history(events, "id", ["v"], "day", ["n"], "sk")
    assert rows(out, "v", "valid_from", "valid_to", "is_current") == [
        ("y", FIRST_DAY, date(2021, 12, 31), False), ("z", L3, LAST_DAY, True),
    ]


def test_scd3_rotates_each_attribute_on_its_own(frame):
    ddl = "id string, city string, country string"
    dim = scd.scd3_initial(
        frame([("A", "Berlin", "DE"), ("B", "Paris", "FR"), ("C", "Rom", "IT")], ddl), "id",
        ["city", "country"],
    )
    moved = frame(
        [("A", "Bonn", "DE"), ("B", "Paris", "FR"), ("C", None, "IT"), ("D", "Oslo", "NO")], ddl
    )
    one = scd.scd3_apply(dim, moved, "id", ["city", "country"], L2)
    assert rows(one, "id", "current_city", "previous_city", "city_changed_on",
                "previous_country", "_action") == sorted([
        ("A", "Bonn", "Berlin", L2, None, "updated"), ("B", "Paris", None, None, None, "kept"),
        ("C", None, "Rom", L2, None, "updated"), ("D", "Oslo", None, None, None, "inserted"),
    ], key=repr)
    # A second move overwrites the previous value: there is one step of history.
    again = frame([("A", "Köln", "AT")], ddl)
    two = scd.scd3_apply(one.drop("_action"), again, "id", ["city", "country"], L3)
    assert rows(two.filter("id = 'A'"), "current_city", "previous_city", "current_country",
                "previous_country", "country_changed_on") == [("Köln", "Bonn", "AT", "DE", L3)]
    same = scd.scd3_apply(two.drop("_action"), again, "id", ["city", "country"], L3)
    assert rows(same.filter("_action <> 'kept'")) == []


def test_changes_lists_only_tracked_differences(initial, frame):
    found = scd.scd2_changes(initial, frame(V2, DDL), "id", TRACKED)
    assert rows(found, "id", "_old_contact", "contact") == [
        ("A", "Maria", "Marta"), ("B", "Ana", "Ana")
    ]


def test_no_gaps_after_loads(initial, frame):
    after = apply(initial, frame(V2, DDL), L2).drop("_action")
    assert quality.version_gaps(after, "id").isEmpty()
    torn = after.withColumn(
        "valid_to", F.when(~F.col("is_current"), F.date_sub("valid_to", 3)).otherwise(
            F.col("valid_to"))
    )
    assert quality.version_gaps(torn, "id").count() == 2


EVENT = "id string, n int, v string, name string, day date"


def absorbed(frame, batches):
    dim = None
    for batch in batches:
        dim = scd.scd2_absorb(dim, frame(batch, EVENT), "id", ["v"], "day", ["n"], "sk", ["name"])
    return dim


SHOWN = ["id", "v", "name", "valid_from", "valid_to", "is_current"]


def test_a_late_event_splits_a_version(frame):
    first = [("A", 1, "x", "a", D("2020-01-01")), ("A", 3, "x", "b", D("2020-03-01"))]
    late = [("A", 2, "y", "old", D("2020-02-01"))]
    assert rows(absorbed(frame, [first]), *SHOWN) == [
        ("A", "x", "b", D("1900-01-01"), D("9999-12-31"), True)]
    # The day seen behind the late event keeps its value; the newest event still names the member.
    assert rows(absorbed(frame, [first, late]), *SHOWN) == [
        ("A", "x", "b", D("1900-01-01"), D("2020-01-31"), False),
        ("A", "x", "b", D("2020-03-01"), D("9999-12-31"), True),
        ("A", "y", "b", D("2020-02-01"), D("2020-02-29"), False),
    ]


def test_a_late_event_removes_a_version(frame):
    first = [("A", 1, "x", "a", D("2020-01-01")), ("A", 2, "y", "a", D("2020-02-01")), ("A", 3, "x", "a", D("2020-03-01"))]
    assert absorbed(frame, [first]).count() == 3
    # A later word on the same day takes the middle version back.
    again = [("A", 4, "x", "a", D("2020-02-01"))]
    assert rows(absorbed(frame, [first, again]), *SHOWN) == [
        ("A", "x", "a", D("1900-01-01"), D("9999-12-31"), True)]
    # An earlier word on a day that has a later one changes nothing.
    earlier = [("A", 0, "z", "z", D("2020-02-01"))]
    assert same_rows(absorbed(frame, [first, earlier]), absorbed(frame, [first]))


def test_members_outside_the_batch_pass_through(frame):
    first = [("A", 1, "x", "a", D("2020-01-01")), ("B", 1, "p", "b", D("2020-01-01")), ("B", 2, None, "c", D("2020-05-01"))]
    out = absorbed(frame, [first, [("A", 5, None, None, D("2019-01-01"))]])
    assert rows(out.filter("id = 'B'"), *SHOWN) == [
        ("B", "p", "c", D("1900-01-01"), D("2020-04-30"), False),
        ("B", None, "c", D("2020-05-01"), D("9999-12-31"), True)]
    assert rows(out.filter("id = 'A'"), *SHOWN) == [
        ("A", "x", "a", D("2020-01-01"), D("9999-12-31"), True),
        ("A", None, "a", D("1900-01-01"), D("2019-12-31"), False)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_any_order_of_arrival_equals_a_rebuild(frame, seed):
    rng = random.Random(seed)
    events = [
        ("HOT" if rng.random() < 1 / 3 else f"m{rng.randrange(6)}", n, rng.choice(["x", "y", None]), f"name{n}",
         date(2020, 1, 1) + timedelta(rng.randrange(25)))
        for n in range(150)
    ]
    rng.shuffle(events)
    cuts = sorted(rng.sample(range(1, 150), 2))
    batches = [events[a:b] for a, b in zip([0, *cuts], [*cuts, 150])]
    found = absorbed(frame, batches)
    assert rows(found, *SHOWN) == rows(absorbed(frame, [events]), *SHOWN)
    plain = scd.scd2_history(frame(events, EVENT), "id", ["v"], "day", ["day", "n"], "sk")
    assert rows(found, "sk", "id", "v", "valid_from", "valid_to", "is_current") == rows(
        plain, "sk", "id", "v", "valid_from", "valid_to", "is_current")
    # The same events once more change nothing.
    assert rows(absorbed(frame, [*batches, batches[0]]), *SHOWN) == rows(found, *SHOWN)


def test_profile_stands_on_every_version(frame):
    dim = scd.scd2_history(
        frame([("A", 1, "x", "a", D("2020-01-01")), ("A", 2, "y", "a", D("2020-02-01"))], EVENT),
        "id", ["v"], "day", ["day", "n"], "sk")
    members = frame([("A", "Anna", "c1")], "id string, name string, class string")
    out = scd.with_profile(dim, members, "id", ["name", "class"])
    assert out.columns == ["sk", "id", "v", "name", "class", "valid_from", "valid_to", "is_current"]
    assert rows(out, "v", "name", "class") == [("x", "Anna", "c1"), ("y", "Anna", "c1")]
