"""Integrity checks. Every check is a one-row frame; a report is their union."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from stardw.functions import changed
from stardw.functions.keys import key_text

from .asof import unmatched


def _result(frame: DataFrame, name: str, expected: Column, ok: Column | None = None):
    """`frame` has one row with column `value`."""
    wanted = expected.cast("double")
    passed = (F.col("value") == F.col("expected")) if ok is None else ok
    return frame.select(
        F.lit(name).alias("check"),
        F.col("value").cast("double").alias("value"),
        wanted.alias("expected"),
    ).select(
        "check",
        F.when(F.coalesce(passed, F.lit(False)), "PASS").otherwise("FAIL").alias("status"),
        "value",
        "expected",
    )


def expect_none(name: str, offending: DataFrame) -> DataFrame:
    """No row may be in `offending`."""
    return _result(offending.agg(F.count("*").alias("value")), name, F.lit(0))


def expect_count(name: str, df: DataFrame, expected: int | Column) -> DataFrame:
    wanted = expected if isinstance(expected, Column) else F.lit(expected)
    return _result(df.agg(F.count("*").alias("value")), name, wanted)


def expect_same_count(name: str, df: DataFrame, other: DataFrame) -> DataFrame:
    return expect_count(name, df, other.agg(F.count("*")).scalar())


def expect_rows(name: str, df: DataFrame, must_hold: Column) -> DataFrame:
    """No row may break the condition; NULL does not break it."""
    return expect_none(name, df.filter(~must_hold))


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def expect_unique(name: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return expect_none(name, duplicates(df, keys))


def expect_one_current(name: str, dim: DataFrame, key: str) -> DataFrame:
    return expect_unique(name, dim.filter("is_current"), [key])


def version_gaps(dim: DataFrame, key: str) -> DataFrame:
    """Versions that end before they begin, or not on the day before the next start."""
    following = F.lead("valid_from").over(Window.partitionBy(key).orderBy("valid_from", "valid_to"))
    inverted = F.col("valid_from") > F.col("valid_to")
    apart = F.col("next_from").isNotNull() & (F.date_add("valid_to", 1) != F.col("next_from"))
    return dim.select(key, "valid_from", "valid_to", following.alias("next_from")).filter(
        inverted | F.coalesce(apart, F.lit(False))
    )


def orphans(facts: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None):
    """Facts whose key is not in the dimension."""
    right = dim.select(F.col(dim_key or key).alias("_dim_key"))
    return facts.join(right, F.col(key) == F.col("_dim_key"), "left_anti")


def expect_fk(
    name: str, facts: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None
) -> DataFrame:
    """Every fact key has its dimension row. Keys are made distinct before the join."""
    return expect_none(name, orphans(facts.select(key).distinct(), dim, key, dim_key))


def expect_date_cover(name: str, facts: DataFrame, key: str, dates: DataFrame) -> DataFrame:
    """The calendar spans all date keys; the value is the number of open ends."""
    low, high = facts.agg(F.min(key)).scalar(), facts.agg(F.max(key)).scalar()
    ends = dates.agg(
        ((F.min("date_key") > low).cast("int") + (F.max("date_key") < high).cast("int"))
        .alias("value")
    )
    return _result(ends, name, F.lit(0))


def expect_close(
    name: str, df: DataFrame, col: str, other: DataFrame, other_col: str, tolerance: float
) -> DataFrame:
    """Two totals agree within a tolerance."""
    frame = df.agg(F.sum(col).alias("value"))
    wanted = other.agg(F.sum(other_col)).scalar()
    near = F.abs(F.col("value") - F.col("expected")) <= tolerance
    return _result(frame, name, wanted, near)


def expect_equal_values(
    name: str, left: DataFrame, right: DataFrame, key: str, columns: Mapping[str, str]
) -> DataFrame:
    """Attributes of matching keys agree, NULL equal to NULL."""
    other = right.select(
        F.col(key).alias("_key"), *[F.col(c).alias(f"_o_{c}") for c in columns.values()]
    )
    differs = reduce(
        lambda a, b: a | b,
        (changed(F.col(a), F.col(f"_o_{b}")) for a, b in columns.items()),
    )
    return expect_none(name, left.join(other, F.col(key) == F.col("_key")).filter(differs))


def expect_cover(name: str, facts: DataFrame, versions: DataFrame, key: str, day: str):
    """Every fact day has a version of its member; value is the facts without one."""
    return expect_none(name, unmatched(facts, versions, key, day))


def reconcile_counts(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Row counts of two layers per table, and whether they agree."""
    def one(name: str, source: DataFrame, target: DataFrame) -> DataFrame:
        return source.agg(
            F.lit(name).alias("table"), F.count("*").alias("source_rows")
        ).withColumn("target_rows", target.agg(F.count("*")).scalar())

    parts = [one(n, s, t) for n, (s, t) in pairs.items()]
    stacked = reduce(DataFrame.unionByName, parts)
    return stacked.withColumn("ok", F.col("source_rows") == F.col("target_rows"))


def fingerprint(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """Rows of each partition `by` and two sums of 64-bit hashes of their content, in any order of rows.

    Which columns are NULL is hashed as well: the hash itself passes over NULLs.
    """
    nulls = F.concat(*[F.col(c).isNull().cast("string") for c in columns])
    sums = {
        f"print_{seed}": F.sum(F.xxhash64(F.lit(seed), *columns, nulls).cast("decimal(38,0)")) for seed in (1, 2)}
    return df.groupBy(by).agg(F.count("*").alias("rows"), *[v.alias(k) for k, v in sums.items()])


def reconcile_content(source: DataFrame, target: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """Per partition the rows of two layers and whether they hold the same values.

    Only one row per partition and layer meets; partitions of one layer alone differ.
    The columns must have the same types on both sides.
    """
    kinds = [[dict(df.dtypes)[c] for c in columns] for df in (source, target)]
    if kinds[0] != kinds[1]:
        raise TypeError(f"columns differ in type: {kinds}")
    left, right = fingerprint(source, columns, by), fingerprint(target, columns, by)
    other = right.withColumnsRenamed({c: f"_t_{c}" for c in right.columns})
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in ("rows", "print_1", "print_2")))
    return left.join(other, F.col(by).eqNullSafe(F.col(f"_t_{by}")), "full").select(
        F.coalesce(by, f"_t_{by}").alias(by),
        F.coalesce("rows", F.lit(0)).alias("source_rows"), F.coalesce("_t_rows", F.lit(0)).alias("target_rows"),
        same.alias("ok"))


def inventory(tables: Mapping[str, DataFrame], expected: Mapping[str, int] | None = None):
    """Row count per table, next to the expected number where one is given."""
    expected = expected or {}

    def one(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.lit(name).alias("table"), F.count("*").alias("rows")).withColumn(
            "expected", F.lit(expected.get(name)).cast("bigint")
        )

    stacked = reduce(DataFrame.unionByName, [one(n, d) for n, d in tables.items()])
    return stacked.withColumn("ok", F.col("rows") == F.col("expected"))


def run_checks(checks: Sequence[DataFrame]) -> DataFrame:
    """Number the checks and put them into one result."""
    numbered = [c.select(F.lit(i).alias("no"), "*") for i, c in enumerate(checks, 1)]
    return reduce(DataFrame.unionByName, numbered)


def summary(report: DataFrame) -> DataFrame:
    return report.agg(
        F.count("*").alias("checks"),
        F.count_if(F.col("status") == "PASS").alias("passed"),
        F.count_if(F.col("status") == "FAIL").alias("failed"),
    )


@dataclass(frozen=True)
class Check:
    """A check of `check_tables`, made by `holds`, `unique` or `refers`."""

    name: str
    kind: str
    table: str
    keys: tuple[str, ...] = ()
    condition: Column | None = None
    other: str = ""
    other_keys: tuple[str, ...] = ()


def holds(name: str, table: str, condition: Column) -> Check:
    """No row breaks the condition; NULL does not break it."""
    return Check(name, "holds", table, condition=condition)


def unique(name: str, table: str, keys: Sequence[str], where: Column | None = None) -> Check:
    """No key occurs twice among the rows of `where`; the value is the keys that do."""
    return Check(name, "unique", table, tuple(keys), where)


def refers(name: str, table: str, keys: Sequence[str], other: str, other_keys: Sequence[str]) -> Check:
    """Every key has its row in the other table; the value is the keys without one, NULL among them."""
    return Check(name, "refers", table, tuple(keys), None, other, tuple(other_keys))


def check_tables(
    tables: Mapping[str, DataFrame], checks: Sequence[Check], rows: Mapping[str, Observation] | None = None
) -> DataFrame:
    """A report like that of `run_checks`, with one scan of each table and one shuffle in all.

    Each row says what it has to say to all checks of its table at once: an entry
    for a condition it breaks, its key for a grain, its key for a reference and,
    in the table referred to, for being there. Entries are summed by check and
    key, in each task first, so that a frequent key is one row per task.

    `rows` gives observations that receive the row counts of tables in passing,
    as a metric `rows`, once the report has been computed.
    """
    def entry(no: int, here: Column | None, key: Column, side: int) -> Column:
        one = F.struct(F.lit(no).alias("no"), key.alias("key"), F.lit(side).alias("side"))
        return one if here is None else F.when(here, one)

    said: dict[str, list[Column]] = {}
    for no, check in enumerate(checks, 1):
        mine = said.setdefault(check.table, [])
        if check.kind == "holds":
            mine.append(entry(no, ~check.condition, F.lit(""), 0))
        else:
            mine.append(entry(no, check.condition, key_text(*check.keys), 0))
        if check.kind == "refers":
            known = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in check.other_keys))
            said.setdefault(check.other, []).append(entry(no, known, key_text(*check.other_keys), 1))

    def entries(name: str) -> DataFrame:
        df = tables[name]
        if rows and name in rows:
            df = df.observe(rows[name], F.count(F.lit(1)).alias("rows"))
        return df.select(F.inline(F.array_compact(F.array(*said[name]))))

    per_key = reduce(DataFrame.unionByName, map(entries, said)).groupBy("no", "key").agg(
        F.count_if(F.col("side") == 0).alias("here"), F.count_if(F.col("side") == 1).alias("there"))

    def numbers(kind: str) -> Column:
        return F.col("no").isin([n for n, c in enumerate(checks, 1) if c.kind == kind])

    bad = F.when(numbers("holds"), F.col("here")).when(
        numbers("unique"), (F.col("here") > 1).cast("bigint")).otherwise(
        ((F.col("here") > 0) & (F.col("there") == 0)).cast("bigint"))
    counts = per_key.groupBy("no").agg(F.sum(bad).alias("_bad"))
    names = F.array(*[F.struct(F.lit(n).alias("no"), F.lit(c.name).alias("check")) for n, c in enumerate(checks, 1)])
    listed = next(iter(tables.values())).sparkSession.range(1).select(F.inline(names))
    value = F.coalesce(F.col("_bad"), F.lit(0)).cast("double")
    return listed.join(counts, "no", "left").select(
        "no", "check", F.when(value == 0, "PASS").otherwise("FAIL").alias("status"), value.alias("value"),
        F.lit(0.0).alias("expected"))


def load_window(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """First and last load day and rows per table, by the stamp column given."""
    parts = [
        df.agg(
            F.lit(name).alias("table"),
            F.min(stamp).cast("date").alias("first_load"),
            F.max(stamp).cast("date").alias("last_load"),
            F.count("*").alias("rows"),
        )
        for name, (df, stamp) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)
