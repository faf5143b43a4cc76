"""Release checks on outputs: each is one row of counts, a failure is anything but zero.

A check names a frame and what must hold in it. All checks on one frame are made in
one pass over it: a row gives an entry for every check that has to see it, entries are
counted per check and key (map-side), and one aggregate judges the counts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True, eq=False)
class Check:
    """``failures`` and ``detail`` are aggregates of ``n`` (entries of a key) and ``key``, over this check's keys.

    ``entry`` is the key of a row's entry, an array of texts, or null where the row has
    none. ``members`` (frame, its key, the row's key) adds ``member``, whether the key is
    among the frame's, for ``entry`` to use.
    """

    rows: DataFrame
    name: str
    entry: Column
    failures: Column
    detail: Column | None = None
    members: tuple[DataFrame, str, str] | None = None


MEMBER = "member"


def _every() -> Column:
    return F.array(F.lit(""))


def _entries() -> Column:
    return F.coalesce(F.sum("n"), F.lit(0))


def _rows_with(condition: Column) -> Column:
    return F.when(F.coalesce(condition, F.lit(False)), _every())


def isolation(check: str, rows: DataFrame, key: str, forbidden: DataFrame, forbidden_key: str) -> Check:
    """No row's key may be among the forbidden ones."""
    return Check(rows, check, _rows_with(F.col(MEMBER)), _entries(), members=(forbidden, forbidden_key, key))


def allowlist(check: str, rows: DataFrame, key: str, allowed: DataFrame, allowed_key: str) -> Check:
    """Every row's key must be among the allowed ones."""
    return Check(rows, check, _rows_with(~F.col(MEMBER)), _entries(), members=(allowed, allowed_key, key))


def uniqueness(check: str, rows: DataFrame, keys: Sequence[str]) -> Check:
    """No combination of the keys may repeat."""
    return Check(rows, check, F.array(*[F.col(k).cast("string") for k in keys]), F.count_if(F.col("n") > 1))


def not_constant(column: str, value: object) -> Column:
    """Rows in which the column holds anything but the value."""
    return ~F.col(column).eqNullSafe(F.lit(value))


def prefixed(column: str, prefixes: Sequence[str]) -> Column:
    """Rows whose value begins with one of the prefixes."""
    hit = reduce(lambda a, b: a | b, [F.startswith(F.col(column), F.lit(p)) for p in prefixes])
    return F.coalesce(hit, F.lit(False))


def row_checks(rows: DataFrame, bad: Mapping[str, Column]) -> list[Check]:
    """No row may meet a condition."""
    return [Check(rows, name, _rows_with(condition), _entries()) for name, condition in bad.items()]


def row_count(check: str, rows: DataFrame, baseline: int) -> Check:
    """The number of rows must equal a baseline; the failure count is the distance."""
    return Check(rows, check, _every(), F.abs(_entries() - F.lit(baseline)), _entries())


def distinct_values(check: str, rows: DataFrame, column: str, expected: Sequence[str]) -> Check:
    """The column may hold only expected values; the detail is the lowest one that is not."""
    strange = (F.col("n") > 0) & ~F.coalesce(F.col("key")[0].isin(*expected), F.lit(False))
    return Check(rows, check, F.array(F.col(column).cast("string")), F.count_if(strange), F.min(F.when(strange, F.col("key")[0])))


def _in_one_pass(checks: Sequence[Check]) -> DataFrame:
    """(``check_name``, ``failures``, ``detail``) of checks that share one frame."""
    rows, marks, entries = checks[0].rows, {}, []
    for n, check in enumerate(checks):
        if check.members:
            frame, theirs, ours = check.members
            mark = marks.get((id(frame), theirs, ours))
            if mark is None:
                mark = marks[id(frame), theirs, ours] = f"_in{len(marks)}"
                known = frame.select(F.col(theirs).alias(f"{mark}_key"), F.lit(True).alias(mark)).distinct()
                rows = rows.join(known, F.col(ours) == F.col(f"{mark}_key"), "left")
            rows = rows.withColumn(MEMBER, F.coalesce(mark, F.lit(False)))
        rows = rows.withColumn(f"_key{n}", check.entry)
        here = F.struct(F.lit(n).alias("check"), F.col(f"_key{n}").alias("key"))
        entries.append(F.when(F.col(f"_key{n}").isNotNull(), here))
    each = rows.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*")
    counted = each.groupBy("check", "key").agg(F.count("*").alias("n"))
    # A check without an entry is judged too.
    none = rows.sparkSession.createDataFrame([(n, None, 0) for n in range(len(checks))], "check int, key array<string>, n long")
    judged = counted.unionByName(none).groupBy("check").agg(
        *[c.failures.cast("long").alias(f"_f{n}") for n, c in enumerate(checks)],
        *[(F.lit(None) if c.detail is None else c.detail).cast("string").alias(f"_d{n}") for n, c in enumerate(checks)],
    )

    def own(values: list[Column]) -> Column:
        return F.array(*values)[F.col("check")]

    return judged.select(
        own([F.lit(c.name) for c in checks]).alias("check_name"),
        own([F.col(f"_f{n}") for n in range(len(checks))]).alias("failures"),
        own([F.col(f"_d{n}") for n in range(len(checks))]).alias("detail"),
    )


def quality_checks(checks: Sequence[Check | Sequence[Check]]) -> DataFrame:
    """All checks' rows together, with a verdict; checks on the same frame are made in one pass over it."""
    flat = [c for some in checks for c in (some if isinstance(some, (list, tuple)) else [some])]
    frames: dict[int, list[Check]] = {}
    for check in flat:
        frames.setdefault(id(check.rows), []).append(check)
    rows = reduce(DataFrame.unionByName, [_in_one_pass(own) for own in frames.values()])
    return rows.withColumn("passed", F.col("failures") == 0)
