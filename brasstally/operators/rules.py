"""Validation rules as columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from brasstally.operators.gates import all_of, any_of
from brasstally.functions.text import is_blank
from brasstally.result import known_codes

Rule = tuple[Column, Column | str]


def messages(rules: Sequence[Rule], separator: str = "; ") -> Column:
    """Messages of the rules that hold, joined; empty when none does."""
    return F.concat_ws(separator, *[F.when(c, F.lit(m) if isinstance(m, str) else m) for c, m in rules])


def category(rules: Sequence[tuple[Sequence[Column], str]], otherwise: Column) -> Column:
    """Label of the first group of conditions with a hit."""
    out = F.when(F.lit(False), "")
    for conditions, label in rules:
        out = out.when(any_of([F.coalesce(c, F.lit(False)) for c in conditions]), label)
    return out.otherwise(otherwise)


def missing_fields(fields: Sequence[tuple[str, Column]]) -> Column:
    """Names of the fields whose condition holds, comma separated; empty when none is missing."""
    return F.concat_ws(", ", *[F.when(c, F.lit(name)) for name, c in fields])


def open_judgement(df: DataFrame) -> DataFrame:
    """Adds empty reject columns for ``refuse`` to fill."""
    none = F.lit(None).cast("string")
    return df.withColumns({"reject_code": none.alias("reject_code", metadata={"codes": []}), "reject_message": none})


def refuse(df: DataFrame, condition: Column, code: str, message: Column) -> DataFrame:
    """Mark rows not refused before. The first refusal stands.

    The code is noted on the column, so that a write knows what it may count.
    """
    fresh = F.col("reject_code").isNull() & F.coalesce(condition, F.lit(False))
    codes = list(dict.fromkeys([*known_codes(df), code]))
    return df.withColumns(
        {
            "reject_code": F.when(fresh, code).otherwise(F.col("reject_code")).alias("reject_code", metadata={"codes": codes}),
            "reject_message": F.when(fresh, message).otherwise(F.col("reject_message")),
        }
    )


def required_fields(
    df: DataFrame,
    fields: Sequence[tuple[str, Column]],
    message: Callable[[Column], Column] = lambda names: F.concat(F.lit("needs "), names),
) -> DataFrame:
    """Refuse rows lacking a field with code ``missing_fields``; ``message`` gets the names."""
    named = df.withColumn("_lacks", missing_fields(fields))
    return refuse(named, F.col("_lacks") != "", "missing_fields", message(F.col("_lacks"))).drop("_lacks")


def blank_flags(fields: Sequence[tuple[str, str]], mode: str) -> dict[str, Column]:
    """One flag per (flag name, column), and ``is_missing``: all of them or any of them."""
    flags = {name: is_blank(column) for name, column in fields}
    combine = all_of if mode == "all" else any_of
    return {**flags, "is_missing": combine(list(flags.values()))}
