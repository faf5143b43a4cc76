"""Compare a Spark frame with a DuckDB query, row by row, whatever the order."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter


def plain(value):
    if value is None or value != value:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        return ("n", format(value.normalize(), "f") if value else "0")
    if isinstance(value, int):
        return ("n", str(value))
    if isinstance(value, float):
        return ("n", str(int(value)) if value == math.floor(value) and abs(value) < 1e15 else repr(round(value, 9)))
    if isinstance(value, datetime.datetime):
        return ("t", value.isoformat())
    if isinstance(value, datetime.date):
        return ("d", value.isoformat())
    return value


def compare(df, con, sql: str) -> str:
    names = sorted(df.columns)
    spark_rows = [tuple(plain(r[n]) for n in names) for r in df.collect()]
    relation = con.execute(sql)
    found = [c[0] for c in relation.description]
    if sorted(found) != names:
        return f"COLUMNS spark-only {set(names) - set(found)} sql-only {set(found) - set(names)}"
    where = [found.index(n) for n in names]
    sql_rows = [tuple(plain(r[i]) for i in where) for r in relation.fetchall()]
    left, right = Counter(spark_rows), Counter(sql_rows)
    if left == right:
        return f"OK {len(spark_rows)}"
    only_left, only_right = left - right, right - left
    show = lambda c: [dict(zip(names, k)) for k in list(c)[:2]]
    return (
        f"DIFF rows {len(spark_rows)} vs {len(sql_rows)}, spark-only {sum(only_left.values())}, "
        f"sql-only {sum(only_right.values())}\n  {show(only_left)}\n  {show(only_right)}"
    )
