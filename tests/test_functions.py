"""Column helpers on hand-written edges and against plain Python."""

import calendar
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from brasstally.functions import address, dates, numbers, text


def evaluate(spark, values, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(values, schema).select(*columns).collect()]


def one(spark, values, fn, kind="string"):
    return [r[0] for r in evaluate(spark, [(v,) for v in values], f"c {kind}", fn(F.col("c")))]


def test_blank_and_empty(spark):
    values = [None, "", " ", "\t\n", " ", "x", " x "]
    assert one(spark, values, text.is_blank) == [True, True, True, True, True, False, False]
    assert one(spark, values, text.is_empty) == [True, True, False, False, False, False, False]
    assert one(spark, ["\t Ab "], text.norm_key) == ["ab"]


def test_merge_emails(spark):
    pairs = [("a", "a"), ("a", "b"), ("a", None), (None, "b"), (None, None)]
    got = evaluate(spark, pairs, "a string, b string", text.merge_emails("a", "b"))
    assert [g[0] for g in got] == ["a", "a,b", "a", "b", None]


def test_attention_name(spark):
    pairs = [("Ann", "Lee"), ("Ann", None), (None, "Lee"), ("", ""), (None, None), (" ", " ")]
    got = evaluate(spark, pairs, "a string, b string", text.attention_name("a", "b"))
    assert [g[0] for g in got] == ["Ann Lee", "Ann", "Lee", None, None, None]


def test_hash_total_counts_utf16_units(spark):
    values = ["abc", "é", "😀a", ""]
    expected = [sum(int.from_bytes(v.encode("utf-16-le")[i : i + 2], "little") for i in range(0, len(v.encode("utf-16-le")), 2)) for v in values]
    assert one(spark, values, text.hash_total) == expected


def test_safe_folder(spark):
    values = [None, "", "two_words", "../ab/c", "a_b_c_d_e", "a\\b", "a b", "one", "..", "a_b_c_d"]
    bad, empty = text.FOLDER_WHEN_INVALID, text.FOLDER_WHEN_EMPTY
    assert one(spark, values, text.safe_folder) == [empty, empty, "two_words", "abc", bad, "ab", bad, "one", bad, "a_b_c_d"]


def test_file_name_and_url(spark):
    got = evaluate(
        spark, [(None, 7), ("", 8), ("a.PDF", 1), ("b", 2)], "n string, i long", text.file_name("n", "i")
    )
    assert [g[0] for g in got] == ["file_7.pdf", "file_8.pdf", "a.PDF", "b.pdf"]
    long = "h" * 60 + "t" * 41
    assert one(spark, ["x" * 100, long], text.short_url) == ["x" * 100, "h" * 50 + "..." + "t" * 30]


def test_safe_number(spark):
    values = [None, "", "  ", "1,234.50", "abc", "1e3", "-0.5", "Infinity", "12abc"]
    got = [None if v is None else float(v) for v in one(spark, values, numbers.safe_number)]
    assert got == [None, 0.0, 0.0, 1234.5, None, 1000.0, -0.5, None, None]


def test_classify_transaction(spark):
    got = one(spark, ["-0.01", "0", "0.99", "1", None], lambda c: numbers.classify_transaction(c.cast("decimal(18,2)")))
    assert got == ["Credit Memo", "None", "None", "Invoice", "None"]


def test_external_id(spark):
    rows = [("Invoice", 7, date(2024, 2, 29)), ("Credit Memo", 7, date(2024, 12, 31)), ("None", 7, date(2024, 1, 31)), ("Invoice", None, date(2024, 1, 31))]
    got = evaluate(spark, rows, "k string, c long, d date", numbers.external_id("k", "c", "d", "IN", "CM"))
    assert [g[0] for g in got] == ["IN7202402", "CM7202412", "IN7202401", None]


def test_rate_by_zero_is_null(spark):
    got = evaluate(spark, [("10", "4"), ("10", "0"), ("10", None)], "a string, q string", numbers.rate("a", "q"))
    assert [None if g[0] is None else float(g[0]) for g in got] == [2.5, None, None]


def test_clean_amount_and_invoice_type(spark):
    assert one(spark, [None, "", " ", ".00", " .00 ", "0", "5"], numbers.clean_amount) == ["0.00"] * 5 + ["0", "5"]
    items = [None, "PREPAID x", "Services", "evergreen", "other"]
    assert one(spark, items, numbers.invoice_type) == ["Overage", "Prepaid", "Prepaid", "Self Service", "Overage"]


def test_parse_date(spark):
    values = [None, "", "2024-02-29T10:00:00Z", "2024-02-31", "2024-3-5", "junk", "0000-01-01"]
    got = one(spark, values, dates.parse_date)
    assert got == [None, None, date(2024, 2, 29), None, date(2024, 3, 5), None, None]
    assert one(spark, ["2024-02-29T10:00:00Z", "2024-02-31", "x"], dates.as_date) == [date(2024, 2, 29), None, None]


def clamped(day: date, months: int) -> date:
    total = day.year * 12 + day.month - 1 + months
    year, month = divmod(total, 12)
    return date(year, month + 1, min(day.day, calendar.monthrange(year, month + 1)[1]))


def ceiling_months(start: date, end: date) -> int:
    """Smallest number of clamped months that reaches the end, by counting up."""
    if end < start:
        return 0
    months = 0
    while clamped(start, months) < end:
        months += 1
    return months


def test_term_months_equals_counting_up(spark):
    first = date(2023, 11, 28)
    pairs = [(first + timedelta(days=i), first + timedelta(days=i + j)) for i in range(0, 130, 3) for j in range(-2, 900, 13)]
    pairs += [(date(2024, 1, 31), date(2024, 2, 29)), (date(2023, 1, 31), date(2023, 2, 28)), (date(2024, 2, 29), date(2025, 2, 28))]
    got = evaluate(spark, pairs, "s date, e date", "s", "e", dates.term_months("s", "e"))
    assert [g[2] for g in got] == [ceiling_months(s, e) for s, e, _ in got]


def test_term_band_edges(spark):
    assert one(spark, [None, 0, 17, 18, 29, 30], dates.term_band, "int") == [None, "Y1", "Y1", "Y2", "Y2", "Y3"]


@pytest.mark.parametrize(
    "frequency,contract,service,expected",
    [
        ("semi_annual", date(2024, 1, 1), date(2024, 1, 1), ("Semi-Annual - Yr 1", 0, "Scenario 1: 1 Year", False)),
        ("Half yearly", date(2024, 1, 1), date(2025, 1, 1), ("Semi-Annual - Yr 2", 1, "Scenario 2: Multi-Year", False)),
        ("up_front", date(2024, 1, 31), date(2026, 1, 1), ("Annual - Yr 3", 2, "Scenario 2: Multi-Year", False)),
        ("monthly", date(2024, 1, 1), date(2027, 1, 1), ("REVIEW NEEDED", 3, "Scenario 3: Non-Standard", True)),
        ("monthly", date(2024, 1, 1), date(2023, 12, 31), ("REVIEW NEEDED", None, "Scenario 3: Non-Standard", True)),
        ("weekly", date(2024, 1, 1), date(2024, 5, 1), ("REVIEW NEEDED", 0, "Scenario 1: 1 Year", True)),
        (None, date(2024, 1, 1), date(2024, 5, 1), ("REVIEW NEEDED", 0, "Scenario 1: 1 Year", True)),
        ("monthly", None, date(2024, 5, 1), ("REVIEW NEEDED", None, "Invalid/Missing Dates", True)),
    ],
)
def test_billing_schedule(spark, frequency, contract, service, expected):
    df = spark.createDataFrame([(frequency, contract, service)], "f string, c date, s date")
    row = dates.with_billing_schedule(df, "f", "c", "s").first()
    assert tuple(row[3:]) == expected


def test_flatten_address(spark):
    rows = [
        ('{"firstName":"A","country":"UK","state":"Old","extra":"z","nested":{"a":1}}',),
        ("{bad",),
        (None,),
        ("[1]",),
    ]
    df = spark.createDataFrame(rows, "a string")
    got = address.flatten_address(df, "a", "b", countries={"UK": "GB"}, states={"Old": "New"}).collect()
    assert got[0]["b_country"] == "GB" and got[0]["b_state"] == "New" and got[0]["b_attention"] == "A"
    assert got[0]["b_other"] == {"extra": "z", "nested": '{"a":1}'}
    for bad in got[1:]:
        assert bad["b_country"] is None and bad["b_attention"] is None


def test_json_text_is_scalar_only(spark):
    rows = ['{"k":"v"}', '{"k":5}', '{"k":{"a":1}}', '{"k":[1]}', '{"k":null}', "{bad", None]
    assert one(spark, rows, lambda c: address.json_text(c, "k")) == ["v", "5", None, None, None, None, None]
