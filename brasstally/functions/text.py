"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters a trim removes (ASCII blanks, no-break space, BOM).
WHITESPACE = " \t\n\r\f\v\u00a0\ufeff"

# A folder id is one to four alphanumeric words joined by underscores.
FOLDER_PATTERN = "^[a-zA-Z0-9]+(_[a-zA-Z0-9]+){0,3}$"
FOLDER_WHEN_EMPTY = "unknown_billing_account_id"
FOLDER_WHEN_INVALID = "invalid_billing_account_format"

# A URL longer than 100 characters is shown by its two ends.
URL_LIMIT, URL_HEAD, URL_TAIL = 100, 50, 30


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    return F.btrim(_col(c), F.lit(WHITESPACE))


def is_blank(c: Column | str) -> Column:
    """Null, empty or only whitespace; never null itself."""
    return F.coalesce(strip(c) == "", F.lit(True))


def is_empty(c: Column | str) -> Column:
    """Null or zero-length; whitespace counts as a value."""
    return F.coalesce(_col(c) == "", F.lit(True))


def norm_key(c: Column | str) -> Column:
    """Join form of a free-typed key."""
    return F.lower(strip(_col(c).cast("string")))


def norm_email(c: Column | str) -> Column:
    return F.lower(strip(F.coalesce(_col(c), F.lit(""))))


def attention_name(first: Column | str, last: Column | str) -> Column:
    both = F.concat(F.coalesce(_col(first), F.lit("")), F.lit(" "), F.coalesce(_col(last), F.lit("")))
    return F.nullif(strip(both), F.lit(""))


def merge_emails(a: Column | str, b: Column | str) -> Column:
    """One address when they agree, both when they differ, whichever exists otherwise."""
    a, b = _col(a), _col(b)
    return F.when(a == b, a).otherwise(F.coalesce(F.concat(a, F.lit(","), b), a, b))


def hash_total(c: Column | str) -> Column:
    """Sum of the UTF-16 code units of a string, as a long."""
    units = F.transform(
        F.split(_col(c), ""),
        lambda ch: F.when(
            F.ascii(ch) > 0xFFFF,
            # A character beyond the basic plane counts as its two surrogates.
            F.lit(0xD800 + 0xDC00)
            + F.shiftright(F.ascii(ch) - 0x10000, 10)
            + (F.ascii(ch) - 0x10000).bitwiseAND(0x3FF),
        ).otherwise(F.ascii(ch)),
    )
    return F.aggregate(units, F.lit(0).cast("long"), lambda acc, u: acc + u.cast("long"))


def safe_folder(c: Column | str) -> Column:
    """Folder name that cannot climb out of its parent."""
    bare = F.replace(
        F.replace(F.replace(_col(c), F.lit(".."), F.lit("")), F.lit("/"), F.lit("")), F.lit("\\"), F.lit("")
    )
    return (
        F.when(is_empty(c), FOLDER_WHEN_EMPTY)
        .when(bare.rlike(FOLDER_PATTERN), bare)
        .otherwise(FOLDER_WHEN_INVALID)
    )


def file_name(name: Column | str, file_id: Column | str, suffix: str = ".pdf") -> Column:
    """Given name with the suffix ensured, or one made from the file id."""
    name, made = _col(name), F.concat(F.lit("file_"), _col(file_id).cast("string"), F.lit(suffix))
    return (
        F.when(is_empty(name), made)
        .when(F.endswith(F.lower(name), F.lit(suffix)), name)
        .otherwise(F.concat(name, F.lit(suffix)))
    )


def short_url(c: Column | str) -> Column:
    c = _col(c)
    ends = F.concat(F.substring(c, 1, URL_HEAD), F.lit("..."), F.right(c, F.lit(URL_TAIL)))
    return F.when(F.length(c) > URL_LIMIT, ends).otherwise(c)


def inactive_flag(c: Column | str) -> Column:
    """'No' for an active row, 'Yes' for anything else, missing included."""
    return F.when(_col(c) == "Yes", "No").otherwise("Yes")
