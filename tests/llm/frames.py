"""Small frames with every odd case: nulls, empty and repeated rows, clashing and extra columns."""

ODD = [
    (1, "Alpha  beta gamma delta epsilon zeta", "en", "s", 1, "x"),
    (2, "Alpha beta\tgamma delta epsilon zeta", "en", "s", 1, "y"),
    (2, "Alpha beta\tgamma delta epsilon zeta", "en", "s", 1, "y"),
    (3, None, None, None, None, None),
    (None, "nothing to name it", "en", None, 3, "z"),
    (4, "", "de", "t", 0, ""),
    (5, " \n ", "de", "t", 0, ""),
    (6, "1234 !!", None, "t", 0, ""),
    (7, "word " * 20_000, "en", "s", 5, "long"),
]
ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string"


def odd(spark):
    return spark.createDataFrame(ODD, ODD_SCHEMA)


def nothing(spark):
    return spark.createDataFrame([], ODD_SCHEMA)


def clashing(spark):
    """Columns named like those that operators make inside."""
    return odd(spark).selectExpr("*", "1 as id", "'k' as key", "2 as sha", "3 as fp", "4 as copies", "5 as size", "6 as component", "7 as blob", "8 as spans", "9 as n")


def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet").toPandas()
