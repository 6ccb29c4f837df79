"""Small tables with the awkward rows every operator must take."""

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, first=1):
    """One row per text, ids ascending, with extra columns that clash with working names."""
    rows = [(first + i, t, "en", "src", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def clashing(df):
    """The same table with columns named as the operators' own."""
    extra = ["node", "comp", "score", "ids", "key", "range", "part", "rank", "hash", "length"]
    return df.withColumns({c: F.lit(c) for c in extra if c not in df.columns})


AWKWARD = [
    None,
    "",
    " \n\t ",
    "one",
    "two words",
    "αβγ 中文 \U0001f600 end",
    "tie tie tie tie tie tie tie tie",
    "tie tie tie tie tie tie tie tie",
    "word " * 30_000,
    "line\n" * 500,
]
