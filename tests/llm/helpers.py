"""Rows that every operator must handle, and plain versions of the shared rules."""

import re

LONG = "the quick brown fox jumps over the lazy dog and runs home again " * 3000

#: Null and empty texts, a very long one, a repeated row, a null id, white space only, signs beyond the first plane.
ODD = [
    (1, "Hello World! It's 2024, isn't it?"), (2, None), (3, ""), (4, LONG), (5, "same text twice, word for word"),
    (5, "same text twice, word for word"), (None, "a row without an id"), (7, " \t\n\r "), (8, "ümläut ÉCOLE Σίσυφος 日本語 😀 <|endoftext|> x"),
]

#: Columns that have the names of results.
CLASHING = "doc_id bigint, text string, n_tokens string, score string, fp string, spans string, n_lines string, key string, part string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, *["own"] * 7) for i, t in rows], CLASHING)


def written(spark, tmp_path, **tables):
    """A folder of tables, as queries read them."""
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def ascii_lower(text):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")


def key(row):
    return tuple((x is not None, x) for x in row)
