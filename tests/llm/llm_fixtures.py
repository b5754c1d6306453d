"""Fixtures of these tests; they import them by name, as a second conftest
would hide the first."""

import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

PROSE = ("The quick brown fox jumps over the lazy dog, and then it rests a while under the old oak tree. "
         "Later that day a second fox came by to see what had become of the first one. ")


def edge_rows():
    """Nulls in every column, empty, blank, tiny and very long texts, copies,
    near copies, repeated rows and repeated ids."""
    long = " ".join(f"word{i % 9001} {PROSE.split()[i % 30]}." for i in range(40_000))
    texts = [None, "", " \t\n ", "word", "two words", "three little words", PROSE, PROSE, PROSE + "Indeed.",
             long, "x" * 50_000, "1" * 20_000, "a@b.cd " + PROSE, PROSE.upper().replace(" ", "!! "), "### $$$ " * 60,
             "Licensed under the Apache License, Version 2.0.", PROSE + "\nReleased under the MIT License.\n" + PROSE]
    rows = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in enumerate(texts, 1)]
    return rows + [rows[6], rows[1], (None, PROSE, None, None, None), (None, None, None, None, None), (3, PROSE + "Other.", None, "s", None)]


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def clashing(edge_docs):
    """Further columns, named like those that operators make themselves."""
    from pyspark.sql import functions as F

    names = ("stats", "votes", "score", "spans", "mentions", "length", "row", "fl_text", "fl_words", "fl_row", "component", "matches", "fl_spans")
    return edge_docs.withColumns({n: F.lit(f"x{k}") for k, n in enumerate(names)})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def result(spark, name):
    from farelens.llm import queries

    return queries.QUERIES[name](spark, SF).collect()
