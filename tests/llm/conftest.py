import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

_CLASHING = (
    "row salt digest norm kept keep_id size words fp hash score label n uid id copies part key"
    " component node source_key ids bytes tokens features position list role block weight unit"
    " doc taken target base chosen drawn_id kept_id n_tokens length mask text_key found_id"
).split()


@pytest.fixture(scope="session")
def edge_rows():
    """(doc_id, text, lang, source): nulls everywhere, empty and long texts, ties, repeats."""
    draw = random.Random(7)
    vocabulary = ["the", "Of", "and", "Éa", "naïve", "data", "x1", "日本", "a-b", "ß"] + [
        f"w{i}" for i in range(60)
    ]
    rows = [
        (1, "Same TEXT here", "en", "a"),
        (2, "same text HERE", "en", "b"),
        (2, "same text HERE", "en", "b"),
        (3, "sÉme", "fr", "a"),
        (4, "séme", "fr", "a"),
        (5, None, "en", None),
        (6, "", None, ""),
        (7, " \t\n ", "de", "b"),
        (None, "no id at all", "en", "c"),
        (None, "no id at all", "en", None),
        (8, "x" * 3000, "en", "c"),
        (9, "one", "de", "a"),
        (10, "one two", "de", "a"),
        (11, "Licensed under the Apache License, Version 2.0 of it", "en", "a"),
        (12, "is under the MIT license and under the MIT License; CC BY-NC", "en", "b"),
        (13, "12 34 !!! ??", None, "c"),
        (14, "don't stop <|endoftext|> it's   the\r\n end ", "en", "b"),
        (15, "line\x0bfeed\x0cand\x1cothers too   wide", "en", "b"),
    ]
    for i in range(20, 60):
        text = " ".join(draw.choice(vocabulary) for _ in range(draw.randint(1, 60)))
        rows.append((i, text, draw.choice(["en", "fr"]), draw.choice(["a", "b", "c", "d"])))
    rows.append((60, " ".join(draw.choice(vocabulary) for _ in range(20_000)), "en", "d"))
    for i in range(61, 70):  # near copies of the long text, and exact ones
        parts = rows[-1][1].split() if i > 61 else rows[-1][1].split()
        parts[draw.randrange(len(parts))] = f"changed{i % 3}"
        rows.append((i, " ".join(parts), "en", "d"))
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    """The rows as documents, with further columns named as the operators name theirs."""
    docs = spark.createDataFrame(
        [(*row, None if row[1] is None else len(row[1])) for row in edge_rows],
        "doc_id long, text string, lang string, source string, n_chars long",
    ).repartition(5)
    from pyspark.sql import functions as F

    return docs.select("*", *[F.lit("other").alias(name) for name in _CLASHING])


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.where("false")


@pytest.fixture(scope="session")
def rows_of():
    """Rows as sorted tuples; None sorts first."""

    def rows(frame, *columns):
        taken = [tuple(row) for row in (frame.select(*columns) if columns else frame).collect()]
        return sorted(taken, key=lambda row: [(x is not None, str(type(x)), x) for x in row])

    return rows
