from __future__ import annotations

import pytest

LONG = " ".join(f"word{i % 977}" for i in range(60_000))
CLASHING = "mix string, size long, hash long, position long, node long, copies long, plan__ string, text__ string, own__ long, key string"
PARAGRAPH = "A passage of more than forty characters that many documents share."


def paragraph(n: int) -> str:
    return " ".join(f"w{n}x{i}" for i in range(60))


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in every column, empty and long texts, repeated rows and repeated ids."""
    return [
        (1, paragraph(1), "en", "a", 1), (1, paragraph(1), "en", "a", 1), (2, None, None, None, None),
        (3, "", "en", "a", 0), (None, paragraph(2), "de", "b", 5), (None, None, None, None, None),
        (4, " \t\r\n\x0b ", "en", "", 5), (5, LONG, "en", "a", None), (6, paragraph(1), "en", "b", 1),
        (7, "Ünïcode text \U0001f600 " * 30, "fr", "é", 2), (8, "x", "en", "\U0001f600", 1),
        *((10 + i, f"{PARAGRAPH}\n{paragraph(10 + i)}\n  {PARAGRAPH.upper()}\t", "en", "a", 9) for i in range(6)),
    ]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    """The rows above with extra columns whose names the operators use themselves."""
    kinds = CLASHING.split(", ")
    values = tuple("z" if k.endswith("string") else 1 for k in kinds)
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
    return spark.createDataFrame([(*row, *values) for row in edge_rows], schema)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
