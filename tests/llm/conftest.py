import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "raw long, hash string, row int, n int, unit string, chunk long, rest string, bucket int, score double, at int, batch string"
)
PROSE = "The river bends twice before the old mill and then runs straight to the harbour wall where boats lie in winter. "


@pytest.fixture(scope="session")
def hard_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns whose names clash with those used inside."""
    long_text = " ".join(f"word{i % 977} tale{i % 13}" for i in range(30_000))
    texts = [
        (1, PROSE + "One ending."),
        (2, None),
        (3, ""),
        (4, " \t\n "),
        (5, long_text),
        (6, long_text + " and a tail"),
        (7, PROSE + "One  ending."),
        (7, PROSE + "One  ending."),
        (8, "uno dos"),
        (9, "uno dos"),
        (None, PROSE + "Another ending of the story, told elsewhere."),
        (None, None),
        (10, "é" * 120 + "12345 !!! ???"),
        (11, "x" + "é" * 120 + "12345 !!! ???"),
        (12, "..."),
    ]
    rows = [(i, t, "en" if i != 10 else None, "s", None if t is None else len(t), 1, "h", 2, 3, "u", 4, "r", 5, 0.5, 6, "b") for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def local_rows():
    """Rows of a frame as dictionaries."""
    return lambda df: [r.asDict(recursive=True) for r in df.collect()]
