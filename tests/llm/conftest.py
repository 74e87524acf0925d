import pytest

from llm_texts import prose


@pytest.fixture
def odd_rows():
    """Documents with every oddity: nulls, empty and blank texts, a long one, ties, repeated rows, a null id."""
    long = prose(20_000, 1)
    return [
        (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, long), (6, prose(80, 2)), (7, prose(80, 2)), (8, prose(80, 3)), (8, prose(80, 3)),
        (None, prose(60, 4)), (None, None), (9, "Añb ⟨x⟩ \U0001F600 <|endoftext|> it's 12%  　z"), (10, "a\x00b c\x1cd"), (11, "x " * 500),
    ]


@pytest.fixture
def frame(spark):
    """Documents with extra columns whose names clash with those the operators use inside."""
    def make(rows):
        schema = "doc_id long, text string, row string, text_hash int, word string, bucket int, part int, runs string, found string, node int, n_chars long"
        return spark.createDataFrame([(i, t, "r", 1, "w", 2, 3, "u", "f", 4, None if t is None else len(t)) for i, t in rows], schema)

    return make
