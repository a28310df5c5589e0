import pytest

LONG = "ab cd. " * 40_000


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls in every column, empty and very long texts, ties,
    repeated rows, and extra columns whose names the operators use inside."""
    rows = [
        (1, "One two three four five.\nSix seven.", "en", "a", 10),
        (2, "One two three four five.\nSix seven.", "en", "b", 10),
        (3, None, None, None, None),
        (4, "", "en", "a", 0),
        (5, LONG, "en", "a", len(LONG)),
        (None, "no id here", "en", "b", 10),
        (None, None, None, None, None),
        (6, " \t\n ", "en", None, 4),
        (7, "é ü 中文 😀 x", "fr", "c", 9),
        (7, "é ü 中文 😀 x", "fr", "c", 9),
        (8, "tie one", "en", "b", 7),
        (8, "tie two", "en", "b", 7),
    ]
    extra = "_file string, _row int, fp long, id int, bit int, node int, part int, guest int, digest string, words int, shard int, score double, key string"
    blank = ("x", 1, 2, 3, 4, 5, 6, 7, "y", 8, 9, 0.5, "z")
    return spark.createDataFrame([r + blank for r in rows], "doc_id long, text string, lang string, source string, n_chars long, " + extra)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.filter("false")
