import pytest

LONG = "Thndou oned haing, and erhaha. " * 4_000


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls, blanks, a very long text, repeated rows, and columns named as the operators name theirs."""
    rows = [
        (1, "The quick brown fox, jumps over 3 dogs.\nAnd more!"),
        (1, "The quick brown fox, jumps over 3 dogs.\nAnd more!"),
        (2, None),
        (3, ""),
        (4, " \t\n  "),
        (None, "no id here, é日本🙂"),
        (None, None),
        (5, LONG),
        (6, "x" * 100_000),
        (7, "password = \"abcdefgh12\" and mail a.b@c.example.com now"),
        (8, "tab\tand  two spaces   \x1c <|endoftext|> end "),
    ]
    values = [(i, text, None if i == 2 else "en", 1, "t", "f", 0.5, "k", 3, None) for i, text in rows]
    fields = "doc_id bigint, text string, lang string, n_chars bigint, _text string, fp string, score double, key string, start int, spans string"
    return spark.createDataFrame(values, fields)


@pytest.fixture
def no_docs(messy):
    return messy.filter("doc_id < 0")
