import pytest

from strandline.session import materialize

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    # names that the operators use themselves
    " key long, body string, token string, rank long, score double, _row long, component_id long, part int, kept boolean"
)
LONG = "word" * 3000 + " " + " ".join(f"w{i % 700}" for i in range(30_000))
PARAGRAPH = " ".join(f"common{i}" for i in range(60))


def texts() -> list[tuple]:
    """doc_id, text, lang: nulls in each, empty and long texts, repeated rows, equal ids, near copies."""
    base = [f"alpha{i}" for i in range(50)]
    near = [*base[:48], "other", "end"]
    far = [*base[:30], *(f"beta{i}" for i in range(20))]
    return [
        (1, " ".join(base), "en"), (2, " ".join(base).upper(), "en"), (3, "\n".join(near), None), (4, " ".join(far), "de"),
        (5, "", "en"), (6, None, "en"), (7, " \t\n ", "fr"), (8, "one two", "en"), (9, "One\ttwo", "en"), (10, "one two three four five six", "en"),
        (11, LONG, "en"), (12, LONG + " tail", "en"), (13, PARAGRAPH + " " + " ".join(f"x{i}" for i in range(40)), "en"),
        (14, PARAGRAPH + " " + " ".join(f"y{i}" for i in range(40)), "en"), (15, "é ü ñ  日本語 \u3000 x\u00a0y !!! <|endoftext|> <|im_end|>", "es"),
        (15, "é ü ñ  日本語 \u3000 x\u00a0y !!! <|endoftext|> <|im_end|>", "es"), (15, "another text of the same id", "es"), (None, "no id here at all", "en"),
        (None, "no id here at all", None), (16, "a\n\n\nb   c\n", "en"), (17, "same line here\nsame line here\nother\n", "en"),
        (18, 'api_key = "abcd1234EFGH" and token:secret: abcdefghij AKIA' + "A1B2" * 4 + " " + "0123456789abcdef" * 3, "en"),
        (19, "password=short PASSWD='Zm9vYmFyYmF6cXV4' x", "en"), (20, "line\n" * 200, "en"),
    ]


@pytest.fixture
def docs(spark):
    rows = [(i, t, lang, "s", 0, 7, "b", "t", 3, 0.5, 1, 2, 3, True) for i, t, lang in texts()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def stage():
    return lambda df: materialize(df, "test")
