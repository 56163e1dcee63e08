import pytest

# Names that operators use inside, to clash with theirs.
EXTRA = "kept string, key string, block string, bits string, row string, n string, topic string"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"

PROSE = (
    "The of and to in a is that for it as was with be by on not he his but at are this have from "
    "or an they which one you were all her she there would their we him been has when who will. "
)


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), *["x"] * 7)


LONG = " ".join(f"word{i % 7919}x{i % 31}" for i in range(60_000))
ODD = [
    row(1, None),
    row(2, ""),
    row(3, " \t\n\x0b\x0c\r "),
    row(4, "one"),
    row(5, "one"),
    row(5, "one"),
    row(6, "ONE"),
    row(None, "one two three four five six"),
    row(None, None, None, None),
    row(7, LONG),
    row(8, LONG + " tail"),
    row(9, "12345 !!! ..."),
    row(10, "Zwölf Boxkämpfer jagen Viktor quer über den großen Sylter Deich", "de", None),
    row(11, PROSE * 3, None, "b"),
    row(12, "a\x00b   \U0001f926\U0001f3fd é", "en", ""),
    row(1 << 62, PROSE * 2, "", "a"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and further columns."""
    return spark.createDataFrame(ODD, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
