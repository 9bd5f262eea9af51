import pytest

#: Null, empty, blank and long texts, repeated rows, repeated and null ids, and columns named like the operators' own.
AWKWARD = [
    (1, "The quick brown fox jumps over the lazy dog."),
    (1, "The quick brown fox jumps over the lazy dog."),
    (2, None),
    (3, ""),
    (4, " \t\r\n\v\f "),
    (5, "é漢字   naïve \U0001f600 İİ ſK ß"),
    (None, "no id here"),
    (6, "a b " * 9_000 + "end"),
    (7, "x" * 30_000),
]


@pytest.fixture(scope="session")
def awkward(spark):
    rows = [(*r, "en", "s", 1, "c", "p", 0.5) for r in AWKWARD]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, cell string, piece string, score double"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.where("false")


#: Ids at the ends of their range, and names that helper columns had or have.
EDGES = (-(2**63), 2**62 + 5, 2**63 - 1)
CLASHES = ["_id", "_digest", "_chosen", "_of", "_times", "__drop", "__drop_id", "drop", "drop_of", "own_id", "own_digest",
           "chosen_id", "chosen_digest", "chosen_times", "Drop_", "score", "toxic", "print", "of", "rate", "times"]


@pytest.fixture(scope="session")
def clashing(spark):
    """Copies of a few texts under edge ids, no id, and one id twice, with columns named like helpers."""
    long_line = "a line that several documents share, long enough to be counted"
    texts = [f"{long_line}\nown words of text number {i} and nothing else in here" for i in range(6)]
    rows = [(i, texts[i % 6]) for i in (0, 1, 2, 3, 4, 5, 6, 7)] + [(i, texts[k]) for k, i in enumerate(EDGES)]
    rows += [(None, texts[0]), (None, texts[4]), (3, "another text of the same id, which is no copy at all"), (9, None), (10, "")]
    data = [(i, t, "en", "s", len(t or ""), *(f"{c}{n}" for c in CLASHES)) for n, (i, t) in enumerate(rows)]
    fields = ", ".join(f"`{c}` string" for c in CLASHES)
    return spark.createDataFrame(data, f"doc_id bigint, text string, lang string, source string, n_chars bigint, {fields}")


def pairs(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
