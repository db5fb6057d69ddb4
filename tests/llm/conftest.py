import pytest

# Texts that every operator on documents must take: null, empty, white space,
# ties and copies, one very long text, odd characters.
TEXTS = [
    "the quick brown fox jumps over the lazy dog again and again",
    "the quick  brown\tfox jumps over the lazy dog again and again",
    "The quick brown fox jumps over the lazy dog again and again",
    None,
    "",
    " \n\t ",
    "one",
    "one two",
    "don't <|endoftext|> stop, İstanbul; été ΣΑΣ 日本語 12,345 x́ \x00\x1c!",
    "word " * 30_000 + "end",
    "word " * 30_000 + "END",
    "the quick brown fox jumps over the lazy dog again and again",
]


@pytest.fixture()
def odd_docs(spark):
    """Odd texts under unordered ids, one row repeated, one id null; extra columns with clashing names."""
    rows = [(10 * (len(TEXTS) - i), t) for i, t in enumerate(TEXTS)] + [(120, TEXTS[0]), (None, "no id at all here")]
    rows = [(i, t, "x", 7, f"{i}") for i, t in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, grp string, n long, id string").repartition(3)


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


def collected(df, *cols):
    """Sorted list of tuples; nulls first."""
    out = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((v is not None, v) for v in t))
