import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, kept int, bucket long, _doc int"
VOCABULARY = "der die und ist le la les une the of and in el los una que être über señor façade".split()


def words(rng, count):
    return [rng.choice(VOCABULARY) + rng.choice(["", "a", "en", "o", "ß"]) + str(rng.randrange(40)) for _ in range(count)]


@pytest.fixture(scope="session")
def texts():
    """Awkward texts: nulls, no words, copies, near copies, shared and repeated passages, a very long one."""
    rng = random.Random(5)
    base, passage = words(rng, 120), words(rng, 70)
    near = [*base]
    near[60] = "changed"
    loop = words(rng, 25) * 4
    long_text = words(rng, 30_000)
    return [
        None,
        "",
        " \t\r\n\x0b\x0c ",
        "one",
        "one two three",
        "ONE  two\nthree",
        " ".join(base),
        " ".join(base),
        "\n".join(base),
        " ".join(near),
        " ".join(words(rng, 30) + passage + words(rng, 9)),
        " ".join(words(rng, 3) + passage + words(rng, 40)),
        "  " + " ".join(passage) + "\n",
        " ".join(loop),
        " ".join(long_text),
        " ".join(long_text[:20_000] + words(rng, 50)),
        "%%% ### 12 ... ''' \x00 \x1c   ",
        "Ünï cödé \U0001f600 日本語 é <|endoftext|> don't",
        " ".join(words(rng, 49)),
        None,
    ]


@pytest.fixture
def documents(spark, texts):
    """Documents with extra columns of clashing names, hot source, null source, lang and doc_id, repeated rows."""
    rows = [
        (i, text, [None, "de", "en", "fr"][i % 4], "hot" if i % 3 else [None, "b", "a"][i % 9 // 3], None, "x", 1, 2, 3)
        for i, text in enumerate(texts)
    ]
    rows += [rows[6], rows[10], (None, "no id at all", "en", "hot", 1, "x", 1, 2, 3)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], DOCS)
