"""Small tables with everything that a corpus may hold."""

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, digest string, `class` string, row string, "
    "score string, td_key string, key string, copy string, mix_key string, kept string, `a.b` string"
)
EXTRA = ("x",) * 10


def frame(spark, docs, source="s"):
    """(doc_id, text) as documents with extra columns whose names clash with everything."""
    rows = [(i, t, "en", source, len(t or ""), *EXTRA) for i, t in docs]
    return spark.createDataFrame(rows, SCHEMA)


def words(rng, n, vocabulary=2000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def odd(seed=0):
    rng = random.Random(seed)
    same = words(rng, 40)
    return [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, "One two"),
        (4, "One two"),
        (None, same),
        (6, same),
        (7, same.upper()),
        (None, None),
        (9, words(rng, 60_000)),
        (10, "é ß 漢字 👍 \x00 \\ ' \" `"),
        (11, "a" * 100_000),
    ]
