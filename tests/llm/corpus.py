"""Small corpora with the awkward cases every operator has to stand."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def prose(rng, n):
    text = words(rng, n)
    return "\n".join(" ".join(text[i : i + 9]) for i in range(0, n, 9))


def awkward(rng):
    """Nulls, nothing, blanks, one word, a very long text, repeated rows."""
    long = prose(rng, 30_000)
    return [
        (None, "text without id " * 30, "en", None, None),
        (900, None, None, None, None),
        (901, "", "en", "s", 0),
        (902, " \n\t ", "en", "s", 4),
        (903, "word", "en", "s", 4),
        (904, long, "en", "s", len(long)),
        (905, "one two three", None, "s", 13),
        (905, "one two three", None, "s", 13),
    ]


def frame(spark, rows, schema=SCHEMA, extra=True):
    """Rows as documents; ``extra`` adds columns named like those the operators make."""
    df = spark.createDataFrame(rows, schema)
    if extra:
        for name in ("score", "set_id", "key", "n", "spans", "component_id", "rank"):
            df = df.selectExpr("*", f"'x' AS {name}")
    return df.repartition(3)


def seeded(seed=1):
    return random.Random(seed)
