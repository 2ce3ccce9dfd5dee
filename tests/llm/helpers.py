"""Inputs that every operator must survive."""

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "row string, size string, kept string, key string, bin string, id string, hash string, "
    "digest string, fp string, score string, features string, u string, distance string, part string, "
    "`a.b` string"
)
CLASHING = tuple("clash" for _ in range(15))
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda my".split()


def prose(seed, n):
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) + str(pick.randint(0, 400)) for _ in range(n))


def awkward(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing columns."""
    texts = [
        (0, prose(1, 80), "en", "a"), (1, prose(1, 80), "en", "a"), (1, prose(1, 80), "en", "a"),
        (2, prose(2, 90), "en", None), (3, None, "en", "a"), (4, "", None, "b"),
        (None, prose(3, 70), None, None), (None, prose(4, 70), "de", "b"), (None, None, None, None),
        (5, "one", "fr", "b"), (6, " \t\n\x0b ", "fr", "b"), (7, prose(5, 30_000), "en", "a"),
        (8, "same line\n" + prose(6, 60), "en", "a"), (-9, "x" * 100_000, "en", "c"),
    ]
    rows = [(i, t, lang, source, None if t is None else len(t), *CLASHING) for i, t, lang, source in texts]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
