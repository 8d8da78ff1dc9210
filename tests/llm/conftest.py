"""Small tables with the odd cases that every operator has to stand."""

import random

import pytest

#: Names that clash with columns the operators use inside.
CLASHING = ["ids", "decoded", "digest", "vid", "tid", "key", "row", "score", "copies", "copy", "root", "label", "x", "h",
            "signature", "bucket", "packed", "spans", "kind", "shuffle_key", "__rate", "__source", "predicted", "kept"]


def words(n, seed):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 7))) for _ in range(n))


def odd_rows():
    base = words(90, 1)
    changed = base.split()
    changed[40] = "zzzz"
    return [
        (1, base), (2, base), (2, base), (3, " ".join(changed)), (4, base.upper().replace(" ", "\n\t ")),
        (5, None), (6, ""), (7, " \n\t "), (8, "one two three"), (9, "one  two three"), (10, "one two three four five"),
        (11, words(6000, 2)), (12, "a" * 5000), (13, "ab " * 900), (14, "été " * 70 + base), (None, base), (None, "alone"),
        (15, words(60, 3) + " " + base[:260]), (16, "<|endoftext|> x"), (17, "漢字 🙂 ñandú"), (18, words(300, 4)),
        (19, words(300, 4)), (20, "x"), (-3, words(40, 5)), (20, "another text with one id"),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark):
    rows = [(i, t, ["en", None, "de"][n % 3], [None, "a", "a", "a", "b"][n % 5], None if t is None else len(t),
             *[f"{n}{c}" for c in CLASHING]) for n, (i, t) in enumerate(odd_rows())]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame(rows, schema).repartition(3).persist()


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
