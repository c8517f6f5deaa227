from __future__ import annotations

import random

import pytest

SYLLABLES = "an the on er re st nd ing ou ha wh ti le de que ion".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, spans string, ids string"


def prose(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="session")
def awkward_rows():
    """Null ids and texts, empty and blank texts, a long one, copies, near copies, shared passages."""
    rng = random.Random(5)
    passage = prose(rng, 30)
    long_text = prose(rng, 6_000)
    near = prose(rng, 120).split()
    texts = [
        None,
        "",
        " \t\n",
        "one",
        "two words",
        passage,
        f"{prose(rng, 20)} {passage} {prose(rng, 20)}",
        f"{passage}{passage}",
        long_text,
        long_text[:9_000] + " changed " + long_text[9_000:],
        "x" * 400,
        "y" + "x" * 300,
        "é日本▁ 🙂" * 30,
        'token = "0123456789abcdef0123456789" AKIA' + "A1" * 9 + " Password:  hunter2.x",
    ]
    texts += [" ".join([*near[:i], "other", *near[i + 1 :]]) for i in range(0, 30, 3)]
    texts += [prose(rng, rng.randint(5, 80)) for _ in range(12)]
    rows = [
        (i, t, ("en", "de", None)[i % 3], f"src{i % 7}" if i % 5 else None, None if t is None else len(t), "s", "i")
        for i, t in enumerate(texts)
    ]
    rows += [rows[5], rows[8], (None, passage, "en", "src1", 3, None, None), (None, None, None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def awkward(spark, awkward_rows):
    return spark.createDataFrame(awkward_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
