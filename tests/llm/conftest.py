import random

import pytest

WORDS = "the of and to in quick brown fox jumps over lazy dog river stone light cloud seven eight market street window garden".split()
EXTRA = "doc_id long, text string, lang string, source string, n_chars long, kept string, score string, ids string, k long, _t string, _h long, class_id string"


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """Awkward texts: copies, near copies, shared passages, empty, null, white space only, wide characters, one long."""
    rng = random.Random(5)
    base, passage = prose(rng, 120), prose(rng, 60)
    near = base.split()
    near[50] = "changed"
    out = [base, None, "", base, " ".join(near), prose(rng, 30) + " " + passage + "\n" + prose(rng, 20), passage + " " + prose(rng, 9), " \t\n ", "a"]
    out += ["é ü ñ 日本語 😀 ▁ x", passage + " " + passage, base, "", None, prose(rng, 3), "same words here now " * 40, prose(rng, 9000), prose(rng, 12)]
    return out + [prose(rng, rng.randint(1, 80)) for _ in range(20)]


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts with extra columns of clashing names, a null id and a repeated row."""
    rows = [(i, t, "en", f"s{i % 3}", len(t or ""), "x", "y", "z", 1, "t", 2, "c") for i, t in enumerate(texts)]
    rows.append((None, "row without an id", None, None, None, None, None, None, None, None, None, None))
    return spark.createDataFrame([*rows, rows[0]], EXTRA).repartition(3).cache()


@pytest.fixture(scope="session")
def plain(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3).cache()


@pytest.fixture(scope="session")
def none(docs):
    return docs.limit(0)
