import random
import string

import pytest

from stratamart.llm.common import importable

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, simhash string, label string"


def words(rng, n, size=60):
    return " ".join(f"{rng.choice(string.ascii_letters)}w{rng.randrange(size)}" for _ in range(n))


def awkward(rng):
    """Texts with shared passages, copies, odd white space, signs and one very long text."""
    passage, common = words(rng, 30, 500), "All rights reserved here."
    texts = [words(rng, rng.randrange(0, 80), 400) + "\n" + common for _ in range(24)]
    texts += [f"{words(rng, 15, 400)} {passage} {words(rng, 9, 400)}" for _ in range(5)]
    texts += [texts[0], texts[0], passage, "", "   \n ", "É l'ÉTÉ  x y z 日本 👍", "*** | !!", words(rng, 5000, 3000), "a" * 4000]
    return texts


@pytest.fixture(scope="session")
def rows():
    rng = random.Random(11)
    texts = awkward(rng)
    out = [(i * 3, t, "en", f"s{i % 12}", len(t), "clash", "clash", None) for i, t in enumerate(texts)]
    rng.shuffle(out)
    out.append(out[0])  # a repeated row
    out.append((500, None, None, None, None, None, None, None))
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    importable(spark)
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    importable(spark)
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def nameless(spark):
    importable(spark)
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(None, text, "en", "s1", 1, "", "", ""), (7, text, "en", "s1", 1, "", "", ""), (None, "alone in here", None, None, None, "", "", "")]
    return spark.createDataFrame(rows, SCHEMA)
