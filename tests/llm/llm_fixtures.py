import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size long, key string, node long, row string, bucket int, "
          "score double, spans string, id long, doc string, position double, secret_spans int, features string")


def prose(rng, words, vocabulary=400):
    return " ".join(rng.choice(VOCABULARY[:vocabulary]) for _ in range(words))


VOCABULARY = ["".join(random.Random(i).choices("abcdefghijklmnop", k=3 + i % 7)) for i in range(400)]


@pytest.fixture(scope="session")
def texts():
    """Originals, exact and near copies, shared passages, empty, null, one-word, repetitive and long texts."""
    rng = random.Random(5)
    out = [prose(rng, rng.randint(30, 160)) + ".\n" + prose(rng, rng.randint(10, 60)) for _ in range(40)]
    out += [out[0], out[0], out[1]]
    for k in range(6):  # near copies: one word changed
        w = out[2].split(" ")
        w[10 + 3 * k] = "changed%d" % k
        out.append(" ".join(w))
    passage = prose(rng, 90)
    out += [prose(rng, 40) + " " + passage + " " + prose(rng, 40) for _ in range(4)]
    out += ["", None, None, "word", "word", " \n\t ", "und " * 400, "the end. " * 30 + passage, prose(rng, 6000), "é ü ß Straße " * 20, "a\nb\nc"]
    return out


@pytest.fixture(scope="session")
def docs(spark, texts):
    """Ids with a null and a repeated row; a hot source and a null one; extra columns whose names the operators use themselves."""
    rows = [(None if i == 7 else i, t, "en", None if i % 11 == 3 else "s%d" % (0 if i % 3 else i % 5), len(t or ""), 1, "k", 2, "r", 3, 0.5, "s", 4, "d", 0.1, 5, "f")
            for i, t in enumerate(texts)]
    rows.append(rows[12])
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
