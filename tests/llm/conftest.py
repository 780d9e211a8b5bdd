import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(r: random.Random, n: int) -> str:
    return " ".join(r.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu".split()) + str(r.randint(0, 60)) for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """Documents with nulls everywhere, empty and long texts, copies, near copies, ties and repeated rows."""
    r = random.Random(5)
    out = [(i, words(r, r.randint(1, 60)), r.choice(["en", "de", None]), r.choice(["a", "b", "c.de", None, ""]), i) for i in range(40)]
    base = words(r, 40)
    for i in range(40, 70):  # near copies, chained
        w = base.split()
        for _ in range(r.randint(0, 3)):
            w[r.randrange(len(w))] = "new" + str(r.randint(0, 9))
        out.append((i, " ".join(w), "en", "a", 1))
    out += [(70 + i, base, "en", "a", 1) for i in range(5)]
    out += [(80, None, None, None, None), (81, "", "en", "a", 0), (82, " \n\t ", "fr", "b", 4), (None, base, "en", "a", 3), (None, None, None, None, None)]
    out += [(83, words(r, 6000), "en", "hot", 5), (84, "one two", "en", "a", 7), (85, "ONE  two", "en", "a", 7), (86, "x" * 30000, "en", "a", 1)]
    out += [out[3], out[3]]
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
