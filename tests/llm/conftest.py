import random

import pytest

WORDS = "alpha beta gamma delta the of and river stone Über naïve 北京 x1 y2 License under cc by token".split()


def make_rows(seed: int, n: int) -> list[tuple]:
    """(doc_id, text, source) with copies, near copies, shared passages, blanks, nulls and repeats."""
    r = random.Random(seed)
    say = lambda k: " ".join(r.choice(WORDS) + r.choice(["", "", "s", "ed", "q%d" % r.randrange(50)]) for _ in range(k))
    passage = say(60)
    rows: list[tuple] = []
    for i in range(n):
        kind = r.randrange(10)
        if rows and kind == 0:
            text = r.choice(rows)[1]
        elif rows and kind in (1, 2):
            words = (r.choice(rows)[1] or "a").split(" ")
            words[r.randrange(len(words))] = "changed%d" % i
            text = " ".join(words)
        elif kind == 3:
            text = say(r.randrange(30)) + "\n" + passage + " " + say(r.randrange(30))
        else:
            text = say(r.randrange(1, 90))
        rows.append((i * 3 + r.randrange(3), text, "s%d" % r.randrange(4)))
    rows += [(9001, None, "s1"), (9002, "", None), (9003, " \n\t ", "s2"), (9004, "one", "s0"), (None, "no id here at all", "s1"), rows[0], rows[0]]
    rows.append((9005, "long " + say(4000), "s3"))
    return rows


SCHEMA = "doc_id long, text string, source string"


@pytest.fixture(scope="session")
def rows():
    return make_rows(7, 120)


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
