"""Small tables for the operator tests."""

import random

WORDS = ("stone river cloud lamp green seven walk under bright table voice paper north field window "
         "carry silver early garden music road water light small house tree bird open hand letter").split()


def prose(seed: int, n: int) -> str:
    """``n`` words in sentences of 6 to 12 words."""
    rnd = random.Random(seed)
    out = []
    while sum(map(len, out)) < n:
        s = [rnd.choice(WORDS) + str(rnd.randrange(40)) * (rnd.random() < 0.3) for _ in range(rnd.randint(6, 12))]
        s[0], s[-1] = s[0].capitalize(), s[-1] + "."
        out.append(s)
    return " ".join(w for s in out for w in s)


def documents(spark, rows):
    """(doc_id, text) rows with extra columns whose names operators use inside."""
    return spark.createDataFrame(
        [(i, t, "x", 1.5, b"y", 7) for i, t in rows],
        "doc_id long, text string, lang_pred string, score double, ids binary, k long")


def empty(spark):
    return documents(spark, [])
