import random

import pytest

WORDS = "the of and harbour loaf salt clock valley net gulls bridge dawn été grün niño 7 x9".split()


def sentence(rnd, n):
    return " ".join(rnd.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Texts with copies, near copies, shared passages, ties, empties, nulls,
    very long and odd ones, as (doc_id, text)."""
    rnd = random.Random(5)
    unique = lambda n: " ".join(f"{rnd.choice(WORDS)}{rnd.randrange(400)}" for _ in range(n))
    texts = [unique(rnd.randrange(1, 120)) for _ in range(60)]
    long = unique(4000)
    passage = unique(60)
    near = unique(100).split()
    texts += [long, long + " end", passage, "intro " + passage + " outro " + passage, unique(30) + passage + unique(30)]
    texts += [texts[3]] * 4 + [texts[4].upper()]
    for i in range(12):
        copy = list(near)
        copy[i * 7 % 100] = f"edit{i}"
        texts.append(" ".join(copy))
    texts += [None, "", "", "  \n\t ", "a", "a", "aa" * 400, "ab" * 300, "xyz " * 200, "😀漢字 " * 60, "one two three four"]
    rows = list(enumerate(texts))
    rows += [(7, texts[7]), (7, texts[7]), (8, "another text under an id that is taken"), (None, texts[9]), (None, None), (None, unique(40))]
    return rows


@pytest.fixture()
def frame(spark):
    def make(rows, extra=True):
        df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
        if extra:  # columns whose names operators use themselves
            for name in ("k", "h", "row", "score", "nth", "found", "_found", "ids", "seen", "cls", "head", "decoded"):
                df = df.selectExpr("*", f"'{name}' AS {name}")
        return df
    return make
