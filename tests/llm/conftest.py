import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words long, score double, shard int"


def make_rows(seed=5):
    """Texts with copies, near copies, shared passages, odd white space and other alphabets, nulls and a long one."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeghiéß日") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    say = lambda n: [rng.choice(words) for _ in range(n)]
    passage = say(70)
    texts = [None, "", "   \n\t", "One", "one", "a b c d", "A B c D", "x" * 3000]
    for _ in range(30):
        own = say(rng.randint(8, 160))
        texts.append(" ".join(own))
        if rng.random() < 0.5:
            near = list(own)
            near[rng.randrange(len(near))] = "changed"
            texts.append("\n".join(" ".join(near[i:i + 9]) for i in range(0, len(near), 9)))
        if rng.random() < 0.4:
            texts.append(" ".join([*say(rng.randint(0, 30)), *passage, *say(rng.randint(0, 30))]))
        if rng.random() < 0.3:
            texts.append(texts[-1])
    texts.append("\n".join(" ".join(say(12)) for _ in range(400)))
    texts.append("same line here\nsame line here\n" * 20)
    texts.append("key: password=" + "ab12" * 5 + " AKIA" + "Q7" * 8 + " then 0123456789abcdef0123456789abcdef end <|endoftext|>\xa0 end")
    rng.shuffle(texts)
    rows = [(3 * i + 1, t, "en", f"s{i % 3}", 7, 7, 0.5, 1) for i, t in enumerate(texts)]
    return rows


@pytest.fixture(scope="session")
def rows():
    return make_rows()


@pytest.fixture(scope="session")
def documents(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def odd(spark):
    """Null and repeated ids, repeated rows, and clashing columns."""
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(None, text), (None, None), (5, text), (5, text), (5, "other " + text), (9, text), (2, None), (2, "")]
    return spark.createDataFrame([(a, b, "en", None, None, None, None, None) for a, b in rows], SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark, rows):
    return spark.createDataFrame([(r[0], int(i % 4 != 0), int(i % 7 == 0), "x") for i, r in enumerate(rows)] + [(None, 1, 1, "x"), (4, None, None, "y")],
                                 "doc_id long, quality int, toxic int, text string")
