import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def article(seed, n=80, lang="en"):
    rng = random.Random(seed)
    parts = {"en": "th er on an re he in ed nd ha at en es of", "fr": "le de un tion eau ou ai ch eux re la"}[lang].split()
    word = lambda: "".join(rng.choice(parts) for _ in range(rng.randint(1, 4)))
    return ". ".join(" ".join(word() for _ in range(10)).capitalize() for _ in range(-(-n // 10))) + "."


def edited(text, seed, share):
    rng = random.Random(seed)
    return " ".join("xq%d" % rng.randint(0, 10**6) if rng.random() < share else w for w in text.split(" "))


@pytest.fixture(scope="session")
def odd_texts():
    """Texts at the edges: null, empty, blank, ties, repeats, very long, beyond ASCII."""
    long = " ".join(f"word{i % 9_001}" for i in range(120_000))
    return [
        None, "", " \n\t ", "one", "one two three", "One TWO three", "a b c d", "A b c d", "É é É é", "é é é é", "x" * 300_000, long, long + " end", "同 文 字 列 五",
        "l1\nl1\n\nl1 \nl2\r\nl2\r\n", "# $ %% && | <b>", "\x00 \x1f \x7f \x80 ok", "tab\tsep\x0bvt\x0cff\rcr", "😀 😀 😀 😀 😀",
    ]


@pytest.fixture(scope="session")
def docs(spark, odd_texts):
    """Clean, copied, edited and odd documents with one repeated row and a null key."""
    rows = [article(i, 60 + 7 * i) for i in range(20)]
    rows += [article(100 + i, 90, "fr") for i in range(8)]
    rows += [rows[3], rows[3].upper(), edited(rows[4], 1, 0.01), edited(rows[5], 2, 0.03), edited(rows[5], 3, 0.03), edited(rows[6], 4, 0.3)]
    rows += odd_texts
    table = [(i * 3, t, "fr" if 20 <= i < 28 else None if i % 11 == 0 else "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(rows)]
    return spark.createDataFrame(table, DOCS).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
