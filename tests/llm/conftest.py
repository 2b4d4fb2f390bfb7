import pytest
from pyspark.sql import functions as F

#: Ids, texts: a null, an empty one, blanks, copies, near copies, a very long text, a repeated row, a row without an id.
WORDS = [f"{a}{b}" for a in ("an", "the", "Quo", "zu", "ée", "ba") for b in ("ta", "ri", "mo", "lin", "Kes", "du")]


def sentence(seed: int, n: int) -> str:
    state, out = seed * 7919 + 1, []
    for _ in range(n):
        state = (state * 1103515245 + 12345) % 2**31
        out.append(WORDS[state >> 8 & 0xFFFF and (state >> 8) % len(WORDS)])
    return " ".join(out)


@pytest.fixture(scope="session")
def cases():
    base = sentence(1, 120)
    near = base.split()
    near[60] = "CHANGED"
    return [
        (1, base), (2, " ".join(near)), (3, base), (4, None), (5, ""), (6, " \n\t"), (7, sentence(2, 300)), (8, "one"), (9, "one"), (10, "two words"),
        (11, "\n".join(sentence(k, 14) for k in range(20, 30))), (12, "\n".join([*(sentence(k, 14) for k in range(25, 30)), sentence(31, 14)])),
        (13, "a" * 3000 + " " + sentence(3, 3000)), (14, sentence(4, 40) + " " + sentence(5, 11) + " " + sentence(6, 30)), (14, sentence(4, 40) + " " + sentence(5, 11) + " " + sentence(6, 30)),
        (15, "<|im_end|> <\\|x|> don't  WE'LL 1234 日本語 🎉 x"), (None, sentence(7, 50)),
    ]


@pytest.fixture(scope="session")
def docs(spark, cases):
    rows = spark.createDataFrame(cases, "doc_id bigint, text string")
    return rows.withColumns({"lang": F.lit("en"), "source": F.lit(None).cast("string"), "n_chars": F.length("text").cast("bigint"), "id": F.lit("clash"), "ids": F.lit(0), "key": F.lit("clash")})


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.limit(0)
