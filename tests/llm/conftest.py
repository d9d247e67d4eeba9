import random
import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, row string, s string"


def words(text):
    return WORD.findall((text or "").translate({65 + i: 97 + i for i in range(26)}))


def prose(rng, n):
    return " ".join("".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Rows with nulls everywhere, copies, near copies, repeated rows, long and empty texts."""
    rng = random.Random(5)
    texts = [prose(rng, rng.randint(1, 120)) for _ in range(60)]
    near = texts[7].split() or ["x"]
    texts += [texts[3]] * 12 + [" ".join([*near[:-1], "changed"]), texts[5].upper(), None, "", "  \n\t ", "one", "one",
              "One two three four", "a b c d e " * 9000, "\n".join([prose(rng, 9)] * 3), "é ü 😀 <|endoftext|> x",
              "shared passage of the corpus " + prose(rng, 40), "shared passage of the corpus " + prose(rng, 40)]
    rows = [(i, x, rng.choice(["en", "de", None]), rng.choice(["a", "b", None]), len(x or ""), 3, "r", "t")
            for i, x in enumerate(texts)]
    return [*rows, rows[0], (None, texts[1], None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]


@pytest.fixture
def docs(spark, corpus, tmp_path):
    path = str(tmp_path / "documents")
    spark.createDataFrame(corpus, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
