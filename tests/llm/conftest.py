import random
import re

import pytest

EXTRA = {"lang": "en", "source": "s", "n_chars": 1, "score": 0.5, "label": 1, "rank": 1, "word": "w", "n": 1, "fp": 1, "key": 1, "size": 1, "row": 1, "range": 1, "shard": 1, "items": "i", "text_crc32": 1, "held_out": True}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, label int, rank int, word string, n long, fp long, key long, size long, row long, range int, shard int, items string, text_crc32 long, held_out boolean"


def prose(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(words))


def plain_words(text, pattern=r"[^\x20\x09-\x0D]+"):
    return re.findall(pattern, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def frame(spark, rows):
    """Documents with many more columns, whose names the operators use inside."""
    return spark.createDataFrame([(i, t, *EXTRA.values()) for i, t in rows], SCHEMA)


@pytest.fixture(scope="session")
def edge_rows():
    """Null, empty, blank, short, long, odd, repeated and near-copied texts; repeated rows; a row without an id."""
    rng = random.Random(5)
    base = prose(rng, 120)
    near = base.split()
    near[60] = "changed"
    rows = [(0, base), (1, None), (2, ""), (3, " \n\t "), (4, "One two"), (5, "§§ 123 !!"), (6, prose(rng, 9000)), (7, base), (8, " ".join(near)), (9, base.upper()), (10, "x" * 30000), (11, "a\x00b ünïcödé ☃ ▁ end"), (12, "ends with blank "), (13, prose(rng, 300)), (13, "same id, another text")]
    rows += [(14, "One two"), (14, "One two"), (None, "a row without an id"), (15, "idiot idiot. fine"), (16, "<|endoftext|> <|ENDOFTEXT|> It's 12 o'clock")]
    rows += [(20 + i, prose(rng, rng.randint(1, 60))) for i in range(30)]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return frame(spark, edge_rows).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
