import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng: random.Random, n: int, vocabulary: int = 3000) -> str:
    """n invented words in sentences and lines, one in four a function word."""
    common = ["the", "of", "and", "to", "in", "is"]
    out = []
    for i in range(n):
        w = rng.choice(common) if rng.random() < 0.25 else f"w{rng.randrange(vocabulary)}x"
        out.append(w + (".\n" if i % 17 == 16 else ""))
    return " ".join(out).replace("\n ", "\n")


def tricky_rows() -> list[tuple]:
    """Nulls in every column, empty and long texts, odd blanks, repeated rows,
    repeated ids, near copies, shared passages."""
    rng = random.Random(7)
    base = [prose(rng, rng.randrange(60, 220)) for _ in range(24)]
    passage = prose(rng, 70)
    rows = [(i, t, "en", f"s{i % 5}", len(t)) for i, t in enumerate(base)]
    rows += [(100 + i, base[3], "en", "s1", None) for i in range(6)]  # exact copies
    for i in range(6):  # near copies
        words = prose(random.Random(50), 400).split(" ")
        words[11 * i] = f"edit{i}"
        rows.append((200 + i, " ".join(words), "en", "s0", 0))
    rows += [(300 + i, prose(rng, 80) + "\n" + passage + "\n" + prose(rng, 80), "en", "s2", 1) for i in range(5)]
    rows += [
        (400, None, None, None, None),
        (401, "", "en", "s1", 0),
        (402, " \t\n\r\x0b\x0c ", "en", None, 7),
        (403, "word", "en", "s3", 4),
        (404, "a b ​\U0001f600 é Été <|endoftext|> \\ <|im_end|>", "fr", "é", 9),
        (405, "the same line\n" * 40, "en", "s1", 5),
        (406, prose(rng, 9000, 200_000), "en", "s4", 1),
        (407, "x" * 30_000, "en", "s4", 1),
        (7, base[7], "en", "s2", len(base[7])),  # a repeated row
        (8, base[9], "en", "s9", None),  # a repeated id
        (None, base[10], "en", "s0", 3),
        (None, None, None, "s0", None),
    ]
    return rows


@pytest.fixture(scope="session")
def tricky(spark):
    return spark.createDataFrame(tricky_rows(), SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def folder(spark, tricky, tmp_path_factory):
    """A table folder as the queries read it, holding the tricky rows."""
    base = str(tmp_path_factory.mktemp("tables"))
    tricky.write.parquet(f"{base}/documents.parquet")
    return base


@pytest.fixture(scope="session")
def empty_folder(spark, empty, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("none"))
    empty.write.parquet(f"{base}/documents.parquet")
    for name, schema in (
        ("labels", "doc_id long, quality int, toxic int"),
        ("pages", "page_id long, url string, html string"),
        ("conversations", "conv_id long, turn long, role string, text string"),
    ):
        spark.createDataFrame([], schema).write.parquet(f"{base}/{name}.parquet")
    return base
