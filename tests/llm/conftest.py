from __future__ import annotations

import itertools

import pytest

WORDS = ["alpha", "beta", "gamma", "delta", "omega", "Sigma", "été", "kappa"]
#: Extra columns whose names the operators use themselves.
CLASHING = "_file string, _row long, digest string, size long, rank long, n long, kept boolean, fp long, query string"


def sentence(seed: int, count: int) -> str:
    return " ".join(WORDS[(seed * 7 + i * i + i * seed) % len(WORDS)] + str((seed * 13 + i) % 23) for i in range(count))


def tricky_rows() -> list[tuple]:
    """Nulls in every column, empty and long texts, ties, near copies and repeated rows."""
    base = sentence(3, 120)
    rows = [
        (1, base, "en", "a", 1),
        (2, base, "en", "a", 1),
        (3, base + " tail", "en", "b", 1),
        (4, None, None, None, None),
        (5, "", "de", "b", 0),
        (6, " \t\n", "de", "b", 3),
        (None, sentence(5, 40), "fr", "c", 9),
        (None, sentence(5, 40), "fr", "c", 9),
        (7, sentence(6, 30_000), "en", "a", 9),
        (8, "x" * 150_000, "en", "c", 9),
        (9, "mail jo.81@mail7.example.com or +1 (377) 555-0271, card 4539 1488 0343 6467, host 97.51.17.173", "en", "c", 9),
        (9, sentence(9, 60), "en", "é", 9),
        (9, sentence(9, 60), "en", "é", 9),
    ]
    rows += [(100 + i, sentence(20 + i % 17, 10 + 9 * (i % 5)), "en", "abcz"[i % 4], 5) for i in range(60)]
    return rows


@pytest.fixture
def tricky(spark, tmp_path):
    """The tricky documents over several files, read back."""
    columns = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
    extra = ("f", 0, "d", 1, 1, 1, True, 1, "q")
    frame = spark.createDataFrame([row + extra for row in tricky_rows()], columns)
    frame.repartition(3, "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    return spark.read.parquet(f"{tmp_path}/documents.parquet")


@pytest.fixture
def table(spark, tmp_path):
    """Write rows as a table and read it back."""
    number = itertools.count()

    def build(rows: list[tuple], columns: str, files: int = 2):
        path = f"{tmp_path}/table{next(number)}"
        spark.createDataFrame(rows, columns).repartition(files).write.parquet(path)
        return spark.read.parquet(path)

    return build


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
