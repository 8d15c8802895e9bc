"""Tables that the tests share, as fixtures to import, and helpers to compare rows."""

import os
import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parents[2]
sys.path[:0] = [str(ROOT), str(Path(__file__).resolve().parent)]
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), os.environ.get("PYTHONPATH", "")])

FOLDER = "/root/testdata/sf0.001"
WORDS = [f"w{i}" for i in range(400)]


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    yield connection
    connection.close()


@pytest.fixture(scope="session")
def documents(duck):
    return duck.execute("SELECT doc_id, text FROM documents").fetchall()


def passage(start, n):
    return " ".join(WORDS[start : start + n])


#: Nulls, empty and wordless texts, repeated rows, ties, odd white space, a very long text, overlapping passages.
HARD = [
    (1, passage(0, 120)),
    (2, passage(0, 120)),
    (2, passage(0, 120)),
    (3, "intro " + passage(20, 80) + " outro"),
    (4, passage(300, 60) + " x " + passage(0, 49)),
    (5, passage(300, 60) + " y " + passage(0, 50)),
    (6, None),
    (7, ""),
    (8, " \n\t\x0b "),
    (9, "one two"),
    (10, "ONE  two"),
    (11, "été naïve ß\u00a0nbsp 漢字 😀 " * 30),
    (12, "été naïve ß\u00a0nbsp 漢字 😀 " * 30),
    (None, passage(0, 120)),
    (None, None),
    (-5, passage(100, 70)),
    (13, " ".join(f"long{i % 977} {i}" for i in range(60_000))),
    (14, "start " + " ".join(f"long{i % 977} {i}" for i in range(60_000))),
    (15, "a" * 300_000),
]


@pytest.fixture(scope="session")
def hard(spark):
    """The rows of HARD, with columns whose names the operators use themselves."""
    rows = [(d, t, "en", "s", 1, "x", 2) for d, t in HARD]
    kinds = "doc_id long, text string, lang string, source string, n_chars long, anchor string, n long"
    return spark.createDataFrame(rows, kinds).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def whole(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def same(found, wanted):
    assert found == sorted(map(tuple, wanted), key=repr)
