"""The DuckDB statements against the queries, on small tables with awkward rows and on the given ones."""

import random

import duckdb
import pytest
from tables import awkward_rows, documents, prose, rows, save

from foralytics.llm.queries import ORACLE, QUERIES

GIVEN = "/root/testdata/sf0.001"


def passages(seed):
    """Texts that share passages of over 50 words, near copies, and texts of repeated words."""
    random.seed(seed)
    shared = [prose(seed * 10 + k, random.randint(50, 70)) for k in range(4)]
    out = []
    for i in range(70):
        parts = [prose(1000 * seed + 10 * i + k, random.randint(0, 40)) for k in range(2)]
        text = f"{parts[0]} {random.choice(shared)} {parts[1]}" if i % 2 else parts[0] + " again and" * random.randint(0, 9)
        out.append((200 + i, text, "en", random.choice(["a", "b", None])))
        if i % 5 == 0:
            out.append((400 + i, text.replace("lorem", "l0rem", 1), "en", "b"))
    return out


def compared(spark, name, folder, files):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{files}'")
    wanted = con.sql(ORACLE[name])
    found = QUERIES[name](spark, folder)
    # Any other column that the query returns is in the statement too.
    assert sorted(found.columns) == sorted(wanted.columns)
    return rows(found.select(*wanted.columns)), sorted(wanted.fetchall(), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_given_table(spark, name):
    found, wanted = compared(spark, name, GIVEN, f"{GIVEN}/documents.parquet")
    assert found == wanted and len(found) == 200


@pytest.mark.parametrize("name", sorted(set(ORACLE) - {"op8_mixing"}))
def test_awkward_rows_and_passages(spark, tmp_path, name):
    table = [r for r in awkward_rows() if r[0] != 3] + passages(len(name))
    folder = save(documents(spark, table, extra=True), tmp_path)
    found, wanted = compared(spark, name, folder, f"{folder}/documents.parquet/*.parquet")
    assert found == wanted
