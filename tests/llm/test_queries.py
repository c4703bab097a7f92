import glob
import os

import duckdb
import pytest

from cellweave.llm import leakage, lookalike, queries
from tests.helpers import rows, table
from tests.llm.test_lookalike import reference_form

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", queries.QUERIES)
def test_query(spark, duck, name):
    found = queries.QUERIES[name](spark, DATA)
    columns = sorted(found.columns)
    got = table(found.collect(), found.columns, columns)
    if name in queries.SQL:
        wanted = duck.execute(queries.SQL[name])
        names = [d[0] for d in wanted.description]
        assert got == table(wanted.fetchall(), names, columns)


def test_p6_against_brute_force(spark, duck):
    grams = lambda w: {tuple(w[i : i + 13]) for i in range(len(w) - 12)}
    plain = lookalike.rewriter(lookalike.plain_table(lookalike.look_alike_letters(spark)))
    docs = [(d, grams(leakage.cue_words(t, plain))) for d, t in duck.execute("SELECT doc_id, text FROM documents").fetchall()]
    items = [(i, grams(leakage.item_words(t, plain))) for i, t in duck.execute("SELECT item_id, item_text FROM eval_items").fetchall()]
    assert rows(queries.p6_found(spark, DATA), "doc_id", "item_id") == {(d, i) for d, a in docs for i, b in items if a & b}


def test_p8_against_brute_force(spark, duck):
    texts = duck.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()
    letters = lookalike.look_alike_letters(spark)
    forms = [(d, t, reference_form(t, letters)) for d, t in texts]
    wanted = {(a, b) for a, t, f in forms for b, u, g in forms if a < b and f == g and t != u}
    assert rows(queries.p8_found(spark, DATA)) == wanted
    assert lookalike.LOOKALIKES
