"""Every registered query against its SQL twin, at the smallest size."""

import math
import os

import pytest

import __spark_entry__ as entry_module

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


@pytest.mark.parametrize("name", list(entry_module.queries()))
def test_query(spark, duck, name):
    df = entry_module.queries()[name](spark, SF)
    columns = sorted(df.columns)
    mine = sorted([tuple(_cell(r[c]) for c in columns) for r in df.collect()])
    assert mine
    sql = entry_module.oracle_sql().get(name)
    if sql is None:
        return
    result = duck.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert mine == sorted(tuple(_cell(r[i]) for i in order) for r in result.fetchall())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_every_twin_has_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_alt_texts_are_looked_for_in_kept_contexts_only(spark, tmp_path, monkeypatch):
    from pairmine.operators import store
    from workload import adapters

    rows = [(i, f"word{i} one two three four five six", "en", "src1", i % 3) for i in range(40)] + [(51, None, None, "src2", 5)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    wide = store.to_context_rows(store.dedup_contexts(adapters.doc_contexts(spark, str(tmp_path))), "training")
    given, dedup = [], store.dedup_contexts
    monkeypatch.setattr(store, "dedup_contexts", lambda df: given.append(df.columns) or dedup(df))
    kept = adapters.stored_contexts(spark, str(tmp_path))
    assert given and "found_alt_in_context" not in given[0]
    times = "extraction_timestamp"
    assert sorted(map(str, kept.drop(times).collect())) == sorted(map(str, wide.drop(times).collect()))
