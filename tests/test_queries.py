import pytest
from pyspark.sql import functions as F

from nephos import registry
from nephos.schema import MODEL_COLUMNS
from tests.oracle import assert_same, connect


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_oracle(spark, sf_dir, duck, name):
    assert_same(registry.queries()[name](spark, sf_dir), duck, registry.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_query_without_oracle_gives_rows(spark, sf_dir, name):
    assert registry.queries()[name](spark, sf_dir).count() > 0


@pytest.mark.parametrize("name", sorted(registry.fixed_checks()))
def test_fixed_input_matches_oracle(spark, sf_dir, duck, name):
    made, sql = registry.fixed_checks()[name]
    assert_same(made(spark, sf_dir), duck, sql)


def test_every_query_reads_a_table(spark, sf_dir):
    """Queries read the given tables: their SQL names one, too."""
    import re

    from tests.oracle import TABLES

    for name, sql in registry.oracle_sql().items():
        assert re.search(rf"\b({'|'.join(TABLES)})\b", sql), name


def test_store_commits_depends_on_every_column_of_its_rows(spark, sf_dir, monkeypatch):
    """Rows that come changed into the store change each figure but the counts of rows and the checks."""
    from nephos.queries import files

    whole, query = files.whole_rows, registry.queries()["store_commits"]
    numbers = ("obs_id", "longitude", "latitude", "x", "y", "z", "value", "value_uncertainty", "qc_flag", *MODEL_COLUMNS)
    other = {"quantity": "HLOS_WIND", "z_type": "columnar", "orig_filename": "raw2", "metadata": "{}"}
    changed = {c: F.col(c) + 1 for c in numbers} | {c: F.lit(v) for c, v in other.items()}
    changed |= {"time": F.col("time") - F.expr("INTERVAL 1 HOUR"), "ingest_file": F.when(F.col("ingest_file") == "file1", "file0").otherwise(F.col("ingest_file"))}
    coords = F.struct(F.array(F.lit(1), F.lit(2)).alias("indices"), F.array(F.lit(3), F.lit(4)).alias("shape"), F.col("orig_coords.names").alias("names"))
    right = {r["instrument"]: r.asDict() for r in query(spark, sf_dir).collect()}
    monkeypatch.setattr(files, "whole_rows", lambda *a: whole(*a).withColumns(changed | {"orig_coords": coords}))
    wrong = {r["instrument"]: r.asDict() for r in query(spark, sf_dir).collect()}
    kept = {"instrument", "n", "n_before", "n_model_before", "conflict", "small_deltas", "same_compacted"}
    assert right.keys() == wrong.keys()
    for name, row in right.items():
        # Every row of "view" gets a value, whatever its quantity.
        assert {c for c in row if row[c] == wrong[name][c]} - {"n_model"} == kept


def test_store_commits_reads_the_first_version(spark, sf_dir, monkeypatch):
    from nephos.sources.store import ObservationStore

    query, read = registry.queries()["store_commits"], ObservationStore.read
    asked = lambda: {r["instrument"]: r["n_model_before"] for r in query(spark, sf_dir).collect()}
    right = asked()
    monkeypatch.setattr(ObservationStore, "read", lambda self, version=None: read(self))
    assert all(right[i] > n for i, n in asked().items())


def test_store_commits_keeps_rows_without_an_instrument(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.withColumn("event_type", F.when(F.col("event_id") % 3 != 0, F.col("event_type"))).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    odd = connect(sf_dir)
    odd.execute(f"CREATE OR REPLACE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    assert_same(registry.queries()["store_commits"](spark, str(tmp_path)), odd, registry.oracle_sql()["store_commits"])


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 10


def test_library_does_not_import_llm():
    from pathlib import Path

    root = Path(registry.__file__).parent
    assert not [p for p in root.rglob("*.py") if "llm" not in p.relative_to(root).parts and "nephos.llm" in p.read_text()]
