"""Every registered corpus query over a whole small table: one row for each input row, contract columns, stable results."""

import os

import pytest

from nephos.llm import queries
from tests.llm.helpers import DOCS, hard_rows, prose

CONTRACT = {
    "op1_mix_sources": "doc_id rate drawn largest_gap",
    "op2_best_fit_packing": "doc_id piece_start piece_tokens bin_id bin_offset bin_tokens bin_length",
    "op3_secret_scan": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op4_token_counts": "doc_id n_tokens score",
    "op5_token_store": "doc_id start n_tokens ids_crc32",
    "op6_ngram_jaccard": "doc_id class_id n_links n_copies",
    "op7_flac_media": "doc_id n_bytes payload_bytes payload_sha256 tail_crc32 media_bytes media_sha256 feature",
    "op8_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op9_toxicity": "doc_id held_out score predicted",
}


@pytest.fixture(scope="module")
def hard_folder(spark, tmp_path_factory):
    """The hard rows, with an extra column of a clashing name, and labels."""
    from tests.llm.helpers import docs, with_clashing_columns

    path = str(tmp_path_factory.mktemp("hard"))
    rows = hard_rows() + [(100 + i, prose(i, 60), "en", "src1", 1) for i in range(60)]
    with_clashing_columns(docs(spark, rows)).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(100 + i, i % 2, int(i % 3 == 0)) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, rows


@pytest.fixture(scope="module")
def empty_folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty"))
    spark.createDataFrame([], DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.mark.parametrize("name", list(CONTRACT))
def test_contract_columns_and_rows(spark, hard_folder, name):
    path, rows = hard_folder
    out = queries.queries()[name](spark, path)
    assert set(CONTRACT[name].split()) <= set(out.columns)
    found = out.collect()
    if name == "op2_best_fit_packing":
        assert {r["doc_id"] for r in found} == {r[0] for r in rows}
    else:
        assert sorted(r["doc_id"] or 0 for r in found) == sorted(r[0] or 0 for r in rows)


@pytest.mark.parametrize("name", list(CONTRACT))
def test_empty_tables_give_no_rows(spark, empty_folder, name):
    assert queries.queries()[name](spark, empty_folder).count() == 0


@pytest.mark.parametrize("name", list(CONTRACT))
def test_whole_table_of_the_test_data(spark, name):
    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("no test data here")
    out = queries.queries()[name](spark, path)
    ids = sorted(r["doc_id"] for r in out.select("doc_id").distinct().collect())
    assert ids == sorted(r["doc_id"] for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id").distinct().collect())


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_matches_oracle(spark, name):
    from tests.oracle import assert_same, connect

    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("no test data here")
    assert_same(queries.queries()[name](spark, path), connect(path), queries.oracle_sql()[name])


def test_oracle_of_the_join_over_hard_rows(spark, hard_folder):
    import duckdb

    path, _ = hard_folder
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet/*.parquet'")
    want = duck.execute(queries.oracle_sql()["op6_ngram_jaccard"]).fetchall()
    got = queries.queries()["op6_ngram_jaccard"](spark, path).select("doc_id", "class_id", "n_links", "n_copies").collect()
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(map(key, got)) == sorted(map(key, want))
