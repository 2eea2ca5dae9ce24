import pytest

from nephos.llm import jaccard, quality, secret_scan
from tests.llm.helpers import docs, edited, hard_rows, prose, with_clashing_columns

corpus_pipeline = pytest.importorskip("corpus_pipeline")


@pytest.fixture()
def folder(spark, tmp_path):
    secret = ' token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"'
    rows = [(i, prose(i, 90) + (" ###" * 40 if i % 4 == 0 else "") + (secret if i % 10 == 1 else ""), "en", f"src{i % 20}", 1) for i in range(200)]
    rows += [(1000 + i, edited(rows[i][1], 80), "en", "src0", 1) for i in range(1, 40, 2)] + hard_rows()
    docs(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(200)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path), rows


def test_stages_match_brute_force(spark, folder):
    path, rows = folder
    df = spark.read.parquet(f"{path}/documents.parquet")
    rules = quality.fit_rules(df, spark.read.parquet(f"{path}/labels.parquet"))
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "ngram_join", "secret_scans", "mix_sources", "best_fit_packing"]
    first = dict(corpus_pipeline.STAGES)["quality_rules"](spark, df, path)
    stats = {(r["doc_id"], r["text"]): r.asDict() for r in quality.text_stats(df, "doc_id", "text").collect()}
    good = lambda s: not (s["n_words"] < 50 or 100 * s["n_repeat_words"] > 50 * s["n_words"]) and not any(r.holds(quality.feature_values(s)) for r in rules)
    want = sorted((d or -1, t or "") for d, t in ((r[0], r[1]) for r in rows) if good(stats[d, t]))
    assert sorted((r["doc_id"] or -1, r["text"] or "") for r in first.collect()) == want

    from tests.llm.test_jaccard import kept_ids

    kept = [(d if d > 0 else None, t, None, None, None) for d, t in want]
    second = dict(corpus_pipeline.STAGES)["ngram_join"](spark, first, path)
    assert sorted(r["doc_id"] or -1 for r in second.collect()) == kept_ids(kept)

    third = dict(corpus_pipeline.STAGES)["secret_scans"](spark, second, path)
    assert third.columns == df.columns and third.count() == second.count()
    cuts = secret_scan.fit_thresholds(second)
    assert not any(secret_scan.all_spans(r["text"] or "", cuts)[0] for r in third.collect())
    assert all(r["n_chars"] == len(r["text"]) for r in third.collect())

    fourth = dict(corpus_pipeline.STAGES)["mix_sources"](spark, third, path)
    drawn = {r["doc_id"] for r in fourth.collect()}
    assert drawn < {r["doc_id"] for r in third.collect()}

    from tokenizers import Tokenizer

    from nephos.llm.queries import tokenizer_path
    from tests.llm.test_packing import check

    tokenizer = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    count = lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids)
    check([(r["doc_id"], r["text"]) for r in fourth.collect()], dict(corpus_pipeline.STAGES)["best_fit_packing"](spark, fourth, path).collect(), count)


def test_run_equals_its_stages_one_after_another(spark, folder):
    path, _ = folder
    out = corpus_pipeline.run(spark, path)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, path).collect(), docs.schema)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, path)
    key = lambda df: sorted((r["doc_id"] or -1, r["piece_start"], r["piece_tokens"]) for r in df.collect())
    assert out.count() > 20 and {"doc_id", "bin_id", "bin_length"} <= set(out.columns)
    assert key(out) == key(last)


def test_mixing_stage_draws_what_its_rates_say(spark, folder):
    from nephos.llm import mixing
    from nephos.llm.queries import tokenizer_path

    path, _ = folder
    df = spark.read.parquet(f"{path}/documents.parquet")
    rows = mixing.mix_tokens(df, mixing.TARGETS, tokenizer_path("word_bpe_49k.json"), corpus_pipeline.MIX_SHARE).collect()
    kept = dict(corpus_pipeline.STAGES)["mix_sources"](spark, df, path)
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == sorted(r["doc_id"] or -1 for r in rows if r["drawn"])
    share = sum(r["rate"] * r["n_tokens"] for r in rows) / sum(r["n_tokens"] for r in rows)
    # One long document holds most tokens here, so the margins can't all be met; the gap to what is asked is reported.
    gap = max(abs(r[f"{d}_asked"] - r[f"{d}_reached"]) for r in rows if r["n_tokens"] for d in mixing.DIMENSIONS)
    assert abs(share - corpus_pipeline.MIX_SHARE) < 0.05 and 0 < rows[0]["largest_gap"] == pytest.approx(gap)


def test_clashing_columns_pass_through(spark, folder):
    path, _ = folder
    df = with_clashing_columns(spark.read.parquet(f"{path}/documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, df, path)
        assert after.columns == df.columns


def test_jaccard_is_a_stage():
    assert jaccard.THRESHOLD == 0.8 and jaccard.SHINGLE == 5
