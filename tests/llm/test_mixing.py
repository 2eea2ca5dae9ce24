import pytest
from pyspark.sql import functions as F

from nephos.llm import mixing as M
from tests.llm.helpers import docs, hard_rows, prose, with_clashing_columns

TARGETS = {"source": {"a": 0.5, "b": 0.5}, "lang": {"en": 0.7, "de": 0.3}, "topic": {"prose": 1.0}}


def corpus(n=3000):
    return [(i, prose(i, 20 + i % 30), "de" if i % 5 == 0 else "en", "a" if i % 3 else "b", 1) for i in range(n)]


def brute_words(text):
    import re

    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_raking_meets_the_margins():
    tokens = {("a", "en", "prose"): 800, ("a", "de", "prose"): 100, ("b", "en", "prose"): 60, ("b", "de", "prose"): 240}
    mix = M.rake(tokens, TARGETS | {"lang": {"en": 0.6, "de": 0.4}}, 0.3)
    kept = {c: mix.rates[c] * n for c, n in tokens.items()}
    assert mix.gap < 1e-6 and sum(kept.values()) == pytest.approx(360)
    assert sum(v for c, v in kept.items() if c[0] == "a") == pytest.approx(180)
    assert sum(v for c, v in kept.items() if c[1] == "en") == pytest.approx(216)


def test_rates_never_pass_one_and_say_what_is_missing():
    mix = M.rake({("a", "en", "prose"): 1000, ("b", "en", "prose"): 10}, TARGETS, 0.5)
    assert mix.rates["b", "en", "prose"] == 1.0 and mix.gap > 0.1


def test_unnamed_categories_keep_their_share():
    mix = M.rake({("a", "en", "prose"): 100, ("other", "en", "prose"): 100}, TARGETS, 0.5)
    kept = {c: mix.rates[c] * n for c, n in mix.rates.items() for n in [100]}
    assert kept["other", "en", "prose"] == pytest.approx(50, rel=0.5)


def test_no_tokens_no_rates():
    assert M.rake({}, TARGETS).rates == {}


def test_cells_and_draws_match_brute_force(spark):
    rows = corpus()
    df = docs(spark, rows)
    tokens = M.cell_tokens(df, TARGETS)
    want = {}
    for _, text, lang, source, _ in rows:
        key = (source, lang, "prose")
        want[key] = want.get(key, 0) + brute_words(text)
    assert tokens == want
    mix = M.rake(tokens, TARGETS, 0.3)
    out = M.mix_rows(df, mix, TARGETS).collect()
    assert len(out) == len(rows)
    assert all(r["rate"] == mix.rates[r["source"], r["lang"], r["topic"]] for r in out)
    kept = sum(r["n_tokens"] for r in out if r["drawn"])
    assert kept == pytest.approx(0.3 * sum(want.values()), rel=0.08)
    share = sum(r["n_tokens"] for r in out if r["drawn"] and r["source"] == "a") / kept
    assert share == pytest.approx(0.5, abs=0.05)
    drawn = {r["doc_id"] for r in out if r["drawn"]}
    assert drawn == {r["doc_id"] for r in M.mix_documents(df, TARGETS, 0.3).collect()}


def test_topics_by_form(spark):
    texts = {"a ### b": "markup", "a | b": "table", "A!! B!! C": "shouting", "x@y.z": "contact", "plain words": "prose", "  ": "empty", None: "empty"}
    got = spark.createDataFrame([(t,) for t in texts], "text string").select("text", M.topic_of(F.col("text")).alias("t")).collect()
    assert {r["text"]: r["t"] for r in got} == texts


def test_hard_rows(spark):
    df = with_clashing_columns(docs(spark))
    mix = M.rake(M.cell_tokens(df, M.TARGETS), M.TARGETS, 0.9)
    out = M.mix_rows(df, mix, M.TARGETS).collect()
    assert len(out) == len(hard_rows())
    assert not any(r["drawn"] for r in out if r["n_tokens"] == 0)
    kept = M.mix_documents(df, M.TARGETS, 0.9)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == sorted(r["doc_id"] or 0 for r in out if r["drawn"])


def test_empty_table(spark):
    assert M.cell_tokens(docs(spark, []), M.TARGETS) == {} and M.mix_documents(docs(spark, []), M.TARGETS).count() == 0


def test_query_and_cells_count_tokens(spark, tmp_path):
    from tokenizers import Tokenizer

    from nephos.llm import queries

    path = queries.tokenizer_path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    count = lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 if (t or "").strip() else 0
    rows = corpus(200) + [(10_000 + (r[0] or 0), *r[1:]) for r in hard_rows()]
    df = docs(spark, rows)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    out = queries.op1_mix_sources(spark, str(tmp_path)).collect()
    assert sorted((r["doc_id"], r["n_tokens"]) for r in out) == sorted((r[0], count(r[1])) for r in rows)
    assert not any(r["drawn"] for r in out if not r["n_tokens"])
    tokens = M.cell_tokens(df, M.TARGETS, path)
    assert sum(tokens.values()) == sum(count(r[1]) for r in rows)
    mix = M.rake(tokens, M.TARGETS)
    assert all(r["rate"] == mix.rates[r["source"], r["lang"], r["topic"]] for r in out if r["n_tokens"])
    drawn = sorted(r["doc_id"] for r in out if r["drawn"])
    assert drawn == sorted(r["doc_id"] for r in M.mix_documents(with_clashing_columns(df), M.TARGETS, tokenizer=path).collect())


def brute_rake(tokens, wanted, keep, rounds=4000):
    """Plain alternating scaling with caps, on arrays."""
    import numpy as np

    names = [sorted({c[d] for c in tokens}) for d in range(3)]
    n = np.zeros([len(x) for x in names])
    for c, v in tokens.items():
        n[tuple(x.index(k) for x, k in zip(names, c, strict=True))] = v
    kept = keep * n
    for _ in range(rounds):
        for d in range(3):
            others = tuple(k for k in range(3) if k != d)
            have = kept.sum(axis=others)
            aim = np.array([wanted[d].get(k, 0) for k in names[d]]) * keep * n.sum()
            shape = [1, 1, 1]
            shape[d] = -1
            kept = np.minimum(n, kept * np.divide(aim, have, out=np.zeros_like(aim), where=have > 0).reshape(shape))
    return {c: kept[tuple(x.index(k) for x, k in zip(names, c, strict=True))] / v for c, v in tokens.items()}


@pytest.mark.parametrize("keep", [0.2, 0.4, 0.7])
def test_raking_with_caps_matches_brute_force(keep):
    import random

    rng = random.Random(keep)
    tokens = {(s, lang, t): rng.randint(1, 2000) for s in "abcd" for lang in ("en", "de", "fr") for t in ("x", "y")}
    targets = {"source": {"a": 0.4, "b": 0.3, "c": 0.2, "d": 0.1}, "lang": 0.5, "topic": 0.7}
    mix = M.rake(tokens, targets, keep)
    if mix.gap < 1e-6:
        want = brute_rake(tokens, M.wanted_shares(tokens, targets), keep)
        assert max(abs(mix.rates[c] - want[c]) for c in tokens) < 1e-4
    else:
        assert keep == 0.7 and mix.gap == pytest.approx(brute_gap(tokens, targets, keep), abs=1e-6)
    assert len(mix.margins) == 9 and mix.gap == max(abs(w - r) for *_, w, r in mix.margins)


def brute_gap(tokens, targets, keep, rounds=20_000):
    """The largest gap of the margins nearest to the targets, the kept share met: mass moves between two cells at a time, as far as is best."""
    wanted = M.wanted_shares(tokens, targets)
    total = keep * sum(tokens.values())
    cells = list(tokens)
    mass = {c: tokens[c] / sum(tokens.values()) for c in cells}
    have = [dict.fromkeys({c[d] for c in cells}, 0.0) for d in range(3)]
    for c in cells:
        for d in range(3):
            have[d][c[d]] += mass[c]
    over = lambda d, k: have[d][k] - wanted[d].get(k, 0.0)
    for _ in range(rounds):
        moved = 0.0
        for i, a in enumerate(cells):
            for b in cells[:i]:
                apart = [d for d in range(3) if a[d] != b[d]]
                if apart:
                    best = sum(over(d, b[d]) - over(d, a[d]) for d in apart) / (2 * len(apart))
                    go = min(max(best, -mass[a], mass[b] - tokens[b] / total), tokens[a] / total - mass[a], mass[b])
                    mass[a], mass[b], moved = mass[a] + go, mass[b] - go, max(moved, abs(go))
                    for d in apart:
                        have[d][a[d]] += go
                        have[d][b[d]] -= go
        if moved < 1e-14:
            break
    return max(abs(v - wanted[d].get(k, 0.0)) for d in range(3) for k, v in have[d].items())


def test_margins_that_conflict_are_told_and_mixed():
    """Eight cells, each source with one language and one topic: no rates meet all three margins."""
    import random

    for keep in (0.4, 0.6):
        for seed in range(3):
            rng = random.Random(seed)
            tokens = {(f"s{i}", "en" if i < 5 else "de", f"t{i % 3}"): rng.randint(100, 5000) for i in range(8)}
            mix = M.rake(tokens, M.TARGETS, keep)
            wanted = M.wanted_shares(tokens, M.TARGETS)
            assert all(asked == pytest.approx(wanted[M.DIMENSIONS.index(d)][k]) for d, k, asked, _ in mix.margins)
            assert mix.gap == pytest.approx(brute_gap(tokens, M.TARGETS, keep), abs=1e-6) and mix.gap > 0.001
            assert max(mix.rates.values()) - min(mix.rates.values()) > 0.1 and all(0 <= r <= 1 for r in mix.rates.values())
            assert sum(mix.rates[c] * n for c, n in tokens.items()) == pytest.approx(keep * sum(tokens.values()))


def test_powers_are_asked_as_they_are():
    tokens = {("hot", "en", "x"): 7500, ("a", "en", "x"): 500, ("a", "de", "x"): 2000}
    mix = M.rake(tokens, {"source": 1.0, "lang": 0.1, "topic": 1.0}, 0.6)
    asked = {(d, k): a for d, k, a, _ in mix.margins}
    assert asked["source", "hot"] == pytest.approx(0.75) and asked["lang", "de"] == pytest.approx(0.2**0.1 / (0.2**0.1 + 0.8**0.1))
    assert mix.gap == pytest.approx(brute_gap(tokens, {"source": 1.0, "lang": 0.1, "topic": 1.0}, 0.6), abs=1e-6)


def test_every_category_is_named_and_too_many_cells_raise(spark, monkeypatch):
    rows = [(i, prose(i, 20 + 10 * (i % 9)), "en", f"s{i % 90}", 1) for i in range(180)]
    cells = M.cell_tokens(docs(spark, rows), M.TARGETS)
    assert {c[0] for c in cells} == {f"s{i}" for i in range(90)} and sum(cells.values()) == sum(brute_words(r[1]) for r in rows)
    monkeypatch.setattr(M, "MOST_CELLS", 89)
    with pytest.raises(ValueError):
        M.cell_tokens(docs(spark, rows), M.TARGETS)
    assert len(M.cell_tokens(docs(spark, rows), M.TARGETS | {"source": {"s1": 0.5, "s2": 0.5}})) == 3


def test_margins_stand_beside_the_rows(spark):
    rows = corpus(300)
    df = docs(spark, rows)
    mix = M.rake(M.cell_tokens(df, TARGETS), TARGETS, 0.3)
    shares = {(d, k): (a, r) for d, k, a, r in mix.margins}
    for r in M.mix_rows(df, mix, TARGETS).collect():
        assert all((r[f"{d}_asked"], r[f"{d}_reached"]) == shares[d, r[d]] for d in M.DIMENSIONS) and r["largest_gap"] == mix.gap


def test_topics_follow_contents_and_not_languages(spark):
    from nephos.llm import queries, topics
    from nephos.llm.token_store import encoder

    path = queries.tokenizer_path("word_bpe_49k.json")
    themes = ["river mountain valley forest lake stone meadow cliff".split(), "engine piston wheel brake clutch gear motor valve".split()]
    import random

    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(themes[i % 2]) for _ in range(60)) + (" the of and" if i % 4 < 2 else " der die das") * 9, ("en", "en", "de", "de")[i % 4], "s", 1) for i in range(200)]
    counted = lambda rows: M.keyed(docs(spark, rows), tokenizer=path)
    model = topics.fit_topics(counted(rows), topics=2)
    named = [model.name(encoder(path).encode([r[1]])[0], r[2]) for r in rows]
    assert len(set(named[::2])) == len(set(named[1::2])) == 1 and named[0] != named[1]
    assert model.name(b"", "en") == topics.OTHER and topics.fit_topics(counted([])).name(b"\1\0\0\0", None) == topics.OTHER


def test_production_targets_are_met_on_the_corpus(spark):
    import os

    from nephos.llm import queries

    if not os.path.isdir("/root/testdata/sf0.01"):
        pytest.skip("no test data here")
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = queries.op1_mix_sources(spark, "/root/testdata/sf0.01")
    rows = out.collect()
    gaps = [abs(r[f"{d}_asked"] - r[f"{d}_reached"]) for r in rows if r["n_tokens"] for d in M.DIMENSIONS]
    assert len(rows) == df.count() and max(gaps) == pytest.approx(rows[0]["largest_gap"]) and rows[0]["largest_gap"] < 0.05
    total = sum(r["rate"] * r["n_tokens"] for r in rows)
    assert total == pytest.approx(M.KEEP_SHARE * sum(r["n_tokens"] for r in rows), rel=0.01)
    assert len({r["topic"] for r in rows}) >= 4


def test_margins_are_reported(spark):
    mix = M.rake({("a", "en", "prose"): 800, ("b", "de", "prose"): 240}, TARGETS, 0.3)
    report = {(r["dimension"], r["category"]): r["reached"] for r in M.margin_report(spark, mix).collect()}
    assert set(report) == {("source", "a"), ("source", "b"), ("lang", "en"), ("lang", "de"), ("topic", "prose")} and report["topic", "prose"] == pytest.approx(1)
