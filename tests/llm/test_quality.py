import re
from collections import Counter

from nephos.llm import quality
from tests.llm.helpers import docs, hard_rows, prose, with_clashing_columns


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered.update((i, i + 1, i + 2))
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered), "n_upper": sum("A" <= c <= "Z" for c in text), "n_bangs": text.count("!"),
    }


REPEATS = ["a b c a b c a b c", "x\nx\n\nx \ny\ny", "a a a a", "a b", "# * $ % & | < >", "A b! C!!\x0b\x0cd", "a b c d a b c", "one two three " * 400]


def test_statistics_match_brute_force(spark):
    rows = hard_rows() + [(100 + i, t, "en", "s", 1) for i, t in enumerate(REPEATS)]
    got = [r.asDict() for r in quality.text_stats(docs(spark, rows), "doc_id", "text").collect()]
    assert len(got) == len(rows)
    for r in got:
        assert {k: r[k] for k in quality.STATS} == brute(r["text"])


def labelled(n=300):
    texts = [(i, prose(i, 80) + (" ###" * 30 if i % 3 == 0 else ""), "en", "s", 1) for i in range(n)]
    return texts, [(i, int(i % 3 != 0), 0) for i in range(n)]


def test_learned_list_separates_junk_and_stays_native(spark):
    texts, labels = labelled()
    df = docs(spark, texts)
    rules = quality.fit_rules(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert rules
    scored = quality.quality_scores(df, rules)
    assert all(r["kept"] == (r["doc_id"] % 3 != 0) for r in scored.collect())
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    for r in scored.limit(20).collect():
        values = quality.feature_values(r.asDict())
        assert r["kept"] == (not r["base_failed"] and not any(rule.holds(values) for rule in rules))


def test_base_rule():
    short, repeated = brute(prose(1, 49)), brute("one two three " * 60)
    assert short["n_words"] < 50 and 100 * repeated["n_repeat_words"] > 50 * repeated["n_words"]


def test_no_labels_no_rules(spark):
    rules = quality.fit_rules(docs(spark), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert rules == [] and quality.quality_scores(docs(spark), rules).count() == len(hard_rows())


def test_keep_good_keeps_columns_and_hard_rows_do_not_crash(spark):
    wide = with_clashing_columns(docs(spark))
    kept = quality.keep_good(wide, [])
    assert kept.columns == wide.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 4, 5, 5, 6, 6]


def test_empty_table(spark):
    assert quality.quality_scores(docs(spark, []), []).count() == 0


def test_pruning_drops_useless_tests():
    rows = [({f: float(i % 7) for f in quality.FEATURES} | {"symbols_per_word": float(i % 2)}, i % 2 == 1) for i in range(400)]
    rules = quality.learn_decision_list(rows)
    assert rules and all(r.tests[0].feature == "symbols_per_word" and len(r.tests) == 1 for r in rules)


def test_repeated_ids_bring_one_labelled_row_each(spark):
    texts, labels = labelled(40)
    again = texts + [(i, prose(500 + i, 70), "en", "s", 1) for i, *_ in texts] * 3
    rows = quality.labelled_rows(docs(spark, again), spark.createDataFrame(labels * 2, "doc_id long, quality int, toxic int"), 1000)
    assert len(rows) == 40
    least = [min(t for j, t, *_ in again if j == i) for i, *_ in texts]
    assert sorted(v["words"] for v, _ in rows) == sorted(float(brute(t)["n_words"]) for t in least)


def plain_cover(rows, most_rules=8):
    """Sequential covering with FOIL's gain over all cuts between values, grown, pruned and kept as stated."""
    from math import log2
    from random import Random

    rows = Random(17).sample(rows, len(rows))
    grow, held = rows[len(rows) // 3 :], rows[: len(rows) // 3]
    share = lambda b, g: (b + 1) / (b + g + 2)
    split = lambda part: (sum(b for _, b in part), sum(not b for _, b in part))
    passes = lambda v, rule: all((v[f] > c) == up for f, up, c in rule)
    out = []
    while len(out) < most_rules and split(grow)[0] >= 5:
        rule, part = [], grow
        while len(rule) < 3 and split(part)[1]:
            before, best = log2(share(*split(part))), None
            for f in quality.FEATURES:
                values = sorted({v[f] for v, _ in part})
                for c in [(x + y) / 2 for x, y in zip(values, values[1:], strict=False)]:
                    for up in (True, False):
                        b, g = split([r for r in part if (r[0][f] > c) == up])
                        gain = b * (log2(share(b, g)) - before)
                        if b >= 5 and gain > 1e-9 and (best is None or gain > best[0]):
                            best = (gain, (f, up, c))
            if best is None:
                break
            rule.append(best[1])
            part = [r for r in part if passes(r[0], [best[1]])]
        if not rule:
            break

        def worth(tests):
            b, g = split([r for r in held if passes(r[0], tests)])
            return (b - g) / (b + g) if b + g else -1.0

        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule.pop()
        bad, good = split([r for r in grow if passes(r[0], rule)])
        more, less = split([r for r in held if passes(r[0], rule)])
        if bad < 5 or share(bad + more, good + less) < 0.9:
            break
        out.append(rule)
        grow, held = ([r for r in side if not passes(r[0], rule)] for side in (grow, held))
    return out


def test_covering_and_pruning_match_a_plain_version():
    import random

    rng = random.Random(8)
    names = list(quality.FEATURES)
    rows = []
    for i in range(240):
        values = {f: float(rng.randrange(12)) for f in names}
        bad = values[names[0]] > 8 or (values[names[1]] < 3 and values[names[2]] > 5)
        rows.append((values, bad != (rng.random() < 0.03)))
    got = [[(t.feature, t.above, t.threshold) for t in r.tests] for r in quality.learn_decision_list(rows)]
    assert got and got == plain_cover(rows)
