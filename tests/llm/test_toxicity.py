import numpy as np
from pyspark.sql import functions as F

from nephos.llm import toxicity as T
from tests.llm.helpers import docs, hard_rows, prose, with_clashing_columns

LABELS = "doc_id long, quality int, toxic int"


def corpus(n=600):
    rude = ("awful", "vile", "nasty")
    texts, labels = [], []
    for i in range(n):
        words, bad = prose(i, 60 + i % 50).split(), i % 4 == 0
        if bad:
            words[(7 * i) % 50] = rude[i % 3]
        texts.append((i, " ".join(words), ("en", "de")[i % 2], "s", 1))
        labels.append((i, 1, int(bad)))
    return texts, labels


def test_held_out_accuracy_and_determinism(spark):
    texts, labels = corpus()
    df, marks = docs(spark, texts), spark.createDataFrame(labels, LABELS)
    net = T.fit(df, marks)
    scored = {r["doc_id"]: r for r in T.toxicity_scores(df, net).collect()}
    held = [i for i, *_ in texts if scored[i]["held_out"]]
    assert held == [i for i, *_ in texts if T.crc_fold(i) == 0]
    right = sum(scored[i]["predicted"] == int(i % 4 == 0) for i in held)
    assert right / len(held) > 0.95
    again = T.fit(df, marks)
    assert all(r["score"] == scored[r["doc_id"]]["score"] for r in T.toxicity_scores(df, again).collect())
    assert all((r["score"] >= 0.5) == bool(r["predicted"]) and 0 <= r["score"] <= 1 for r in scored.values())


def test_training_never_sees_the_held_out_fold(spark):
    texts, labels = corpus(200)
    df = docs(spark, texts)
    honest = T.fit(df, spark.createDataFrame(labels, LABELS))
    lies = [(i, q, 1 - t if T.crc_fold(i) == 0 else t) for i, q, t in labels]
    assert T.fit(df, spark.createDataFrame(lies, LABELS)).score(T.Hasher()(texts[0][1])) == honest.score(T.Hasher()(texts[0][1]))


def test_scores_depend_on_texts_only(spark):
    texts, labels = corpus(200)
    net = T.fit(docs(spark, texts), spark.createDataFrame(labels, LABELS))
    moved = [(i + 10_000, t, "xx", "other", 9) for i, t, *_ in texts]
    a = sorted(r["score"] for r in T.toxicity_scores(docs(spark, texts), net).collect())
    assert a == sorted(r["score"] for r in T.toxicity_scores(docs(spark, moved), net).collect())


def test_hard_rows_and_empty_table(spark):
    texts, labels = corpus(200)
    net = T.fit(docs(spark, texts), spark.createDataFrame(labels, LABELS))
    out = T.toxicity_scores(with_clashing_columns(docs(spark)), net)
    assert out.count() == len(hard_rows()) and out.where(F.col("score").isNull()).count() == 0
    assert T.toxicity_scores(docs(spark, []), net).count() == 0


def test_without_labels(spark):
    net = T.fit(docs(spark), spark.createDataFrame([], LABELS))
    assert {r["score"] for r in T.toxicity_scores(docs(spark), net).collect()} == {0.5}


def test_best_cut():
    assert T.best_cut(np.array([0.1, 0.2, 0.8, 0.9]), np.array([0, 0, 1, 1])) == 0.5
    assert T.best_cut(np.array([0.1, 0.1]), np.array([0.0, 1.0])) in (-0.9, 1.1)


def tiny_net(seed=1):
    rng = np.random.default_rng(seed)
    filters = [rng.normal(0, 0.6, (w, T.DIMENSION, T.FILTERS)) for w in T.WIDTHS]
    size = T.FILTERS * len(T.WIDTHS)
    return T.Net(rng.normal(0, 0.5, (2 * T.BUCKETS, T.DIMENSION)), filters, rng.normal(0, 0.2, size), rng.normal(0, 0.5, size), 0.3)


def plain_logit(net, ids):
    """Convolution, pooling and the output layer, term by term."""
    words = [net.embedding[a] + net.embedding[b] for a, b in ids] + [np.zeros(T.DIMENSION)] * (max(T.WIDTHS) - 1 + (not len(ids)))
    total, row = net.out_bias, 0
    for width, w in zip(T.WIDTHS, net.filters, strict=True):
        for f in range(T.FILTERS):
            responses = [sum(float(words[at + k] @ w[k, :, f]) for k in range(width)) for at in range(max(len(ids), 1))]
            total += max(max(responses) + net.bias[row], 0.0) * net.out[row]
            row += 1
    return total


def test_forward_pass_matches_a_plain_convolution():
    net, hasher = tiny_net(), T.Hasher()
    net.embedding = net.embedding.astype(np.float32)
    for text in ("", "one", "one two three four", prose(3, 25)):
        assert abs(net.logit(hasher(text)) - plain_logit(net, hasher(text))) < 1e-4


def test_gradients_match_differences(monkeypatch):
    net, ids = tiny_net(2), T.Hasher()(prose(5, 12))

    def loss(label):
        z = plain_logit(net, ids)
        return np.log1p(np.exp(z)) - label * z

    def slope(array, at, label, step=1e-5):
        kept = array[at]
        array[at] = kept + step
        high = loss(label)
        array[at] = kept - step
        low = loss(label)
        array[at] = kept
        return (high - low) / (2 * step)

    for label in (0.0, 1.0):
        grads, touched = T.gradients(net, ids, label)
        for array, g in zip([*net.filters, net.bias, net.out], grads, strict=False):
            for at in list(np.ndindex(array.shape))[:: max(1, array.size // 20)]:
                assert abs(slope(array, at, label) - g[at]) < 1e-3, (array.shape, at)
        want = np.zeros_like(net.embedding[:, 0:0], shape=net.embedding.shape)
        for place, g in touched:
            want[place] += g
        for bucket in {int(b) for place, _ in touched for b in place}:
            for d in range(0, T.DIMENSION, 3):
                assert abs(slope(net.embedding, (bucket, d), label) - want[bucket, d]) < 1e-3


def test_training_gains_over_its_start(monkeypatch):
    texts, labels = corpus(500)
    rng = np.random.default_rng(4)
    hasher, ids, marks = T.Hasher(), [], []
    for (_, text, *_), (_, _, toxic) in zip(texts, labels, strict=True):
        ids.append(hasher(text).astype(np.int32))
        marks.append(float(toxic if rng.random() > 0.05 else 1 - toxic))
    y = np.array(marks)
    loss = lambda net: np.mean([np.logaddexp(0, net.logit(t)) - m * net.logit(t) for t, m in zip(ids[400:], y[400:], strict=True)])
    assert loss(T.train(ids[:400], y[:400])) < 0.8 * loss(T.train(ids[:400], y[:400], epochs=0))


def test_words_are_bounded_and_hashed_on_the_executors(spark):
    texts, labels = corpus(200)
    rows = T.training_rows(docs(spark, texts), spark.createDataFrame(labels, LABELS))
    by = {i: t for i, t, *_ in texts if T.crc_fold(i)}
    assert len(rows) == len(by) and [h.tolist() for h, *_ in rows] == [T.Hasher().hashes(by[i]).tolist() for i in sorted(by)]
    few = T.training_rows(docs(spark, texts), spark.createDataFrame(labels, LABELS), most_words=2_000)
    assert 0 < sum(len(h) for h, *_ in few) <= 2_000 < sum(len(h) for h, *_ in few) + 120


def test_every_language_has_a_threshold():
    net = tiny_net()
    hasher, rng = T.Hasher(), np.random.default_rng(5)
    ids = [hasher(prose(i, 20)) for i in range(60)]
    logits = [net.logit(t) for t in ids]
    labels = np.array([float(z > np.median(logits)) for z in logits])
    T.calibrate(net, ids, labels, ["en" if i % 10 else "xx" for i in rng.permutation(60)])
    assert set(net.thresholds) == {"en", "xx"} and all(0 < c < 1 for c in net.thresholds.values())
    weighted = T.best_cut(np.array([0.1, 0.4, 0.6, 0.9]), np.array([0.0, 1.0, 0.0, 1.0]), np.array([1.0, 0.1, 1.0, 1.0]))
    assert weighted == 0.75
