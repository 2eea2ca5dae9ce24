import random

from hypothesis import given, settings
from hypothesis import strategies as st

from nephos.llm import packing as P
from tests.llm.helpers import docs, hard_rows, prose, with_clashing_columns


def brute(lengths, permitted, cost):
    """The same rule by looking at every open bin."""
    value, bins = min(cost(c) / c for c in permitted), []
    for i in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        n = lengths[i]
        fits = [b for b in bins if b[0] - b[1] >= n]
        if fits:
            least = min(b[0] - b[1] for b in fits)
            b = next(b for b in fits if b[0] - b[1] == least)
        else:
            b = [min((c for c in permitted if c >= n), key=lambda c: (cost(c) - value * (c - n), c)), 0]
            bins.append(b)
        b[1] += n
    return sorted((min(c for c in permitted if c >= used), used) for _, used in bins)


@given(st.lists(st.integers(1, 64), max_size=80))
@settings(max_examples=60, deadline=None)
def test_pack_matches_brute_force(lengths):
    permitted = (16, 32, 64)
    bins = P.pack(lengths, permitted)
    assert sorted((b.length, b.used) for b in bins) == brute(lengths, permitted, P.attention_cost)
    assert sorted(i for b in bins for i, _ in b.entries) == list(range(len(lengths)))
    for b in bins:
        at = 0
        for i, offset in b.entries:
            assert offset == at
            at += lengths[i]
        assert at == b.used <= b.length


def test_opening_weighs_lengths_jointly():
    dear_long = lambda c: c * c
    assert [b.length for b in P.pack([10], (16, 32, 64), dear_long)] == [16]
    assert {b.length for b in P.pack([20, 20, 20], (16, 32, 64))} <= {32, 64}


def test_waste_is_small_on_many_documents():
    rng = random.Random(1)
    lengths = [min(4096, int(rng.lognormvariate(6, 1))) or 1 for _ in range(5000)]
    bins = P.pack(lengths)
    assert sum(lengths) / sum(b.length for b in bins) > 0.97


def test_pieces_cover_a_long_document():
    assert P.pieces_of(10, 4) == [(0, 4), (4, 4), (8, 2)] and P.pieces_of(4, 4) == [(0, 4)]


def check(rows, out, count=lambda text: len(text.split())):
    """Every document's pieces cover its ``count`` and an end mark, and every bin's pieces lie side by side within its length."""
    bins, covered = {}, {}
    for r in out:
        bins.setdefault(r["bin_id"], []).append(r)
        covered.setdefault(r["doc_id"], []).append((r["piece_start"], r["piece_tokens"]))
    for pieces in bins.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["bin_offset"]):
            assert r["bin_offset"] == at
            at += r["piece_tokens"]
            assert r["bin_length"] in P.LENGTHS
        assert {at} == {r["bin_tokens"] for r in pieces} and at <= pieces[0]["bin_length"]
    want = {}
    for doc_id, text, *_ in rows:
        want[doc_id] = want.get(doc_id, 0) + count(text or "") + 1
    assert {d: sum(n for _, n in p) for d, p in covered.items()} == want


def test_documents_and_hard_rows(spark):
    rows = hard_rows() + [(100 + i, prose(i, 5 + 37 * i % 900), "en", "s", 1) for i in range(300)]
    check(rows, P.pack_documents(with_clashing_columns(docs(spark, rows))).collect())
    check(rows, P.pack_documents(docs(spark, rows), shard_rows=50).collect())


def test_empty_table(spark):
    assert P.pack_documents(docs(spark, [])).count() == 0


def test_query_packs_tokens_and_cuts_a_long_text_without_spaces(spark, tmp_path):
    from tokenizers import Tokenizer

    from nephos.llm import queries

    rows = hard_rows() + [(50, "x1y2" * 6000, "en", "s", 1)] + [(100 + i, prose(i, 40), "es", "s", 1) for i in range(20)]
    docs(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    tokenizer = Tokenizer.from_file(queries.tokenizer_path("word_bpe_49k.json"))
    want, got = {}, {}
    for doc_id, text, *_ in rows:
        want[doc_id] = want.get(doc_id, 0) + len(tokenizer.encode(text or "", add_special_tokens=False).ids) + 1
    out = queries.op2_best_fit_packing(spark, str(tmp_path)).collect()
    for r in out:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["piece_tokens"]
    assert got == want and sum(r["doc_id"] == 50 for r in out) > 1
