"""The trie against dictionaries of whole prefixes, partitions of any cut, defined cases."""

import hashlib
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from nephos.llm import queries, trie
from tests.llm.helpers import with_clashing_columns
from tests.oracle import assert_same, connect

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuilt(rows):
    """{conv_id: list of (role, text)} by the rule."""
    own = {}
    for conv, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        own.setdefault(conv, []).append((role or "", text or ""))
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute(convs):
    """Rows of every node, from all prefixes of all conversations."""
    import re

    members, children = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
            if d:
                children.setdefault(tuple(turns[: d - 1]), set()).add(tuple(turns[:d]))
    ends = {}
    for c, turns in convs.items():
        ends.setdefault(tuple(turns), []).append(c)
    out = []
    for p, of in members.items():
        below = [q for q in members if q[: len(p)] == p]
        words = lambda q: len(re.findall(r"[^\x20\x09-\x0D]+", q[-1][1])) if q else 0
        saved = sum((len(members[q]) - 1) * words(q) for q in below)
        leaves = sum(q not in children for q in below)
        digest = hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()
        out.append((min(of), len(p), min(members[p[:-1]]) if p else None, len(of), len(children.get(p, ())), leaves, saved, digest))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def hard():
    """Shared heads, copies, nulls, ties, repeated rows, a long conversation, one inside another, a conversation without a base."""
    say = lambda c, *texts: [(c, t, "user" if t % 2 == 0 else "assistant", x) for t, x in enumerate(texts)]
    rows = say(0, "hello there", "good day to you", "how are you", "fine thanks", "bye")
    for c in range(1, 60):
        rows += say(c, *[f"own {c % 7} {t} words" for t in range(c % 6 + 1)])
    rows += say(100, *[f"turn {t}" for t in range(300)]) + say(101, *[f"turn {t}" for t in range(200)]) + say(120, "a b", "c")
    rows += [(130, None, None, None), (130, 5, "user", "tie b"), (130, 5, "user", "tie a"), (130, 5, "user", "tie a"), (130, 6, "as:1", "x"), (None, 0, "user", "lost")]
    rows += [(-3, 0, "user", "below zero"), (-20, 0, "user", "base below zero"), (141, 0, "user", "no base"), (161, 0, "user", "w " * 20_000)]
    for c in range(200, 400, 20):
        rows += say(c, "the same", "first turns", "and last")
    return rows


def test_hard_rows_match_brute_force(spark):
    rows = hard()
    want = brute(rebuilt(rows))
    assert any(r[1] == 0 and r[7] != trie.EMPTY_ENDS for r in want), "some conversation must end at the root"
    df = spark.createDataFrame(rows, SCHEMA)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert got(trie.prefix_trie(with_clashing_columns(df).withColumns({"depth": F.lit(1), "part": F.lit("x"), "own": F.lit(2)}).repartition(3))) == want
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got(trie.prefix_trie(df)) == want


def test_empty_table_and_one_turnless_conversation(spark):
    assert got(trie.prefix_trie(spark.createDataFrame([], SCHEMA))) == []
    c = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4)
    assert got(trie.prefix_trie(spark.createDataFrame([(c, 0, "user", "x")], SCHEMA))) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_many_ends_are_packed_in_order(spark, monkeypatch):
    monkeypatch.setattr(trie, "PACKED", 3)
    ids = [100, 7, -5, 12, 9, 1000, 33, 2, 8]
    rows = spark.createDataFrame([(b"a", i) for i in ids] + [(b"b", 1)], "id binary, conv_id long").repartition(4)
    want = {b"a": hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest(), b"b": hashlib.sha256(b"1").hexdigest()}
    assert {bytes(r["id"]): r["ends_sha256"] for r in trie.end_digests(rows).collect()} == want


turns = st.lists(st.sampled_from("abc"), max_size=5)


@given(st.lists(turns, min_size=1, max_size=25), st.lists(st.integers(0, 25), max_size=4))
@settings(max_examples=300, deadline=None)
def test_points_of_any_partitions_add_up(convs, cuts):
    """Sorted strings cut anywhere give, summed, the tree of all; only branch, end, leaf and border points are made."""
    code = lambda s: b"".join(hashlib.sha256(x.encode()).digest()[: trie.DIGEST] for x in s)
    words = {"a": 1, "b": 2, "c": 5}
    counted = {}
    for i, s in enumerate(convs):
        key = code(s)
        _, _, n, least = counted.get(key, (key, [words[x] for x in s], 0, i))
        counted[key] = (key, [words[x] for x in s], n + 1, min(least, i))
    rows = sorted(counted.values())
    at = sorted({0, len(rows), *(min(c, len(rows)) for c in cuts)})
    parts = [rows[a:b] for a, b in zip(at, at[1:], strict=False)]
    shared = [trie.common_turns(p[-1][0], q[0][0]) for p, q in zip(parts, parts[1:], strict=False)]
    total = {}
    for k, part in enumerate(parts):
        for id, trunk, depth, parent, n, least, children, leaves, saved, ends in trie.points(iter(part), shared[k - 1] if k else None, shared[k] if k < len(shared) else None):
            old = total.get(id)
            assert old is None or (trunk and old[0] and old[1] == depth and old[2] == parent)
            total[id] = (trunk, depth, parent, n, least, children, leaves, saved, ends) if old is None else (trunk, depth, parent, old[3] + n, min(old[4], least), old[5] + children, old[6] + leaves, [old[7][0] + saved[0]], old[8] or ends)
    prefixes = {}
    for i, s in enumerate(convs):
        for d in range(len(s) + 1):
            prefixes.setdefault(tuple(s[:d]), []).append(i)
    ids = {p: trie.prefix_id(code(p), len(p)) for p in prefixes}
    child = {p: [q for q in prefixes if q[:-1] == p and q] for p in prefixes}
    for p, of in prefixes.items():
        special = not p or len(child[p]) != 1 or any(tuple(s) == p for s in convs)
        if special:
            assert ids[p] in total
        if ids[p] in total and (special or total[ids[p]][0]):
            _, depth, _, n, least, children, leaves, saved, ends = total[ids[p]]
            below = [q for q in prefixes if q[: len(p)] == p]
            value = lambda q: sum((len(prefixes[r]) - 1) * (words[r[-1]] if r else 0) for r in prefixes if r[: len(q)] == q)
            want_leaves = sum(not child[q] for q in below)
            assert (depth, n, least, children, leaves or 1, ends) == (len(p), len(of), min(of), len(child[p]), want_leaves, any(tuple(s) == p for s in convs))
            assert saved == [value(p[:d]) for d in range(depth - len(saved) + 1, depth + 1)]
    if len(parts) == 1:
        assert len(total) == sum(not p or len(child[p]) != 1 or any(tuple(s) == p for s in convs) for p in prefixes)


def test_query_matches_its_oracle(spark, sf_dir):
    assert_same(queries.op12_prefix_trie(spark, sf_dir), connect(sf_dir), queries.TRIE_SQL)


def test_query_matches_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(queries.op12_prefix_trie(spark, sf_dir)) == brute(rebuilt(rows))
