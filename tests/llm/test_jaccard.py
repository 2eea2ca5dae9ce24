import os
import re
from collections import Counter

import pytest

from nephos.llm import jaccard
from tests.llm.helpers import docs, edited, hard_rows, prose, with_clashing_columns


def components(rows, threshold=0.8):
    """The component of each row and its least doc_id: all pairs that reach the threshold or have equal texts."""
    sets = [jaccard.shingle_set(r[1]) for r in rows]
    top = list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] or "") == (rows[j][1] or "") or jaccard.similar(sets[i], sets[j], threshold):
                top[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return [find(i) for i in range(len(rows))], least


def brute(rows):
    """(doc_id, class_id) of every row."""
    top, least = components(rows)
    return sorted((r[0] or -1, least.get(t, -1)) for r, t in zip(rows, top, strict=True))


def kept_ids(rows):
    """The doc_id that stays of each component."""
    top, least = components(rows)
    return sorted(least.get(t, -1) for t in set(top))


def classes(df):
    return sorted((r["doc_id"] or -1, r["class_id"] if r["class_id"] is not None else -1) for r in jaccard.similarity_classes(df).collect())


def near_rows():
    rows = []
    for g in range(6):
        base = prose(100 + g, 150)
        rows += [(1000 * g + i, edited(base, 60 + 7 * i, f"m{i}x") if i else base, "en", "s", 1) for i in range(12)]
        rows += [(1000 * g + 500 + i, edited(base, 8 + i, f"far{i}x"), "en", "s", 1) for i in range(6)]
    return rows


def test_band_plan_reaches_its_recall():
    bands, rows = jaccard.band_plan(0.8, 0.9999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9999 and bands * rows <= 160


def test_classes_match_brute_force(spark):
    rows = near_rows()
    assert classes(docs(spark, rows)) == brute(rows)


def test_hard_rows(spark):
    assert classes(with_clashing_columns(docs(spark))) == brute(hard_rows())


def test_links_mark_exactly_the_classes_with_more_than_one_row(spark):
    found = jaccard.similarity_classes(docs(spark, near_rows())).collect()
    sizes = {}
    for r in found:
        sizes[r["class_id"]] = sizes.get(r["class_id"], 0) + 1
    assert all((r["n_links"] > 0) == (sizes[r["class_id"]] > 1) for r in found)


def test_keep_one_keeps_one_of_each_class_and_rows_without_id(spark):
    rows = near_rows()
    kept = {r["doc_id"] for r in jaccard.keep_one(docs(spark, rows)).collect()}
    assert kept == {c for _, c in brute(rows)}
    hard = with_clashing_columns(docs(spark))
    out = jaccard.keep_one(hard)
    assert out.columns == hard.columns
    left = sorted((r["doc_id"] or 0, len(r["text"] or "")) for r in out.collect())
    texts = {(r[0] or 0, r[1] or "") for r in hard_rows()} - {(2, "")}  # 1 and 2 have equal texts; so have 5 and 6
    assert left == sorted((d, len(t)) for d, t in texts if d != 6)


def test_empty_table(spark):
    assert jaccard.similarity_classes(docs(spark, [])).count() == 0


def test_rest_of_a_group_meets_all_its_members_in_blocks(spark):
    """Components that only non-centres link are joined by the block step."""
    base = prose(5, 200).split()
    a, b = base[:], base[:]
    for i in range(0, 18):
        a[i] = f"a{i}"
    for i in range(182, 200):
        b[i] = f"b{i}"
    members = [{"node": bytes([i]), "label": bytes([i]), "text": " ".join(w)} for i, w in enumerate((a, base, b))]
    places = jaccard.Signer(1, 1).places
    links = set(jaccard.block_links(members, members, 0.8, 5, places))
    assert links == {(b"\x01", b"\x00"), (b"\x02", b"\x01")}


def test_components_of_a_long_chain(spark):
    nodes = [bytes([i]) for i in range(40)]
    links = spark.createDataFrame([(b, a) for a, b in zip(nodes, nodes[1:], strict=False)], "a binary, b binary")
    got = jaccard.components(links).collect()
    assert len(got) == 40 and {bytes(r["label"]) for r in got} == {nodes[0]}


def links(rows):
    """n_links of every distinct text: the different texts that reach the threshold, and its copies."""
    sets = {r[1] or "": jaccard.shingle_set(r[1]) for r in rows}
    copies = [r[1] or "" for r in rows]
    return {t: sum(u != t and jaccard.similar(s, v, 0.8) for u, v in sets.items()) + copies.count(t) - 1 for t, s in sets.items()}


def test_n_links_matches_brute_force(spark, monkeypatch):
    """Also in a group larger than all centres of its members' buckets, and cut into several blocks."""
    base = prose(77, 300).split()
    group = [" ".join([*base[:3 * i], f"edit{i}", *base[3 * i + 1 :]]) for i in range(95)]
    rows = near_rows() + [(9000 + i, t, "en", "s", 1) for i, t in enumerate([*group, group[0], group[5]])] + [(r[0] and 20_000 + r[0], *r[1:]) for r in hard_rows()[:8]]
    want = links(rows)
    assert want[group[1]] == 94 and want[group[5]] == 95
    for block in (jaccard.BLOCK_BYTES, 40_000):
        monkeypatch.setattr(jaccard, "BLOCK_BYTES", block)
        df = docs(spark, rows)
        got = jaccard.similarity_classes(df).join(df.select("doc_id", "text"), "doc_id").where("doc_id IS NOT NULL").collect()
        assert {(r["text"] or "", r["n_links"]) for r in got} == {(r[1] or "", want[r[1] or ""]) for r in rows if r[0] is not None}


def exact_links(rows):
    """(links, copies) of every row by all pairs that share a shingle, on plain sets."""
    texts = {}
    for i, (_, text, *_) in enumerate(rows):
        texts.setdefault(text or "", []).append(i)
    shingles, index = [], {}
    for k, t in enumerate(texts):
        w = [x for x in re.split("[ \t\n\x0b\x0c\r]+", t) if x]
        shingles.append({" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
        for s in shingles[k]:
            index.setdefault(s, []).append(k)
    near = {k: set() for k in range(len(shingles))}
    for k, mine in enumerate(shingles):
        shared = Counter(j for s in mine for j in index[s] if j != k)
        near[k] = {j for j, n in shared.items() if n >= 0.8 * (len(mine) + len(shingles[j]) - n)}
    where = list(texts.values())
    return {i: (len(near[k]) + len(where[k]) - 1, len(where[k]), near[k], k) for k, rows_ in enumerate(where) for i in rows_}


def test_links_of_the_queries_on_the_corpus(spark):
    """Every row whose id is divisible by 20 against all rows: no link is lost, none is added."""
    if not os.path.isdir("/root/testdata/sf0.01"):
        pytest.skip("no test data here")
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    want = exact_links(rows)
    got = {r["doc_id"]: r for r in jaccard.similarity_classes(df).collect()}
    by_text = {}
    for i, (doc_id, _) in enumerate(rows):
        by_text.setdefault(want[i][3], []).append(doc_id)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id % 20 == 0:
            links, copies, near, k = want[i]
            assert (got[doc_id]["n_links"], got[doc_id]["n_copies"]) == (links, copies)
            assert {got[d]["class_id"] for j in {k, *near} for d in by_text[j]} == {got[doc_id]["class_id"]}


def test_scratch_tables_are_dropped(spark):
    from pathlib import Path

    from nephos.session import shared_path

    folder = Path(shared_path(spark, "").removeprefix("file:"))
    rows = [(i, edited(prose(i % 40, 90), 60 + i), "en", "s", 1) for i in range(200)]
    before = set(folder.iterdir())
    jaccard.keep_one(docs(spark, rows)).count()
    assert {p.name.rsplit("-", 1)[0] for p in set(folder.iterdir()) - before} == {"chosen"}
    before = set(folder.iterdir())
    jaccard.similarity_classes(docs(spark, rows)).count()
    assert {p.name.rsplit("-", 1)[0] for p in set(folder.iterdir()) - before} == {"signed", "classes"}
