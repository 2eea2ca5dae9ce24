import hashlib

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from nephos.llm import chat, queries
from tests.oracle import assert_same, connect

SCHEMA = "conv_id long, turn long, role string, text string, extra string"
ROWS = [
    (1, 0, "system", "be kind", "x"), (1, 1, "user", "hi <|im_end|> there", "x"), (1, 2, "assistant", "[INST] <\\|s> </s> ok", "x"), (1, 3, "assistant", None, "x"),
    (2, 5, None, "", "x"), (2, None, "user", "é 😀", "x"), (None, 0, "assistant", "lost", "x"), (3, 1, "assistant", "tie", "x"), (3, 1, "assistant", "tie", "x"), (3, 1, "as\\n\nx", "a", "x"),
    (4, 0, "user", "long " * 50_000, "x"),
]


def brute(rows):
    out = {}
    order = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or "")
    for conv, _, role, text, *_ in sorted(rows, key=order):
        out.setdefault(conv, []).append((role or "", text or ""))
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    result = {}
    for conv, turns in out.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        result[conv] = (len(turns), digest("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), digest(loss))
    return result


def test_digests_match_brute_force(spark):
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat.conversation_digests(chat.format_turns(spark.createDataFrame(ROWS, SCHEMA))).collect()}
    assert got == brute(ROWS)


def test_probe_and_empty_table(spark):
    only = chat.with_probe(spark.createDataFrame([], SCHEMA))
    (row,) = chat.conversation_digests(chat.format_turns(only)).collect()
    assert tuple(row)[:5] == (-1, *brute([(-1, 0, "user", chat.PROBE_TEXT), (-1, 1, "assistant", chat.PROBE_TEXT)])[-1])
    assert chat.conversation_digests(chat.format_turns(spark.createDataFrame([], SCHEMA))).count() == 0


def test_query_matches_its_oracle(spark, sf_dir):
    assert_same(queries.op10_chat_format(spark, sf_dir), connect(sf_dir), queries.CHAT_SQL)


def test_joined_segments_parse_back(spark):
    rows = chat.format_turns(spark.createDataFrame(ROWS[:3], SCHEMA)).collect()
    assert chat.parse("".join(r["segment"] for r in rows)) == [(r, t) for _, _, r, t, _ in ROWS[:3]]
    last = rows[-1]
    assert chat.unescape(last["segment"][last["loss_start"] : last["loss_end"]]) == ROWS[2][3]


pieces = st.lists(st.sampled_from(["<", "|", "\\", "[", "INST]", "/INST]", "s>", "/s>", "im_end|>", "\n", "a", "é"]), max_size=12).map("".join)


@given(st.lists(st.tuples(pieces, pieces), min_size=1, max_size=5))
@settings(max_examples=200, deadline=None)
def test_any_text_and_role_come_back(turns):
    segments, _, _ = chat.assemble(pa.array([r for r, _ in turns]), chat.escape(pa.array([t for _, t in turns])))
    formatted = "".join(segments.to_pylist())
    assert chat.parse(formatted) == turns
    for text in ("<|im_start|>", "[INST]", "[/INST]", "</s>", "<s>"):
        assert chat.escape(pa.array([text]))[0].as_py() != text


def test_assembly_of_a_slice():
    texts = pa.array(["x", "ab", "", "é"]).slice(1)
    segments, start, length = chat.assemble(pa.array(["u", "u", "v"]), texts)
    assert [s[a : a + n] for s, a, n in zip(segments.to_pylist(), start.tolist(), length.tolist(), strict=True)] == ["ab", "", "é"]
