import random
import zlib

import numpy as np
import pytest

from nephos.llm import token_counts as C
from nephos.llm import token_store as S
from nephos.llm.queries import tokenizer_path
from tests.llm.helpers import docs, hard_rows, prose, with_clashing_columns

WORDS, PIECES = tokenizer_path("word_bpe_49k.json"), tokenizer_path("piece_bpe_32k.model")
ODD = ["it's we'll I'M", "a\x1cb\x85c d", "<|endoftext|>x <|startoftext|>", "ΣΑΣ İ ŉ ǅ", "áé", "x²³¹¼½ 12ab", "''s !'s _a_ -- ...", "퟿ tab\tnew\nline\r", "Ünïcödé ß ﬁ"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORDS)


def test_cached_encoding_equals_the_library(library):
    texts = ODD + [r[1] or "" for r in hard_rows()] + [f"a{chr(c)}b {chr(c)}s '{chr(c)} {chr(c)}9" for c in range(0x330)]
    want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert S.WordEncoder(WORDS).encode(texts) == want
    cold = S.WordEncoder(WORDS)
    assert [cold.encode([t])[0] for t in texts] == want


@pytest.mark.parametrize("bits", [False, True])
def test_segment_round_trip(bits):
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 2**32, 1000, dtype=np.uint32)
    seg = S.Segment(S.write_segment([3, None, -5], [10, 0, 990], ids, 77, block=128, bits=bits))
    assert (seg.ids() == ids).all() and seg.doc_ids == [3, None, -5] and seg.counts.tolist() == [10, 0, 990] and seg.before == 77
    assert (seg.block(3) == ids[384:512]).all() and seg.n_blocks == 8


def test_empty_segment_and_wrong_bytes():
    assert S.Segment(S.write_segment([], [], np.empty(0, np.uint32), 0)).ids().size == 0
    with pytest.raises(ValueError):
        S.Segment(b"x" * 80)


def brute_store(rows, library):
    out, at = [], 0
    for doc_id, text in sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_store_matches_brute_force(spark, library, monkeypatch):
    rows = hard_rows() + [(1000 - i, prose(i, 40), "en", "s", 1) for i in range(120)]
    df = with_clashing_columns(docs(spark, rows))
    got = S.read_segments(S.write_segments(df, WORDS)).orderBy("start").collect()
    assert [tuple(r) for r in got] == brute_store(rows, library)


def test_store_of_an_empty_table(spark):
    assert S.read_segments(S.write_segments(docs(spark, []), WORDS)).count() == 0


def library_count(vocabulary, text, all_bytes=True):
    from tokenizers import Tokenizer
    from tokenizers.models import Unigram

    model = Tokenizer(Unigram(vocabulary, unk_id=0, byte_fallback=all_bytes))
    return len(model.encode(C.SPACE + text.replace(" ", C.SPACE)).ids) if text else 0


def test_counts_equal_the_unigram_library():
    vocabulary = C.load_vocabulary(PIECES)
    model = C.CountViterbi(vocabulary)
    assert model.word is not None
    from tokenizers import Tokenizer
    from tokenizers.models import Unigram

    unigram = Tokenizer(Unigram(vocabulary, unk_id=0, byte_fallback=True))
    for text in ODD + [r[1] or "" for r in hard_rows()] + ["  two  spaces  ", "\n\n", " ", "<0x41>", "<unk>"]:
        want = len(unigram.encode(C.SPACE + text.replace(" ", C.SPACE)).ids) if text else 0
        assert model.count(text)[0] == want, text


def test_ties_and_scores_equal_the_library_on_random_vocabularies():
    rng = random.Random(2)
    for trial in range(60):
        pieces = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(12)} | {C.SPACE}
        vocabulary = [("<unk>", 0.0)] + [(p, float(-rng.randint(1, 4)) if trial % 2 else -rng.random()) for p in sorted(pieces)]
        model = C.CountViterbi(vocabulary)
        text = "".join(rng.choice("abc") for _ in range(25))
        assert model.count(text)[0] == library_count(vocabulary, text, False)


def brute_best(text, scores, unknown):
    """Least tokens among the best paths is not the rule; only the best score is compared."""
    best = [0.0] + [None] * len(text)
    for end in range(1, len(text) + 1):
        options = [best[a] + scores[text[a:end]] for a in range(end) if text[a:end] in scores]
        if text[end - 1] not in scores:
            options.append(best[end - 1] + unknown)
        best[end] = max(options)
    return best[-1]


def test_best_scores_match_brute_force():
    model = C.CountViterbi(C.load_vocabulary(PIECES))
    for text in ("hello world again", prose(4, 30), "日本 xyz"):
        assert model.count(text)[1] == brute_best(C.SPACE + text.replace(" ", C.SPACE), model.scores, model.unknown)


def test_counts_over_hard_rows(spark):
    model = C.CountViterbi(C.load_vocabulary(PIECES))
    got = sorted((r["doc_id"] or 0, r["n_tokens"]) for r in C.token_counts(with_clashing_columns(docs(spark)), PIECES).collect())
    assert got == sorted((r[0] or 0, model.count(r[1])[0]) for r in hard_rows())
    assert C.token_counts(docs(spark, []), PIECES).count() == 0


def test_segments_are_files_whose_headers_give_the_totals(spark, library, tmp_path):
    rows = [(i, prose(i, 30), "en", "s", 1) for i in range(60)]
    folder = tmp_path / "segments"
    folder.mkdir()
    S.write_segments(docs(spark, rows), WORDS, folder=f"file://{folder}")
    files = sorted(folder.glob("*.nts"))
    assert files and not [f for f in folder.iterdir() if f.name.startswith("_attempt") and not f.name.endswith(".crc")]
    segments = [S.Segment(f.read_bytes()) for f in files]
    want = brute_store(rows, library)
    assert sum(s.n_ids for s in segments) == sum(r[2] for r in want)
    before = files[0].read_bytes()
    S.write_segments(docs(spark, rows), WORDS, folder=f"file://{folder}")
    assert sorted(folder.glob("*.nts")) == files and files[0].read_bytes() == before
    again = S.read_segments(S.segment_files(spark, f"file://{folder}")).orderBy("start").collect()
    assert [tuple(r) for r in again] == want


def test_put_file_replaces_and_hides_attempts(tmp_path):
    S.put_file(f"file://{tmp_path}", "a.nts", b"one", 1)
    S.put_file(f"file://{tmp_path}", "a.nts", b"two", 2)
    assert [f.name for f in tmp_path.iterdir()] == ["a.nts"] and (tmp_path / "a.nts").read_bytes() == b"two"


def test_other_tokenizers_get_whole_texts():
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    other, plain = S.WordEncoder(path), Tokenizer.from_file(path)
    texts = [*ODD, "It's  two  spaces"]
    assert not other.by_word and S.WordEncoder(WORDS).by_word
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in other.encode(texts)] == want and other.lengths(texts) == [len(x) for x in want]


def test_scores_are_log_probabilities_by_place():
    import math

    vocabulary = C.load_vocabulary(PIECES)
    spelt = [(p, s) for p, s in vocabulary if s != C.RARE]
    assert len(vocabulary) - len(spelt) == 257 and vocabulary[0] == ("<unk>", C.RARE)
    assert sum(math.exp(s) for _, s in spelt) == pytest.approx(1, abs=1e-3)
    assert all(a >= b for (_, a), (_, b) in zip(spelt, spelt[1:], strict=False)) and all((s * C.STEPS).is_integer() for _, s in spelt)
    model = C.CountViterbi(vocabulary)
    assert model.count("<0x41>")[0] > 1 and model.count("<unk>")[0] > 1 and model.count("the")[0] == 1


def test_words_joined_equal_whole_texts():
    model = C.CountViterbi(C.load_vocabulary(PIECES))
    for text in [*ODD, prose(9, 80), "  two  spaces  \n\n x", "日本 a 😀😀 b"]:
        assert model.count(text) == model.best(C.SPACE + text.replace(" ", C.SPACE))


def test_words_are_numbers_and_counts_travel_packed(spark, monkeypatch):
    """A known word is not learnt again, ids are the library's over a small memory, and what is written for the topics is bytes."""
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    from nephos.llm import mixing, token_store, topics

    path = public_tokenizers.path("word_bpe_49k.json")
    library, texts = Tokenizer.from_file(path), ["Straße, naïve 'tis 1²\x01\x85x", None, "", "日本 Foo, İx <|pad|>", "the naïve the", "á " * 40]
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    held = token_store.WordEncoder(path)
    for limit in (250_000, 2):
        monkeypatch.setattr(token_store, "CACHED_WORDS", limit)
        ids, sizes = held.flat_ids(texts)
        assert ids.tolist() == [i for w in want for i in w] and sizes.tolist() == held.lengths(texts) == [len(w) for w in want]
        monkeypatch.setattr(token_store, "CACHED_WORDS", 250_000)
        known = len(held.known)
        assert held.encode(texts) == [np.array(w, "<u4").tobytes() for w in want] and len(held.known) == known
    lists = topics.count_lists(ids, sizes)
    assert [sum(n) for n in lists[1].to_pylist()] == sizes.tolist()
    for found, kind in zip(lists, (np.int16, np.int32), strict=True):
        assert topics.unpacked(topics.packed(found), kind).equals(found)
        assert topics.unpacked(topics.packed(found).slice(3, 3), kind).to_pylist() == found.to_pylist()[3:]
    docs = spark.createDataFrame([(1, "the cat", "en", "a")], "doc_id int, text string, lang string, source string")
    assert {f.name: f.dataType.simpleString() for f in mixing.keyed(docs, tokenizer=path).schema.fields if f.name in ("_at", "_n")} == {"_at": "binary", "_n": "binary"}
