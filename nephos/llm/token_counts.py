"""Token counts by count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton lists every vocabulary piece in a word; a forward pass
keeps, for each end, the best score and its number of pieces, nothing else, so no
segmentation is built.  Ties follow the tokenizers library's Unigram model: a
later candidate must be strictly better and starts come in order, so the piece
with the earliest start stays; an unknown character competes only where no
one-character piece starts, at the least score less 10, and falls back to its
UTF-8 bytes, or without byte pieces joins the unknown characters before it.

No public file here is a unigram model, and tokenizers are never trained, so a
piece's log-probability follows by rule from its place in the public piece file,
which lists pieces by falling frequency: Zipf's law as Mandelbrot has it,
p ~ 1 / (place + OFFSET), in steps of 1 / STEPS.  The unknown piece and the byte
pieces stand for characters without a piece; they score RARE, less than any
spelling of their names, so no plain text is one of them.

No piece crosses from another character into a space mark, so a text's best path
is the best paths of its words joined; scores are whole numbers of steps, whose
sums are exact in a double, which keeps ties the same either way.  Both are
checked when a vocabulary is loaded; without them, or without byte pieces, whole
texts are run.

Defined cases: a null text counts as empty, with 0 tokens and score 0; a very
long text takes memory in proportion to its longest word, or to its length where
whole texts are run; a null doc_id passes through; repeated rows give repeated
results; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from nephos.llm.common import map_arrow

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
#: Mandelbrot's offset, the steps of a score, and the score of pieces that no text spells.
OFFSET, STEPS, RARE = 2.7, 1024, -100.0
CACHED_WORDS = 500_000


def load_vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, log-probability) of a sentencepiece file by the pieces' places, without its control pieces."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    kept = [i for i in range(model.vocab_size()) if not model.is_control(i)]
    spelt = [i for i in kept if not (model.is_unknown(i) or model.is_byte(i))]
    mass = sum(1 / (k + OFFSET) for k in range(len(spelt)))
    score = {i: round(-math.log((k + OFFSET) * mass) * STEPS) / STEPS for k, i in enumerate(spelt)}
    return [(model.id_to_piece(i), score.get(i, RARE)) for i in kept]


class CountViterbi:
    """Best score and piece count under a unigram vocabulary."""

    def __init__(self, vocabulary: list[tuple[str, float]]):
        self.scores = dict(vocabulary)
        self.unknown = min(self.scores.values()) - UNKNOWN_PENALTY
        self.all_bytes = all(f"<0x{b:02X}>" in self.scores for b in range(256))
        self.automaton = ahocorasick.Automaton()
        for piece, score in self.scores.items():
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        whole = all(float(s * STEPS).is_integer() for s in self.scores.values())
        crossing = any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.scores)
        breaks = any("\n" in p for p in self.scores)
        word = f"{SPACE}*[^{SPACE}]+|{SPACE}+" if breaks else f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n"
        self.word = re.compile(word) if whole and not crossing and self.all_bytes else None
        self.known: dict[str, tuple[int, float]] = {}

    def best(self, text: str) -> tuple[int, float]:
        """(pieces, score) of the best path through ``text``."""
        n = len(text)
        score, count, joined = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)

        def close(end: int, best: float | None, pieces: int, single: bool) -> None:
            """Settle ``end``; an unknown last character competes if no piece is that character."""
            at = end - 1
            if not single and (best is None or score[at] + self.unknown > best):
                best = score[at] + self.unknown
                pieces = count[at] + (len(text[at].encode("utf-8", "surrogatepass")) if self.all_bytes else 1 - joined[at])
                joined[end] = True
            score[end], count[end] = best, pieces

        end, best, pieces, single = 0, None, 0, True
        for last, (size, value) in self.automaton.iter(text):  # by end, longest first
            if last + 1 != end:
                if end:
                    close(end, best, pieces, single)
                for gap in range(end + 1, last + 1):
                    close(gap, None, 0, False)
                end, best, single = last + 1, None, False
            at = end - size
            found = score[at] + value
            if best is None or found > best:
                best, pieces = found, count[at] + 1
            if size == 1:
                single = True
        if end:
            close(end, best, pieces, single)
        for gap in range(end + 1, n + 1):
            close(gap, None, 0, False)
        return count[n], score[n]

    def count(self, text: str | None) -> tuple[int, float]:
        """(tokens, score) of a whole text with its leading space mark."""
        if not text:
            return 0, 0.0
        marked = SPACE + text.replace(" ", SPACE)
        if self.word is None:
            return self.best(marked)
        known, tokens, total = self.known, 0, 0.0
        if len(known) > CACHED_WORDS:
            known.clear()
        for w in self.word.findall(marked):
            found = known.get(w)
            if found is None:
                found = known[w] = self.best(w)
            tokens += found[0]
            total += found[1]
        return tokens, total


_MODELS: dict[str, CountViterbi] = {}


def model(path: str) -> CountViterbi:
    if path not in _MODELS:
        _MODELS[path] = CountViterbi(load_vocabulary(path))
    return _MODELS[path]


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and score of every document."""
    out = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("score", pa.float64())])

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        counted = [model(path).count(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), pa.array([c for c, _ in counted], pa.int64()), pa.array([s for _, s in counted], pa.float64())], schema=out
        )

    return map_arrow(docs.select("doc_id", "text"), run, "doc_id bigint, n_tokens bigint, score double")
