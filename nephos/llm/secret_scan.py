"""Secret scans: fixed patterns, and a randomness test battery with false-discovery control.

Three patterns give the base spans.  Beside them every run of 20 or more token
characters that no base span covers is a candidate.  Its encoding is inferred from
its characters; then

*   chi-squared uniformity over the encoding's alphabet, a runs test about the
    alphabet's middle and lag-1 serial correlation each give a p-value for
    "uniform random"; Fisher's method combines them, and a candidate below
    ``ALPHA`` isn't random;
*   a score says how much less likely an ordinary run is to be the candidate than a
    uniform random string of the encoding and length: identifiers by what the three
    tests look at (the shares of its symbols, the runs of its character classes, and
    steps to the same, the next or a neighbouring key's symbol), and encoded text by
    what decoding gives.

Candidates that fail the battery score 0.  The score becomes a p-value by its own
distribution over ordinary runs of the same encoding and length stratum (doubling
lengths): every document gives some, made of its own words in the ways that
identifiers, paths, keyboard rows and encoded prose are written (``ordinary_runs``).
Where at least TAIL_RUNS of them score as high, their share is the p-value; beyond
that it falls on as the likelihood ratio does.  Few runs of a kind are pooled with
the other encodings of their stratum, then with all.  Benjamini-Hochberg control at
``FDR`` runs over all candidates of the corpus, each stratum by itself, from
histograms of quantised scores whose size is bounded by strata, encodings and levels.

The three tests' own p-values are for "random", the very hypothesis that a
discovery means, so they can't be what the control ranks; ordinary runs are what a
false discovery would be, so their scores can.

Defined cases: a null text counts as empty; a very long text or run is read whole,
in time in proportion to its length; a null doc_id passes through; repeated rows
give repeated results; extra columns are ignored by ``secret_spans`` and kept by
``redact``, whatever their names; an empty table gives no thresholds and no rows.
Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import base64
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import accumulate, groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nephos.llm.common import map_arrow

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
SHORTEST = 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
PART = re.compile(r"[A-Za-z0-9+/_-]+")
PIECES = (re.compile(r"[A-Za-z0-9+/]+"), re.compile(r"[A-Za-z0-9_-]+"))
ALPHA = 0.001
FDR = 0.01
#: Chance that neighbouring characters of an ordinary identifier differ in class.
CLASS_CHANGE = 0.12
#: Chance of lower case after upper case where words are capitalised.
CAPITALISED = 0.8
#: Chance of the same symbol again, and of the alphabet's next one.
STEP = 0.05
#: Chance that a walk over the keyboard goes on to a key beside the last, and rows of keys.
WALK_ON = 0.9
KEY_ROWS = ("qwertyuiop", "asdfghjkl", "zxcvbnm")
#: Ordinary runs that must score as high for their share to be the p-value, and that a cell needs to stand for itself.
TAIL_RUNS, LEAST_RUNS = 20, 200
#: Letters in a thousand of running text, about the mean of English, German, French and Spanish.
LETTER_SHARES = [87, 14, 34, 47, 144, 14, 17, 30, 68, 4, 6, 45, 28, 76, 61, 19, 6, 66, 74, 68, 43, 12, 11, 2, 8, 5]
LEVELS_PER_DECADE, MOST_LEVEL = 10, 3000
DIGITS, UPPER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: Alphabets in the order of inference; the first that holds all characters is taken.
ENCODINGS = {
    "hex": DIGITS + LOWER[:6],
    "hex_upper": DIGITS + UPPER[:6],
    "lower": LOWER,
    "upper": UPPER,
    "base32": UPPER + DIGITS[2:8],
    "base36": DIGITS + LOWER,
    "base36_upper": DIGITS + UPPER,
    "base62": DIGITS + UPPER + LOWER,
    "base64": UPPER + LOWER + DIGITS + "+/",
    "base64url": UPPER + LOWER + DIGITS + "-_",
}
_NAMES = list(ENCODINGS)
_BESIDE = {(x, y) for row in KEY_ROWS for a, b in zip(row, row[1:], strict=False) for x, y in ((a, b), (b, a), (a.upper(), b.upper()), (b.upper(), a.upper()))}
_PLACES = {name: {c: i for i, c in enumerate(chars)} for name, chars in ENCODINGS.items()}
Span = tuple[int, int, int]
CELLS = 16
WORD = re.compile(r"(?<![A-Za-z0-9])[A-Za-z]{2,14}(?![A-Za-z0-9])")
#: Ways of writing ordinary runs, of which a text gives so many.
WAYS, WAYS_A_TEXT = 13, 4


def infer_encoding(body: str) -> str | None:
    """The smallest known alphabet of ``body``; None for anything else, and for numbers and listings of the alphabet.

    Ordinary numbers are as uniform as random ones, so no test tells them apart.
    """
    used = set(body)
    if used <= set(DIGITS) or all(ord(y) - ord(x) == 1 for x, y in zip(body, body[1:], strict=False)):
        return None
    if used <= set(LOWER) or used <= set(UPPER):
        return "lower" if used <= set(LOWER) else "upper"
    return next((n for n, at in _PLACES.items() if used <= at.keys()), None)


def _tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def uniformity_p(at: list[int], size: int) -> float:
    """Chi-squared against equal shares, with exact moments (cells may expect under one)."""
    n = len(at)
    x = size / n * sum(c * c for c in Counter(at).values()) - n
    mean, var = size - 1, 2 * (size - 1) * (n - 1) / n
    df = 2 * mean * mean / var
    return _tail(((max(x, 0) / mean) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df)))


def runs_p(at: list[int], size: int) -> float:
    """Wald and Wolfowitz's runs test about the alphabet's middle, two-sided."""
    high = [2 * x >= size for x in at]
    a = sum(high)
    b = len(high) - a
    if not a or not b:
        return 2.0 ** (1 - len(high))
    n, runs = a + b, 1 + sum(x != y for x, y in zip(high, high[1:], strict=False))
    mean, var = 1 + 2 * a * b / n, 2 * a * b * (2 * a * b - n) / (n * n * (n - 1))
    return 1.0 if var <= 0 else min(1.0, 2 * _tail(abs(runs - mean) / math.sqrt(var)))


def serial_p(at: list[int]) -> float:
    """Lag-1 serial correlation, two-sided."""
    n = len(at)
    mean = sum(at) / n
    var = sum((x - mean) ** 2 for x in at)
    if not var:
        return 0.0
    r = sum((x - mean) * (y - mean) for x, y in zip(at, at[1:], strict=False)) / var
    return min(1.0, 2 * _tail(abs(r + 1 / n) * math.sqrt(n)))


def fisher(ps: list[float]) -> float:
    """Fisher's combination: an upper tail of chi-squared with 2k degrees of freedom."""
    half = -sum(math.log(max(p, 1e-300)) for p in ps)
    term = total = 1.0
    for i in range(1, len(ps)):
        term *= half / i
        total += term
    return min(1.0, math.exp(-half) * total)


def _class(c: str) -> int:
    return 0 if c in DIGITS else 1 if c in LOWER else 2 if c in UPPER else 3


def _share(c: str) -> float:
    """Share of a symbol among those of its class."""
    kind = _class(c)
    return 0.1 if kind == 0 else 0.25 if kind == 3 else LETTER_SHARES[ord(c.lower()) - ord("a")] / sum(LETTER_SHARES)


def _next_share(x: str, y: str) -> float:
    """Share of ``y`` after ``x`` of its class."""
    return (1 - 2 * STEP) * _share(y) + STEP * ((x == y) + (ord(y) - ord(x) == 1))


def identifier_bits(body: str) -> float:
    """-log2 of the likelihood of an ordinary identifier, with words capitalised or not, or of walks over the keyboard."""
    plain = capitalised = 2 - math.log2(_share(body[0]))
    for x, y in zip(body, body[1:], strict=False):
        a, b = _class(x), _class(y)
        symbol = -math.log2(_next_share(x, y) if a == b else _share(y))
        move = 1 - CLASS_CHANGE if a == b else CLASS_CHANGE / 3
        plain += symbol - math.log2(move)
        if a == 2:
            move = CAPITALISED if b == 1 else (1 - CAPITALISED) / 3
        capitalised += symbol - math.log2(move)
    return _either(_either(plain, capitalised), walk_bits(body))


def walk_bits(body: str) -> float:
    """-log2 of the likelihood of a string that steps along the keyboard and jumps now and then."""
    steps = sum(pair in _BESIDE for pair in zip(body, body[1:], strict=False))
    return 6 + steps * (1 - math.log2(WALK_ON)) + (len(body) - 1 - steps) * (6 - math.log2(1 - WALK_ON))


def _either(one: float, two: float) -> float:
    """Bits of an even mixture of two likelihoods."""
    low, high = sorted((one, two))
    return low + 1 - math.log2(1 + 2.0 ** (low - high))


def encoded_bits(body: str, encoding: str) -> float:
    """-log2 of the likelihood of encoded running text, at the best offset; infinite for what no text encodes to."""
    best = math.inf
    if encoding in ("base62", "base64", "base64url", "lower", "upper", "base36", "base36_upper"):
        for skip in range(4):
            part = body[skip : skip + (len(body) - skip) // 4 * 4].replace("-", "+").replace("_", "/")
            best = min(best, _text_bits(base64.b64decode(part)) + 6 * (len(body) - len(part)))
    if encoding in ("base32", "upper"):
        for skip in range(8):
            part = body[skip : skip + (len(body) - skip) // 8 * 8]
            best = min(best, _text_bits(base64.b32decode(part)) + 5 * (len(body) - len(part)))
    if encoding in ("hex", "hex_upper"):
        for skip in range(2):
            part = body[skip : skip + (len(body) - skip) // 2 * 2]
            best = min(best, _text_bits(bytes.fromhex(part)) + 4 * (len(body) - len(part)))
    return best


def _text_bits(data: bytes) -> float:
    """Bits of bytes as running text: letters and blanks are likely, other signs less so, what no text holds breaks it off."""
    if not data:
        return math.inf
    text = data.decode("utf-8", "ignore")
    lost = len(data) - len(text.encode())
    signs = sum(not (c.isalpha() or c == " ") for c in text)
    broken = lost + sum(not (c.isprintable() or c in "\n\t\r") for c in text)
    return 4.7 * len(text) + 4 * signs + 12 * broken + 2 * (len(data) - len(text)) if broken * 8 <= len(data) else math.inf


def identifier_p(body: str, encoding: str, ways: int = 1) -> float:
    """Ordinary over random likelihood, for the best of all encodings and of so many ways to cut the run."""
    uniform = len(body) * math.log2(len(ENCODINGS[encoding])) + math.log2(len(ENCODINGS) * ways)
    ordinary = identifier_bits(body)
    text = encoded_bits(body, encoding)
    return 2.0 ** min(0.0, max(uniform - (ordinary if text == math.inf else _either(ordinary, text)), -1000.0))


def scored(body: str, ways: int = 1) -> tuple[str, int] | None:
    """Encoding and quantised score of a candidate, rounded down; None if it has no known encoding."""
    body = body.rstrip("=")
    name = infer_encoding(body) if len(body) >= 16 else None
    if name is None:
        return None
    at, size = [_PLACES[name][c] for c in body], len(ENCODINGS[name])
    if fisher([uniformity_p(at, size), runs_p(at, size), serial_p(at)]) < ALPHA:
        return name, 0
    p = identifier_p(body, name, ways)
    return name, min(MOST_LEVEL, int(-math.log10(p) * LEVELS_PER_DECADE))


def candidate_level(body: str, ways: int = 1) -> int | None:
    """The score of a candidate; None if it has no known encoding."""
    found = scored(body, ways)
    return None if found is None else found[1]


def cell_of(length: int, encoding: str) -> int:
    """Length stratum and encoding in one number."""
    return length.bit_length() * CELLS + _NAMES.index(encoding)


def ordinary_runs(text: str) -> list[str]:
    """Runs that are no secrets, 20 to over 60 characters long, from words at a place of the text that its hash picks: names, paths, keyboard rows and encoded prose."""
    words = WORD.findall(text)
    if len(words) < 3:
        return []
    turn = zlib.crc32(text.encode("utf-8", "surrogatepass"))
    first = turn % len(words)
    least = (20, 28, 40, 64)[turn // 7 % 4]
    taken: list[str] = []
    n = 0
    for k in range(len(words)):
        if n >= least:
            break
        taken.append(words[(first + k) % len(words)])
        n += len(taken[-1])
    if n < least:
        return []
    return [_written(taken, (turn // 31 + k * 3) % WAYS, turn, least) for k in range(WAYS_A_TEXT)]


def _written(words: list[str], way: int, turn: int, least: int) -> str:
    lower, number, prose = [w.lower() for w in words], str(turn % 3000), " ".join(words).encode()
    if way == 0:
        return "".join(lower)
    if way == 1:
        return "".join(w.capitalize() for w in words)
    if way == 2:
        return "_".join(lower)
    if way == 3:
        return "/".join(words)
    if way == 4:
        return "_".join(lower).upper() + "_" + number
    if way == 5:
        return "-".join(lower) + "-" + number
    if way == 6:
        return "".join(words).upper() + number
    if way == 7:
        return "".join(lower) + number
    if way == 8:
        return lower[0] + "".join(w.capitalize() for w in words[1:]) + number
    if way == 9:
        return base64.b64encode(prose).decode().rstrip("=")
    if way == 10:
        return base64.b32encode(prose).decode().rstrip("=")
    if way == 11:
        return prose.hex().upper()
    row = "".join(KEY_ROWS)
    return (row[turn % len(row) :] + row * 3)[:least]


def base_spans(text: str) -> list[Span]:
    """(start, rank of the kind, end) of the three patterns, by start and kind."""
    out = [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    if ":" in text or "=" in text:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    return sorted(out)


def disjoint(base: list[Span]) -> list[tuple[int, int]]:
    """(start, end) of what the base spans cover together, in order."""
    out: list[tuple[int, int]] = []
    for start, _, end in base:
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def parts(text: str, base: list[Span]) -> Iterator[tuple[int, int]]:
    """(start, end) of what base spans and interior equals signs leave of the runs; padding stays at its end.

    Runs and covered stretches both come in order, so one pass meets them all.
    """
    covered, k = disjoint(base), 0
    for m in CANDIDATE.finditer(text):
        at, stop = m.span()
        while at < stop:
            while k < len(covered) and covered[k][1] <= at:
                k += 1
            start, end = covered[k] if k < len(covered) and covered[k][0] < stop else (stop, stop)
            last = max(at, start)
            while last > at and text[last - 1] == "=":
                last -= 1
            for part in PART.finditer(text, at, last):
                yield part.start(), start if part.end() == last else part.end()
            at = max(at, end)


def candidates(text: str, base: list[Span]) -> list[tuple[int, int, int, int]]:
    """(start, end, cell, level) of the runs and their parts, beside the base spans.

    A part that no alphabet holds, as it has separators of both kinds, is cut at
    the ones or at the others, whichever finds the less ordinary piece.
    """
    out = []
    for start, end in parts(text, base):
        if end - start < SHORTEST:
            continue
        body = text[start:end].rstrip("=")
        if set(body) & set("+/") and set(body) & set("-_"):
            ways = []
            for piece in PIECES:
                # Padding belongs to the last piece.
                spans = [(start + m.start(), end if m.end() == len(body) else start + m.end()) for m in piece.finditer(body)]
                found = [(s, e, scored(text[s:e], len(PIECES))) for s, e in spans if e - s >= SHORTEST]
                ways.append([(s, e, *x) for s, e, x in found if x is not None])
            found = max(ways, key=lambda w: max((x[3] for x in w), default=-1))
        else:
            x = scored(body)
            found = [] if x is None else [(start, end, *x)]
        out += [(s, e, cell_of(e - s, name), level) for s, e, name, level in found]
    return out


def level_histogram(docs: DataFrame) -> DataFrame:
    """(ordinary, cell, level, n) over the candidates of every document, and over the ordinary runs that its words make."""
    out = pa.schema([("ordinary", pa.bool_()), ("cell", pa.int32()), ("level", pa.int32()), ("n", pa.int64())])

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for text in batch.column(0).to_pylist():
            text = text or ""
            found.update((False, c, v) for _, _, c, v in candidates(text, base_spans(text)))
            for run in ordinary_runs(text):
                if (x := scored(run)) is not None:
                    found[True, cell_of(len(run), x[0]), x[1]] += 1
        rows = [(*k, n) for k, n in found.items()]
        yield pa.RecordBatch.from_pylist([dict(zip(out.names, r, strict=True)) for r in rows], schema=out)

    mapped = map_arrow(docs.select("text"), count, "ordinary boolean, cell int, level int, n bigint")
    return mapped.groupBy("ordinary", "cell", "level").agg(F.sum("n").alias("n"))


class Ordinary:
    """The scores of ordinary runs: p-values of candidates by cell."""

    def __init__(self, histogram: Sequence[tuple[int, int, int]]):
        self.cells: dict[int, Counter] = {}
        for cell, level, n in histogram:
            for key in (cell, cell // CELLS * CELLS + CELLS - 1, -1):  # its own, all of its stratum, all
                self.cells.setdefault(key, Counter())[level] += n
        self._known: dict[int, tuple[int, list[int], list[int]]] = {}

    def _tail(self, cell: int) -> tuple[int, list[int], list[int]]:
        """Runs of the cell, or of the first wider one that has enough, and how many score at least each of its levels, falling."""
        if cell not in self._known:
            wider = [self.cells.get(key, Counter()) for key in (cell, cell // CELLS * CELLS + CELLS - 1, -1)]
            held = next((c for c in wider if sum(c.values()) >= LEAST_RUNS), wider[-1])
            levels = sorted(held, reverse=True)
            self._known[cell] = sum(held.values()), levels, list(accumulate(held[v] for v in levels))
        return self._known[cell]

    def p(self, cell: int, level: int) -> float:
        """The share of ordinary runs that score at least ``level``; past all but TAIL_RUNS of them it falls on by the ratio."""
        total, levels, above = self._tail(cell)
        if not total:
            return 10.0 ** (-level / LEVELS_PER_DECADE)
        as_high = next((n for v, n in zip(reversed(levels), reversed(above), strict=True) if v >= level), 0)
        need = min(TAIL_RUNS, total)
        if as_high >= need:
            return (1 + as_high) / (1 + total)
        start, n = next((v, n) for v, n in zip(levels, above, strict=True) if n >= need)
        return (1 + n) / (1 + total) * 10.0 ** (-(level - start) / LEVELS_PER_DECADE)


def thresholds(histogram: Sequence[tuple[int, int, int]], fdr: float = FDR, ordinary: Ordinary | None = None) -> dict[int, int]:
    """Benjamini and Hochberg's cut of each cell, by strata: the least level that is a discovery.

    Without ordinary runs a level is the ratio's own p-value and each cell a stratum.
    """
    strata: dict[int, list[tuple[float, int, int, int]]] = {}
    for cell, level, n in histogram:
        p = 10 ** (-level / LEVELS_PER_DECADE) if ordinary is None else ordinary.p(cell, level)
        strata.setdefault(cell if ordinary is None else cell // CELLS, []).append((p, cell, level, n))
    out: dict[int, int] = {}
    for found in strata.values():
        total, above, most = sum(n for *_, n in found), 0, -1.0
        for p, same in groupby(sorted(found), lambda x: x[0]):
            above += sum(n for *_, n in same)
            if p <= fdr * above / total:
                most = p
        for p, cell, level, _ in found:
            if p <= most:
                out[cell] = min(level, out.get(cell, level))
    return out


def fit_thresholds(docs: DataFrame, fdr: float = FDR) -> dict[int, int]:
    """The cuts of all candidates of ``docs``; at most 32 strata of ten encodings and MOST_LEVEL levels reach the driver, twice."""
    rows = [tuple(r) for r in level_histogram(docs).collect()]
    return thresholds([r[1:] for r in rows if not r[0]], fdr, Ordinary([r[1:] for r in rows if r[0]]))


def all_spans(text: str, cuts: dict[int, int]) -> tuple[list[Span], list[Span]]:
    """The base spans, and all spans by start and kind."""
    base = base_spans(text)
    more = [(s, 3, e) for s, e, cell, level in candidates(text, base) if cell in cuts and level >= cuts[cell]]
    return base, sorted(base + more)


def spans_text(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def secret_spans(docs: DataFrame, cuts: dict[int, int]) -> DataFrame:
    """doc_id, counts of the base kinds and of the method's, base and spans of every document."""
    names = ["n_assign", "n_access", "n_hex", "n_random"]
    out = pa.schema([("doc_id", pa.int64()), *((n, pa.int64()) for n in names), ("base", pa.string()), ("spans", pa.string())])

    def scan(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        counts, base_text, text_of = [], [], []
        for text in batch.column(1).to_pylist():
            base, spans = all_spans(text or "", cuts)
            kinds = Counter(k for _, k, _ in spans)
            counts.append([kinds[k] for k in range(4)])
            base_text.append(spans_text(base))
            text_of.append(spans_text(spans))
        columns = [pa.array([c[k] for c in counts], pa.int64()) for k in range(4)]
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *columns, pa.array(base_text), pa.array(text_of)], schema=out)

    schema = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_random bigint, base string, spans string"
    return map_arrow(docs.select("doc_id", "text"), scan, schema)


def redact(docs: DataFrame, cuts: dict[int, int], mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span replaced by ``mark``; other rows and columns stay as they are."""

    def clean(text: str | None) -> str | None:
        spans = all_spans(text or "", cuts)[1]
        if not spans:
            return text
        parts, at = [], 0
        for start, _, end in spans:
            if start >= at:
                parts += [text[at:start], mark]
            at = max(at, end)
        return "".join([*parts, text[at:]])

    at = docs.columns.index("text")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = pa.array([clean(t) for t in batch.column(at).to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([texts if i == at else c for i, c in enumerate(batch.columns)], names=docs_names)

    docs_names = docs.columns
    # Names with dots cannot be selected by mapInArrow, so columns go in by number.
    return map_arrow(docs.toDF(*[f"c{i}" for i in range(len(docs_names))]), run, docs.schema)
