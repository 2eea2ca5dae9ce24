"""Token ids in binary segment files: byte or bit planes of fixed-size blocks, zstd, chunk index.

A segment is one self-contained file, little-endian:

    header   magic "NTS2", plane kind, ids a block, documents, ids, ids of the
             shard before it, length of the document table, blocks, planes a
             block, shard, number in the shard
    table    zstd of: null flags (u8), doc ids (i64), token counts (u32)
    index    (offset u64, length u32) of every plane of every block
    planes   zstd frames

Blocks hold a fixed number of ids (the last one fewer); a block's ids are
transposed to planes of equal byte (or bit) significance, so the high planes,
nearly constant, cost almost nothing, and a reader can fetch any block by the
index alone.  Documents never span segments; a segment is closed once it holds
SEGMENT_IDS, so memory is bounded by that and one document.

Documents are range-partitioned by doc_id; each task writes the segments of its
range below the shared folder, first under its attempt's name, then renamed.  A
segment's name and bytes follow from shard, number and rows alone, so a task that
runs again, after a lost executor or beside a slow one, replaces equal bytes.
Everything is read back from the files; global positions follow from the
headers, one total for each shard.

Defined cases: a null text counts as empty (only the end id); a very long text is
one document of one segment; null doc_ids come first; equal doc_ids are ordered
by text, repeated rows stay; extra columns are ignored; an empty table gives no
segments.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nephos.llm.common import map_arrow, slices
from nephos.session import shared_path, ship_package

MAGIC, HEADER = b"NTS2", struct.Struct("<4sBIQQQIIBII")
INDEX = np.dtype([("offset", "<u8"), ("length", "<u4")])
BLOCK_IDS, SEGMENT_IDS = 32_768, 262_144
END_ID = 2
#: Distinct words that a Python worker remembers before it starts anew.
CACHED_WORDS = 250_000
#: Text whose words are counted at once, about.
SLICE_BYTES = 1_048_576


def to_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """The byte planes of u32 ids, or their bit planes."""
    octets = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    if not bits:
        return [p.tobytes() for p in octets]
    return [np.packbits((p >> b) & 1).tobytes() for p in octets for b in range(8)]


def from_planes(planes: list[bytes], n: int, bits: bool) -> np.ndarray:
    octets = np.empty((4, n), np.uint8)
    for k in range(4):
        if bits:
            octets[k] = sum(np.unpackbits(np.frombuffer(planes[8 * k + b], np.uint8), count=n) << b for b in range(8))
        else:
            octets[k] = np.frombuffer(planes[k], np.uint8)
    return np.ascontiguousarray(octets.T).view("<u4").reshape(-1)


def write_segment(doc_ids: list[int | None], counts: list[int], ids: np.ndarray, before: int, block: int = BLOCK_IDS, bits: bool = False, shard: int = 0, number: int = 0) -> bytes:
    """One segment of whole documents."""
    press = zstandard.ZstdCompressor(level=3)
    known = np.array([d or 0 for d in doc_ids], "<i8")
    nulls = np.array([d is None for d in doc_ids], np.uint8)
    table = press.compress(nulls.tobytes() + known.tobytes() + np.array(counts, "<u4").tobytes())
    planes = [press.compress(p) for at in range(0, len(ids), block) for p in to_planes(ids[at : at + block], bits)]
    width = 32 if bits else 4
    sizes = np.array([len(p) for p in planes], np.int64)
    index = np.empty(len(planes), INDEX)
    index["length"] = sizes
    index["offset"] = HEADER.size + len(table) + index.nbytes + np.cumsum(sizes) - sizes
    head = HEADER.pack(MAGIC, bits, block, len(doc_ids), len(ids), before, len(table), len(planes) // width, width, shard, number)
    return b"".join([head, table, index.tobytes(), *planes])


def _head(data: bytes) -> tuple[int, ...]:
    """The header's fields behind the magic."""
    if len(data) < HEADER.size or data[:4] != MAGIC:
        raise ValueError("not a token segment")
    return HEADER.unpack_from(data)[1:]


def shard_and_ids(data: pa.BinaryScalar) -> tuple[int, int]:
    """A segment's shard and number of ids, from its header alone."""
    fields = _head(data.as_buffer()[: HEADER.size].to_pybytes())
    return fields[-2], fields[3]


class Segment:
    """A reader of one segment; ``block`` fetches any block through the index."""

    def __init__(self, data: bytes):
        self.data = data
        bits, self.block_ids, self.n_docs, self.n_ids, self.before, size, self.n_blocks, self.width, self.shard, self.number = _head(data)
        self.bits, self._unpress = bool(bits), zstandard.ZstdDecompressor()
        table, n = self._unpress.decompress(data[HEADER.size : HEADER.size + size]), self.n_docs
        nulls = np.frombuffer(table, np.uint8, n)
        known = np.frombuffer(table, "<i8", n, offset=n)
        self.doc_ids = [None if empty else int(d) for d, empty in zip(known, nulls, strict=True)]
        self.counts = np.frombuffer(table, "<u4", n, offset=9 * n)
        self.index = np.frombuffer(data, INDEX, self.n_blocks * self.width, offset=HEADER.size + size)

    def block(self, k: int) -> np.ndarray:
        n = min(self.block_ids, self.n_ids - k * self.block_ids)
        places = self.index[k * self.width : (k + 1) * self.width]
        planes = [self._unpress.decompress(self.data[int(p["offset"]) : int(p["offset"]) + int(p["length"])]) for p in places]
        return from_planes(planes, n, self.bits)

    def ids(self) -> np.ndarray:
        return np.concatenate([self.block(k) for k in range(self.n_blocks)]) if self.n_blocks else np.empty(0, "<u4")


#: Texts of these characters only can be cut as the tokenizer cuts them: their
#: normal form is themselves, and Python and the library agree on their classes.
_PLAIN = re.compile("[\x00-\x1b\x20-\u012f\u0131-\u024f]*")
#: The tokenizer's own pattern, for lower-cased plain texts, with the letters that those may hold.
_LETTERS = "a-zªµºÀ-ÖØ-öø-ʯⱥⱦ"
_CUT = re.compile(f"[{_LETTERS}]+|[0-9²³¹¼½¾]|'(?:s|t|re|ve|m|ll|d)|[^\\s0-9²³¹¼½¾{_LETTERS}]+")


#: How byte-level models spell the bytes that are no visible Latin-1 characters: by the characters from 256 on.
_SPELT = {b: 256 + k for k, b in enumerate([*range(33), *range(127, 161), 173])}

#: The normalizer and word pattern (fixed values of the public file) that _PLAIN and _CUT stand for.
_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def encodes_words(spec: dict) -> bool:
    """Whether a tokenizers file encodes each word by itself, by the rules that _PLAIN and _CUT know."""
    normalizer, cutter, model = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}, spec["model"]
    split, *rest = cutter.get("pretokenizers") or [{}]
    return (
        normalizer.get("normalizers") == _NORMALIZER
        and (split.get("type"), split.get("pattern"), split.get("behavior"), split.get("invert")) == ("Split", {"Regex": _SPLIT}, "Removed", True)
        and [(x["type"], x.get("add_prefix_space"), x.get("use_regex")) for x in rest] == [("ByteLevel", False, False)]
        and (model["type"], model.get("end_of_word_suffix"), model.get("dropout"), model.get("continuing_subword_prefix")) == ("BPE", "</w>", None, None)
        and all(t["content"].startswith("<|") for t in spec.get("added_tokens") or [])
    )


class Codes(dict):
    """Words by number, in the order in which they were first asked for; ``new`` holds those since it was last emptied."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        code = self[word] = len(self)
        self.new.append(word)
        return code


class WordEncoder:
    """Exact ids of a tokenizers file.

    Where the file's tokens never cross white space and its rules are the known
    ones, each word is encoded by itself: ids of known words come from a bounded
    memory and the library sees new words only.  Plain texts are cut into the
    tokenizer's own words; any other text is cut at white space, and the library
    does the rest.  Any other file's texts go to the library whole.

    A word is looked up once where it stands and is a number from then on; the ids
    of a batch of texts are one gather from the ids of the words known so far.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.by_word = encodes_words(json.loads(self.tokenizer.to_str()))
        self.forget()

    def forget(self) -> None:
        self.known = Codes()
        #: Ids of the known words, one after the other, and where each word's end.
        self.flat, self.stops = np.empty(0, "<u4"), np.zeros(1, np.int64)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _word_ids(self, words: list[str]) -> list[list[int]]:
        """The ids of single words of the tokenizer, by the library's model alone: its normalizer and cutter have nothing left to do."""
        model = self.tokenizer.model.tokenize
        spelt = (w if w.isascii() and w.isprintable() else w.encode().decode("latin-1").translate(_SPELT) for w in words)
        return [[t.id for t in model(w)] for w in spelt]

    def _learn(self, whole: bool) -> None:
        """The ids of the new words; ``whole`` ones are single words of the tokenizer."""
        words, self.known.new = self.known.new, []
        if words:
            found = self._word_ids(words) if whole else self._ids(words)
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(found), "<u4", int(sizes.sum()))])
            self.stops = np.concatenate([self.stops, self.stops[-1] + np.cumsum(sizes)])

    def _codes(self, texts: list[str | None]) -> list[np.ndarray]:
        """The words of each text by number, all of them known from now on."""
        if len(self.known) > CACHED_WORDS:
            self.forget()
        found: list[np.ndarray] = [np.empty(0, np.int32)] * len(texts)
        plain = [not t or ("<|" not in t and _PLAIN.fullmatch(t) is not None) for t in texts]
        number = self.known.__getitem__
        try:
            for single in (True, False):
                for k, text in enumerate(texts):
                    if text and plain[k] is single:
                        words = _CUT.findall(text.lower()) if single else re.split("[ \n\t\r]+", text)
                        found[k] = np.fromiter(map(number, words), np.int32, len(words))
                self._learn(single)
        except BaseException:
            self.forget()
            raise
        return found

    def flat_ids(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each text has."""
        if not self.by_word:
            found = self._ids([t or "" for t in texts])
            return np.concatenate([np.empty(0, "<u4"), *found]), np.array([len(x) for x in found], np.int64)
        codes = self._codes(texts)
        every = np.concatenate([np.empty(0, np.int32), *codes])
        first = self.stops[every]
        sizes = self.stops[every + 1] - first
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.flat[np.repeat(first - ends[:-1], sizes) + np.arange(ends[-1])]
        return ids, np.diff(ends[np.concatenate([[0], np.cumsum([len(c) for c in codes], dtype=np.int64)])])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian u32."""
        ids, sizes = self.flat_ids(texts)
        raw, ends = ids.tobytes(), (4 * np.cumsum(sizes)).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def lengths(self, texts: list[str | None]) -> list[int]:
        """The number of ids of each text, without an end id."""
        if not self.by_word:
            return [len(x) for x in self._ids([t or "" for t in texts])]
        return [int((self.stops[c + 1] - self.stops[c]).sum()) for c in self._codes(texts)]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def forget_words() -> None:
    """Give back the word memories of this process, before a stage that needs the room."""
    for held in _ENCODERS.values():
        held.forget()


def with_lengths(rows: DataFrame, path: str, text: str, name: str) -> DataFrame:
    """``rows`` with column ``name``, the number of ids of ``text``, in that column's place."""
    at, names = rows.columns.index(text), rows.columns

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in slices(batch, f"c{at}", SLICE_BYTES):
            counts = pa.array(encoder(path).lengths(part.column(at).to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([counts if i == at else c for i, c in enumerate(part.columns)], names=part.schema.names)

    # Names with dots cannot be selected by mapInArrow, so columns go in by number.
    numbered = rows.toDF(*[f"c{i}" for i in range(len(names))])
    schema = ", ".join(f"c{i} {'bigint' if i == at else f.dataType.simpleString()}" for i, f in enumerate(numbered.schema.fields))
    return map_arrow(numbered, run, schema).toDF(*[name if i == at else n for i, n in enumerate(names)])


def put_file(folder: str, name: str, data: bytes, attempt: int) -> None:
    """Write ``name`` whole or not at all: under the attempt's name first, hidden from readers, then renamed."""
    fs, base = pafs.FileSystem.from_uri(folder)
    beside = f"{base}/_attempt-{attempt}-{name}"
    with fs.open_output_stream(beside) as out:
        out.write(data)
    try:
        fs.move(beside, f"{base}/{name}")
    except OSError:  # stores that don't rename over a file that an earlier attempt left
        fs.delete_file(f"{base}/{name}")
        fs.move(beside, f"{base}/{name}")


#: Characters of a text that tell ranges of equal ids apart.
RANGE_CHARS = 100


def write_segments(docs: DataFrame, path: str, end_id: int = END_ID, bits: bool = False, folder: str | None = None) -> DataFrame:
    """Write the segment files of every document to ``folder``, a new shared one if none is given; a reader of them."""
    spark = docs.sparkSession
    ship_package(spark)
    folder = folder or shared_path(spark, f"token-segments-{uuid.uuid4().hex}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = struct.pack("<I", end_id)
        shard, attempt, number, before = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId(), 0, 0
        ids: list[bytes] = []
        doc_ids: list[int | None] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal number, before, held
            data = write_segment(doc_ids, [len(x) // 4 for x in ids], np.frombuffer(b"".join(ids), "<u4"), before, bits=bits, shard=shard, number=number)
            name = f"shard-{shard:06d}-{number:06d}.nts"
            put_file(folder, name, data, attempt)
            number, before, held = number + 1, before + held, 0
            ids.clear()
            doc_ids.clear()
            return pa.RecordBatch.from_arrays([pa.array([name])], names=["file"])

        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                for doc_id, found in zip(part.column(0).to_pylist(), encoder(path).encode(part.column(1).to_pylist()), strict=True):
                    ids.append(found + end)
                    doc_ids.append(doc_id)
                    held += len(found) // 4 + 1
                    if held >= SEGMENT_IDS:
                        yield flush()
        if ids:
            yield flush()

    # The text's beginning goes with its order and keeps null or repeated ids from being one partition.
    dealt = docs.select("doc_id", "text").repartitionByRange("doc_id", F.substring("text", 1, RANGE_CHARS))
    ordered = dealt.sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, "file string").write.format("noop").mode("overwrite").save()
    return segment_files(spark, folder)


def segment_files(spark: SparkSession, folder: str) -> DataFrame:
    """(file, data) of the segment files in ``folder``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.nts").load(folder)
    return files.select(F.col("path").alias("file"), F.col("content").alias("data"))


def shard_totals(segments: DataFrame) -> DataFrame:
    """(shard, n): the ids of every shard, from its segments' headers."""
    out = pa.schema([("shard", pa.int32()), ("n", pa.int64())])

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        heads = [shard_and_ids(data) for data in batch.column(0)]
        yield pa.RecordBatch.from_arrays([pa.array([h[k] for h in heads], out.field(k).type) for k in range(2)], schema=out)

    return map_arrow(segments.select("data"), run, "shard int, n bigint").groupBy("shard").agg(F.sum("n").alias("n"))


def read_segments(segments: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the segments' bytes."""
    out = pa.schema([("doc_id", pa.int64()), ("shard", pa.int32()), ("local", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row in range(batch.num_rows):
            seg = Segment(batch.column(0)[row].as_py())
            counts = seg.counts.astype(np.int64)
            ends = np.cumsum(counts)
            raw = memoryview(seg.ids().tobytes())
            crcs = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
            shard = np.full(seg.n_docs, seg.shard, np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(seg.doc_ids, pa.int64()), pa.array(shard), pa.array(seg.before + ends - counts), pa.array(counts), pa.array(crcs, pa.int64())], schema=out
            )

    docs = map_arrow(segments.select("data"), run, "doc_id bigint, shard int, local bigint, n_tokens bigint, ids_crc32 bigint")
    # One row for each write task, so both the window and the broadcast are small.
    base = shard_totals(segments).select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("base"))
    return docs.join(F.broadcast(base), "shard").select("doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")
