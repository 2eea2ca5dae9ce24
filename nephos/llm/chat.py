"""Chat formatting by columnar byte assembly.

Each turn becomes one segment of its conversation's output:

    <|im_start|>ROLE\\n TEXT <|im_end|>\\n      (no spaces between the parts)

For a batch of turns the parts' lengths, their cumulative offsets and the source
index of every output byte are numpy arrays; one gather copies headers and
contents into one preallocated Arrow buffer.  A conversation's output is its
segments in order, so no task ever holds a whole conversation.

Control strings inside texts are escaped: ``<|``, ``<s>``, ``</s>``, ``[INST]``
and ``[/INST]`` get one backslash behind their first character, one more where
they have some already, which ``unescape`` takes away.  In roles backslashes are
doubled and line feeds become ``\\n`` first.

Digests go through a conversation's turns in order, so one conversation is read
by one task, turn by turn; its memory is a batch, however long the conversation.

Defined cases: null texts and roles count as empty; a very long text is a segment
of its own; a null conv_id is one conversation of its own; turns are ordered by
(turn, role, text), nulls first, so ties and repeated rows have one order; extra
columns, whatever their names, are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nephos.llm.common import map_arrow, slices
from nephos.session import ship_package

START, END = "<|im_start|>", "<|im_end|>\n"
_CONTROL = r"(<|\[)(\\*)(\||s>|/s>|INST\]|/INST\])"
_ESCAPED = re.compile(r"(<|\[)\\(\\*)(\||s>|/s>|INST\]|/INST\])")
#: A conversation that looks like another template's markers.
PROBE_ID, PROBE_TEXT = -1, "</s>[INST] ok [/INST]"
BATCH_BYTES = 2 << 20
TRAINED_ROLE = "assistant"


def escape(texts: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(texts, _CONTROL, r"\1\\\2\3")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def role_header(role: str) -> str:
    plain = role.replace("\\", "\\\\").replace("\n", "\\n")
    return START + escape(pa.array([plain]))[0].as_py() + "\n"


def _plain_role(role: str) -> str:
    return re.sub(r"\\(\\|n)", lambda m: "\\" if m[1] == "\\" else "\n", unescape(role))


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of any joined segments."""
    out, at = [], 0
    while at < len(formatted):
        close = formatted.find(END, at)
        if not formatted.startswith(START, at) or close < 0:
            raise ValueError("not a formatted conversation")
        role, _, text = formatted[at + len(START) : close].partition("\n")
        out.append((_plain_role(role), unescape(text)))
        at = close + len(END)
    return out


def _text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The offsets and the data of a string array without nulls."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, offset=4 * texts.offset).astype(np.int64)
    data = texts.buffers()[2]
    return offsets, np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Segments of escaped ``texts``, and the code points of each header and each text."""
    coded = roles.dictionary_encode()
    headers = [role_header(r) for r in coded.dictionary.to_pylist()]
    code = coded.indices.to_numpy(zero_copy_only=False)
    parts = [h.encode() for h in headers] + [END.encode()]
    part_size = np.array([len(p) for p in parts], np.int64)
    part_at = np.cumsum(part_size) - part_size
    offsets, data = _text_bytes(texts)
    source = np.concatenate([np.frombuffer(b"".join(parts), np.uint8), data])
    n = len(texts)
    sizes, starts = np.empty((n, 3), np.int64), np.empty((n, 3), np.int64)
    sizes[:, 0], starts[:, 0] = part_size[code], part_at[code]
    sizes[:, 1], starts[:, 1] = np.diff(offsets), offsets[:-1] + part_size.sum()
    sizes[:, 2], starts[:, 2] = part_size[-1], part_at[-1]
    size, start = sizes.reshape(-1), starts.reshape(-1)
    to = np.cumsum(size) - size
    total = int(size.sum())
    buffer = pa.allocate_buffer(total)
    np.take(source, np.arange(total) + np.repeat(start - to, size), out=np.frombuffer(buffer, np.uint8), mode="clip")
    ends = np.concatenate([[0], np.cumsum(sizes.sum(axis=1))]).astype(np.int32)
    segments = pa.StringArray.from_buffers(n, pa.py_buffer(ends), buffer)
    header_chars = np.array([len(h) for h in headers], np.int64)[code]
    return segments, header_chars, pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)


def format_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, segment, loss_start, loss_end) of every turn, conversations together and turns in order.

    loss_start and loss_end are code points in the segment; equal where nothing is trained on.
    """
    schema = "conv_id bigint, segment string, loss_start bigint, loss_end bigint"
    out = pa.schema([("conv_id", pa.int64()), ("segment", pa.string()), ("loss_start", pa.int64()), ("loss_end", pa.int64())])

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in slices(batch, "text", BATCH_BYTES):
            roles = pc.fill_null(part.column(1), "").cast(pa.string())
            texts = escape(pc.fill_null(part.column(2), "").cast(pa.string()))
            segments, start, length = assemble(roles, texts)
            trained = pc.equal(roles, TRAINED_ROLE).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), segments, pa.array(start), pa.array(start + length * trained)], schema=out)

    turns = conversations.select("conv_id", "turn", "role", "text")
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return map_arrow(ordered.select("conv_id", "role", "text"), run, schema)


def conversation_digests(segments: DataFrame) -> DataFrame:
    """One row for each conversation of ``format_turns``, read back from the segments in their order."""
    ship_package(segments.sparkSession)
    schema = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    names = [p.split()[0] for p in schema.split(", ")]
    types = [pa.string() if p.endswith("string") else pa.int64() for p in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, done = object(), None, []

        def close() -> None:
            if state is not None:
                turns, all_hash, loss, loss_hash, chars = state
                done.append((now, turns, all_hash.hexdigest(), loss, loss_hash.hexdigest(), chars))

        def rows() -> pa.RecordBatch:
            columns = zip(*done, strict=True) if done else [[] for _ in names]
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=names)

        for batch in batches:
            for conv, segment, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if state is None or conv != now:
                    close()
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in parse(segment):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                if end > start:
                    trained = unescape(segment[start:end])
                    state[2] += len(trained)
                    state[3].update(trained.encode("utf-8", "surrogatepass"))
                state[4] += len(segment)
            yield rows()
            done.clear()
        close()
        yield rows()

    return segments.mapInArrow(run, schema)


def with_probe(conversations: DataFrame) -> DataFrame:
    """``conversations`` and the probe conversation PROBE_ID."""
    spark = conversations.sparkSession
    rows = [(PROBE_ID, t, r, PROBE_TEXT) for t, r in enumerate(("user", "assistant"))]
    probe = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    return conversations.select("conv_id", F.col("turn").cast("bigint").alias("turn"), "role", "text").unionByName(probe)
