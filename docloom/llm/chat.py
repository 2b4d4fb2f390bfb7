r"""Chat formatting by columnar byte assembly.

Template, for each turn::

    <|im_start|>ROLE\nTEXT<|im_end|>\n

Escapes: inside roles and texts ``<``, any number of ``\`` and ``|`` get one
``\`` more before the ``|``; roles also write ``\`` as ``\\`` and a line feed as
``\n`` first. Both are undone by :func:`read_back`, so no text can forge a turn.

The lengths of all headers and contents give offsets by a cumulative sum, and
numpy scatters the bytes of whole Arrow columns into one preallocated buffer
(long values are copied as slices). A conversation's output is one or more
segments; a segment ends with its Arrow batch, and batches are cut by the bytes of
their texts, so a conversation of any length streams through bounded memory.

Defined cases: turns are put in the order of (turn, role, text), nulls first;
repeated rows are turns like others; null roles and texts count as empty; rows
with a null conversation id form one conversation; extra columns are dropped; an
empty table gives no segment.
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

from docloom.llm.byte_bpe import in_batches

START, END = b"<|im_start|>", b"<|im_end|>\n"
#: Bytes from which on values are copied whole.
LONG = 512
_TURN = re.compile(rb"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)
_ESCAPED = re.compile(rb"<(\\*)\\\|")
_ROLE_ESCAPED = re.compile(rb"\\(.)", re.DOTALL)


def escape_text(column: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(column, pattern=r"<(\\*)\|", replacement=r"<\1\\|")


def escape_role(column: pa.Array) -> pa.Array:
    return escape_text(pc.replace_substring(pc.replace_substring(column, "\\", "\\\\"), "\n", "\\n"))


def unescape_text(data: bytes) -> bytes:
    return _ESCAPED.sub(rb"<\1|", data) if b"<" in data else data


def unescape_role(data: bytes) -> bytes:
    return _ROLE_ESCAPED.sub(lambda m: b"\n" if m[1] == b"n" else m[1], unescape_text(data)) if b"\\" in data else data


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offset of each value, the end included."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    values = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return values, offsets - offsets[0]


def assemble(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Row by row concatenation of columns: one byte buffer, the rows' offsets in it, and each column's start in its row's bytes.

    A part is (bytes, offsets); one of a single value stands in every row.
    """
    rows = max(len(offsets) for _, offsets in parts) - 1
    lengths = np.stack([np.diff(o) if len(o) == rows + 1 and rows != 1 else np.broadcast_to(np.diff(o), rows) for _, o in parts], axis=1)
    ends = np.cumsum(lengths.ravel())
    starts = (ends - lengths.ravel()).reshape(lengths.shape)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k, (data, _) in enumerate(parts):
        size = lengths[:, k]
        first = np.cumsum(size) - size
        if size.sum() > LONG * rows:  # long values: a copy each instead of an index for each byte
            for to, at, n in zip(starts[:, k], first % max(1, len(data)), size, strict=True):
                out[to : to + n] = data[at : at + n]
            continue
        within = np.arange(int(size.sum())) - np.repeat(first, size)
        source = np.tile(data, rows) if len(data) != int(size.sum()) else data
        out[np.repeat(starts[:, k], size) + within] = source
    return out, np.concatenate([starts[:, 0], [len(out)]]).astype(np.int64), [starts[:, k] for k in range(len(parts))]


def _single(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(data, np.uint8), np.array([0, len(data)], np.int64)


def format_batch(conv: pa.Array, role: pa.Array, text: pa.Array, trained: str, first_segment: int, last_conv) -> tuple[pa.RecordBatch, int, object]:
    """Segments of one sorted batch; first_segment continues last_conv if the batch begins with it."""
    fill = lambda x: pc.fill_null(x, "")
    role, text = fill(role), fill(text)
    roles, texts = _bytes_of(escape_role(role)), _bytes_of(escape_text(text))
    out, rows, starts = assemble([_single(START), roles, _single(b"\n"), texts, _single(END)])
    ids, valid = np.asarray(pc.fill_null(conv, 0)), np.asarray(pc.is_valid(conv))
    new = np.concatenate([[True], (ids[1:] != ids[:-1]) | (valid[1:] != valid[:-1])])
    heads = np.flatnonzero(new)
    number = np.zeros(len(heads), np.int32)
    key = lambda i: ids[i].item() if valid[i] else None
    if last_conv is not False and key(0) == last_conv:
        number[0] = first_segment
    bounds = np.append(heads, len(ids))
    offsets = rows[bounds]
    loss = np.flatnonzero(np.asarray(pc.equal(role, trained)))
    owner = np.searchsorted(heads, loss, side="right") - 1
    spans = np.searchsorted(owner, np.arange(len(heads) + 1)).astype(np.int32)
    begin = starts[3][loss] - offsets[owner]
    listed = lambda x: pa.ListArray.from_arrays(pa.array(spans, pa.int32()), pa.array(x, pa.int64()))
    formatted = pa.LargeStringArray.from_buffers(len(heads), pa.py_buffer(np.ascontiguousarray(offsets)), pa.py_buffer(out)).cast(pa.string())
    columns = [conv.take(pa.array(heads)), pa.array(number), pa.array(np.diff(bounds), pa.int64()), formatted, listed(begin), listed(begin + np.diff(texts[1])[loss])]
    return pa.RecordBatch.from_arrays(columns, ["conv_id", "segment", "n_turns", "formatted", "loss_starts", "loss_ends"]), int(number[-1]) + 1, key(len(ids) - 1)


def format_conversations(rows: DataFrame, trained: str = "assistant", conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Segments: conv_id, segment, n_turns, formatted, loss_starts and loss_ends (byte offsets of the trained role's texts in formatted).

    The segments of a conversation are in one partition, in order.
    """
    sorted_rows = (
        rows.select(F.col(conv_col).cast("bigint").alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, last = 0, False
        for batch in in_batches(batches, "text"):
            if batch.num_rows:
                out, segment, last = format_batch(batch.column("conv_id"), batch.column("role"), batch.column("text"), trained, segment, last)
                yield out

    return sorted_rows.mapInArrow(run, "conv_id bigint, segment int, n_turns bigint, formatted string, loss_starts array<bigint>, loss_ends array<bigint>")


def read_back(segments: DataFrame) -> DataFrame:
    """Parse formatted segments again; digests of each conversation's turns and trained texts, hashed segment by segment.

    Expects the output of :func:`format_conversations`: a conversation's segments in one partition, in order.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    table = lambda rows: pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = False, None

        def done() -> tuple:
            return current, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]

        for batch in batches:
            out = []
            for row in batch.select(["conv_id", "formatted", "loss_starts", "loss_ends"]).to_pylist():
                if state is None or row["conv_id"] != current:
                    if state is not None:
                        out.append(done())
                    current, state = row["conv_id"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                data = row["formatted"].encode()
                state[4] += len(row["formatted"])
                at = 0
                for turn in _TURN.finditer(data):
                    if turn.start() != at:
                        raise ValueError(f"conversation {current}: bytes {at} to {turn.start()} are no turn")
                    at = turn.end()
                    state[0] += 1
                    state[1].update(unescape_role(turn[1]) + b"\n" + unescape_text(turn[2]) + b"\n")
                if at != len(data):
                    raise ValueError(f"conversation {current}: its end is no turn")
                for a, b in zip(row["loss_starts"], row["loss_ends"], strict=True):
                    text = unescape_text(data[a:b])
                    state[2] += len(text.decode())
                    state[3].update(text)
            if out:
                yield table(out)
        if state is not None:
            yield table([done()])

    return segments.mapInArrow(run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
