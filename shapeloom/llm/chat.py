"""Chat formatting: whole batches of turns are assembled in one buffer.

A turn becomes ``<|turn|>role<|text|>text<|end|>`` and a line break. Within roles and
texts a backslash is doubled and one is put after the first byte of every control
string, so no control string is left in them and both read back exactly.

Turns are first assembled in blocks of ``_BLOCK`` turn numbers of a conversation,
then the blocks are joined; a conversation with very many turns is thus worked on
by many tasks and only its finished bytes meet in one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shapeloom.llm.common import run_starts, ship, text_buffers, whole_groups

TURN, TEXT, END = b"<|turn|>", b"<|text|>", b"<|end|>\n"
#: Strings that chat templates give a meaning.
CONTROL = (b"<|turn|>", b"<|text|>", b"<|end|>", b"<s>", b"</s>", b"[INST]", b"[/INST]", b"<<SYS>>", b"<</SYS>>", b"<|im_start|>", b"<|im_end|>")
_ESCAPE = ord("\\")
_BLOCK = 64


def escape(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Escaped bytes of many texts in a row and the offsets of each."""
    before = data == _ESCAPE  # a backslash goes in front
    after = np.zeros(len(data), bool)  # a backslash follows
    limit = np.repeat(offsets[1:], np.diff(offsets))
    for mark in CONTROL:
        at = np.flatnonzero(data == mark[0])
        at = at[at + len(mark) <= limit[at]]
        for k in range(1, len(mark)):
            at = at[data[at + k] == mark[k]]
        after[at] = True
    width = 1 + before.astype(np.int64) + after
    ends = np.append(0, np.cumsum(width))
    out = np.full(int(ends[-1]), _ESCAPE, np.uint8)
    out[ends[:-1] + before] = data
    return out, ends[offsets]


def unescape(data: bytes) -> bytes:
    return re.sub(rb"\\(.)", rb"\1", data, flags=re.DOTALL)


def _place(out: np.ndarray, at: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> None:
    """Copy every stretch of ``data`` to its place in ``out``."""
    sizes = np.diff(offsets)
    out[np.repeat(at - offsets[:-1], sizes) + np.arange(len(data))] = data


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All turns' bytes in one buffer, where each turn begins, and where its escaped text begins and ends."""
    role, role_at = escape(*text_buffers(roles))
    text, text_at = escape(*text_buffers(texts))
    sizes = np.diff(role_at) + np.diff(text_at) + len(TURN) + len(TEXT) + len(END)
    at = np.append(0, np.cumsum(sizes))
    out = np.empty(int(at[-1]), np.uint8)
    first = at[:-1]
    places = (first, first + len(TURN), first + len(TURN) + np.diff(role_at))
    for mark, start in ((TURN, places[0]), (TEXT, places[2]), (END, at[1:] - len(END))):
        out[start[:, None] + np.arange(len(mark))] = np.frombuffer(mark, np.uint8)
    _place(out, places[1], role, role_at)
    begin = places[2] + len(TEXT)
    _place(out, begin, text, text_at)
    return out, at, begin, begin + np.diff(text_at)


def _strings(data: np.ndarray, at: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.Array.from_buffers(kind, len(at) - 1, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def _lists(values: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values.astype(np.int64)))


def _blocks(trained: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["none", "conv", "block"]):
            table = table.combine_chunks()
            none, conv, block = (table[c].to_numpy() for c in ("none", "conv", "block"))
            data, at, begin, end = assemble(table["role"], table["text"])
            bounds = run_starts(none, conv, block)
            learn = np.isin(np.array([r or "" for r in table["role"].to_pylist()], object), trained)
            count = np.append(0, np.cumsum(learn))[bounds]
            base = np.repeat(at[bounds[:-1]], np.diff(bounds))
            first = bounds[:-1]
            columns = [pa.array(none[first]), pa.array(conv[first]), pa.array(block[first]), _strings(data, at[bounds], pa.string()), pa.array(np.diff(bounds)), _lists((begin - base)[learn], count), _lists((end - base)[learn], count)]
            yield pa.RecordBatch.from_arrays(columns, ["none", "conv", "block", "formatted", "n_turns", "loss_start", "loss_end"])

    return run


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in whole_groups(batches, ["none", "conv"]):
        table = table.combine_chunks()
        none, conv, turns = (table[c].to_numpy() for c in ("none", "conv", "n_turns"))
        data, at = text_buffers(table["formatted"])
        bounds = run_starts(none, conv)
        first = bounds[:-1]
        shift = at[:-1] - np.repeat(at[first], np.diff(bounds))
        spans = []
        for name in ("loss_start", "loss_end"):
            lists = table[name].combine_chunks()
            sizes = lists.value_lengths().to_numpy()
            spans.append(_lists(lists.flatten().to_numpy() + np.repeat(shift, sizes), np.append(0, np.cumsum(sizes))[bounds]))
        total = np.append(0, np.cumsum(turns))
        columns = [pa.array(conv[first], mask=none[first] > 0), _strings(data, at[bounds], pa.string()), pa.array(total[bounds[1:]] - total[first]), *spans]
        yield pa.RecordBatch.from_arrays(columns, ["conv_id", "formatted", "n_turns", "loss_start", "loss_end"])


def format_chats(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """``conv_id, formatted, n_turns, loss_start, loss_end``: one row per conversation.

    ``loss_start`` and ``loss_end`` are byte positions of the texts of ``trained``
    roles in the UTF-8 form of ``formatted``. Turns are ordered by number, null
    numbers last, equal numbers by role and text; repeated rows are separate turns.
    A null role or text is empty; rows with a null id form one conversation. Other
    columns are ignored. A conversation has to fit into one value (2 GB). An empty
    table gives none.
    """
    ship(turns)
    turn = F.col(turn_col).cast("long")
    rows = turns.select(
        F.col(id_col).isNull().cast("int").alias("none"), F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("conv"),
        F.coalesce(F.floor(turn / _BLOCK), F.lit(2**62)).cast("long").alias("block"), turn.alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"),
    )
    keys = ["none", "conv", "block"]
    rows = rows.repartition(*keys).sortWithinPartitions(*keys, F.col("turn").asc_nulls_last(), "role", "text").select(*keys, "role", "text")
    parts = rows.mapInArrow(_blocks(trained), "none int, conv long, block long, formatted string, n_turns long, loss_start array<long>, loss_end array<long>")
    parts = parts.repartition("none", "conv").sortWithinPartitions(*keys)
    return parts.mapInArrow(_joined, "conv_id long, formatted string, n_turns long, loss_start array<long>, loss_end array<long>")


def read_turns(formatted: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(role, text) of every turn of a formatted conversation."""
    for turn in formatted.split(TURN)[1:]:
        role, text = turn.split(TEXT)
        yield unescape(role), unescape(text[: -len(END)])


def chat_digests(chats: DataFrame) -> DataFrame:
    """Read formatted conversations back: digests of their turns and of what the loss mask covers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = text_buffers(batch["formatted"])
            rows = []
            for i, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)):
                raw = data[a:b].tobytes()
                whole, learned, chars, n = hashlib.sha256(), hashlib.sha256(), 0, 0
                for role, text in read_turns(raw):
                    whole.update(role + b"\n" + text + b"\n")
                    n += 1
                for s, e in zip(batch["loss_start"][i].as_py(), batch["loss_end"][i].as_py(), strict=True):
                    text = unescape(raw[s:e])
                    learned.update(text)
                    chars += len(text.decode())
                rows.append((batch["conv_id"][i].as_py(), n, whole.hexdigest(), chars, learned.hexdigest(), len(raw.decode())))
            if rows:
                names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return chats.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
