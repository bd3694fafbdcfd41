"""SentencePiece encoding by merges with seeded dropout, and lossless decoding.

A text is cut into chunks that no piece of the vocabulary can cross (before a run
of spaces, around characters without a piece). Within a chunk the agenda of
merges runs best score first, leftmost first among equals; a candidate merge is
skipped for good when a hash of the document's key, the chunk and the candidate's
span falls below the dropout rate. The verdict depends on nothing else, so equal
chunks of a document are segmented once, retries agree, and short chunks go
through the agenda side by side as columns of numbers; long ones use a heap.
With a rate of 0 the result is that of the model's own encoder.

Spaces become the pieces' space mark, with one in front of every text that is not
empty. Characters without a piece, the space mark itself among them, become byte
pieces, so every text decodes to itself.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shapeloom.llm.common import mix, ship, slices, text_buffers
from shapeloom.llm.words import powers

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
_SPACE, _MARK = 0x20, "▁"
_NONE = np.int32(2**30)
_SHORT = 32
_CHUNK = 1 << 19
_DENSE = 1024
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_PIECES = 1 << 17


@dataclass(frozen=True)
class PieceModel:
    """Pieces by id (bytes), their scores, and which are mergeable or stand for a byte."""

    pieces: tuple[bytes, ...]
    scores: tuple[float, ...]
    usable: tuple[bool, ...]
    byte_ids: tuple[int, ...]


def load_model(path: str = DEFAULT_MODEL) -> PieceModel:
    """Read a merge-type model with byte pieces; anything else raises ValueError."""
    import sentencepiece

    with open(path, "rb") as file:
        own = sentencepiece.SentencePieceProcessor(model_proto=file.read())
    n = own.get_piece_size()
    names = [own.id_to_piece(i) for i in range(n)]
    plain = [not (own.is_unknown(i) or own.is_control(i) or own.is_byte(i) or own.is_unused(i)) for i in range(n)]
    by_byte = {int(names[i][3:5], 16): i for i in range(n) if own.is_byte(i)}
    if len(by_byte) != 256:
        raise ValueError("the model has no piece for every byte")
    if any(plain[i] and _MARK in names[i].lstrip(_MARK) for i in range(n)):
        raise ValueError("a piece holds a space after other characters")
    data = tuple(bytes([int(names[i][3:5], 16)]) if own.is_byte(i) else names[i].replace(_MARK, " ").encode() if plain[i] else b"" for i in range(n))
    return PieceModel(data, tuple(own.get_score(i) for i in range(n)), tuple(plain), tuple(by_byte[b] for b in range(256)))


@dataclass
class _Tables:
    model: PieceModel
    of_char: np.ndarray = field(init=False)
    slots: np.ndarray = field(init=False)
    merged: np.ndarray = field(init=False)
    rank: np.ndarray = field(init=False)
    probes: int = field(init=False)

    def __post_init__(self) -> None:
        texts = [p.decode() if ok else "" for p, ok in zip(self.model.pieces, self.model.usable, strict=True)]
        known = {t: i for i, t in enumerate(texts) if t}
        self.of_char = np.full(0x110000, -1, np.int32)
        for text, i in known.items():
            if len(text) == 1:
                self.of_char[ord(text)] = i
        order = {s: r for r, s in enumerate(sorted({self.model.scores[i] for i in known.values()}, reverse=True))}
        keys, merged = [], []
        for text, i in known.items():
            for cut in range(1, len(text)):
                left, right = known.get(text[:cut]), known.get(text[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    merged.append(i)
        self.rank = np.full(len(texts) + 1, _NONE, np.int32)
        for i in known.values():
            self.rank[i] = order[self.model.scores[i]]
        made = np.unique(np.array(merged, np.int64))
        self.of_rank = np.full(len(order) + 1, -1, np.int32)  # -1 as well where several pieces share a rank
        self.of_rank[self.rank[made]] = made
        shared, uses = np.unique(self.rank[made], return_counts=True)
        self.of_rank[shared[uses > 1]] = -1
        self.small = np.uint16 if len(texts) < 2**16 - 1 else np.uint32
        self.none = np.iinfo(self.small).max
        self._fill(np.array(keys, np.uint64), np.array(merged, np.int32))
        self.byte_ids = np.array(self.model.byte_ids, np.int32)
        lengths = np.array([len(p) for p in self.model.pieces])
        self.piece_at = np.append(0, np.cumsum(lengths))
        self.piece_bytes = np.frombuffer(b"".join(self.model.pieces), np.uint8)

    def _fill(self, keys: np.ndarray, merged: np.ndarray) -> None:
        """Open addressing, filled one probe distance at a time."""
        bits = max(4, int(len(keys) * 8).bit_length())
        self.shift, self.size = np.uint64(64 - bits), 1 << bits
        self.slots, self.merged = np.full(self.size, -1, np.int64), np.full(self.size, -1, np.int32)
        self.dense = np.full((_DENSE, _DENSE), -1, np.int32)
        left, self.probes = np.arange(len(keys)), 0
        while len(left):
            at = (self._home(keys[left]) + self.probes) % self.size
            free = self.slots[at] < 0
            first = np.unique(at[free], return_index=True)[1]
            taken = left[free][first]
            self.slots[at[free][first]] = keys[taken].view(np.int64)
            self.merged[at[free][first]] = merged[taken]
            left = np.setdiff1d(left, taken, assume_unique=True)
            self.probes += 1

        low = self.of_char[:_DENSE]
        known = np.flatnonzero(low >= 0)
        left, right = (x.ravel() for x in np.meshgrid(known, known, indexing="ij"))
        self.dense[left, right] = self.pair(low[left], low[right])
        self.dense_ranks = self._small_ranks(self.dense).ravel()
        # The same table for ranks, in few bytes: a pair is one number of twice the small kind.
        self.wide, self.half = (np.uint32, 16) if self.small == np.uint16 else (np.uint64, 32)
        self.rank_slots = np.where(self.slots >= 0, (self.slots >> 32 << self.half) | (self.slots & 0xFFFFFFFF), -1).astype(self.wide)
        self.slot_ranks = self._small_ranks(self.merged)

    def _small_ranks(self, ids: np.ndarray) -> np.ndarray:
        """Ranks of pieces in the small kind; ``none`` for -1."""
        return np.where(ids >= 0, self.rank[ids], self.none).astype(self.small)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the piece that two pieces (of the small kind) merge into, or ``none``."""
        home = self._home(left.astype(np.uint64) << np.uint64(32) | right)
        keys = left.astype(self.wide) << self.wide(self.half) | right
        held = self.rank_slots[home]
        out = np.where(held == keys, self.slot_ranks[home], self.small(self.none))
        empty = np.iinfo(self.wide).max
        open_ = np.flatnonzero((held != keys) & (held != empty))
        for probe in range(1, self.probes):
            if not len(open_):
                break
            at = (home[open_] + probe) % self.size
            held = self.rank_slots[at]
            hit = held == keys[open_]
            out[open_[hit]] = self.slot_ranks[at[hit]]
            open_ = open_[~hit & (held != empty)]
        return out

    def first_ranks(self, ids: np.ndarray, codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """``pair_ranks`` of all neighbours in rows of single characters: one look into a table for those of the first code points."""
        left, right = codes[:, :-1], codes[:, 1:]
        near = (left < _DENSE) & (right < _DENSE)
        out = self.dense_ranks[np.where(near, left * _DENSE + right, 0)]
        far = np.nonzero(~near)
        out[far] = self.pair_ranks(ids[:, :-1][far], ids[:, 1:][far])
        out[np.arange(1, codes.shape[1])[None, :] >= sizes[:, None]] = self.none
        return out

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _MULTIPLIER) >> self.shift).astype(np.int64)

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id of the piece that two pieces merge into, or -1."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        home = self._home(keys.view(np.uint64))
        out = np.where(self.slots[home] == keys, self.merged[home], np.int32(-1))
        for probe in range(1, self.probes):
            open_ = np.flatnonzero((out < 0) & (self.slots[home] >= 0))
            if not len(open_):
                break
            at = (home[open_] + probe) % self.size
            hit = self.slots[at] == keys[open_]
            out[open_[hit]] = self.merged[at[hit]]
        return out


_tables: list[_Tables] = []


def _tables_of(model: PieceModel) -> _Tables:
    """Built once per worker process and model."""
    if not _tables or _tables[0].model is not model:
        _tables[:] = [t for t in _tables if t.model == model] or [_Tables(model)]
        _tables[0].model = model
    return _tables[0]


def _skipped(key: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray, rate: float) -> np.ndarray:
    """Keyed verdict on the candidate that joins [start, middle) and [middle, end)."""
    span = start.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + middle.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    drawn = mix(key + span + end.astype(np.uint64) * np.uint64(0x165667B19E3779F9))
    # The upper 53 bits below rate * 2**53, told by the whole number.
    least = math.ceil(rate * 2.0**53) << 11
    return drawn < np.uint64(least) if least < 1 << 64 else np.ones(len(drawn), bool)


def _agendas(t: _Tables, ids: np.ndarray, codes: np.ndarray, sizes: np.ndarray, keys: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """Run the agenda of every row of ``ids`` (of the characters ``codes``, padded with ``none``); returns the pieces and how many each row has.

    A candidate is held as the rank of what it makes, from which the piece follows.
    """
    n, width = ids.shape
    out, counts = ids.copy(), sizes.copy()
    if width < 2:
        return out, counts
    rows = np.arange(n)
    column = np.arange(width)
    none = t.small(t.none)
    bound = np.minimum(np.arange(width + 1)[None, :], sizes[:, None]).astype(np.min_scalar_type(width))

    def judge(rank: np.ndarray, row: np.ndarray, at: np.ndarray) -> None:
        """``rank`` of the candidates at the places ``at`` (a flat one in ``bound``) of the rows ``row``; those skipped get none."""
        ends = bound.ravel()
        rank[_skipped(keys.take(row), ends.take(at), ends.take(at + 1), ends.take(at + 2), rate)] = none

    rank = t.first_ranks(ids, codes, sizes)
    if rate > 0:
        row, at = np.nonzero(rank != none)
        held = rank[row, at]
        judge(held, row, row * (width + 1) + at)
        rank[row, at] = held
    while len(rows):
        width = ids.shape[1]
        if width == 1:
            out[rows, :1] = ids
            break
        own = np.arange(len(rows))
        best = rank.argmin(1)
        least = rank[own, best]
        live = least != none
        if not live.all():
            gone = np.flatnonzero(~live)
            out[rows[gone], :width] = ids[gone]
            kept = np.flatnonzero(live)
            rows, keys, ids, bound, rank, best, least = (x.take(kept, axis=0) for x in (rows, keys, ids, bound, rank, best, least))
            if not len(rows):
                break
            own = own[: len(rows)]
        # Every row that is left merges once, so all of them get one column shorter.
        made = t.of_rank[least]
        unsure = np.flatnonzero(made < 0)
        made[unsure] = t.pair(ids[unsure, best[unsure]].astype(np.int32), ids[unsure, best[unsure] + 1].astype(np.int32))
        ids[own, best] = made
        later = column[None, :width] > best[:, None]
        ids = np.where(later[:, : width - 1], ids[:, 1:], ids[:, :-1])
        bound = np.where(later, bound[:, 1:], bound[:, :-1])
        rank = np.where(later[:, : width - 2], rank[:, 1:], rank[:, :-1])
        counts[rows] -= 1
        for at, use in ((best, best < width - 2), (best - 1, best > 0)):
            r = np.flatnonzero(use)
            place = r * (width - 1) + at[r]
            found = t.pair_ranks(ids.ravel().take(place), ids.ravel().take(place + 1))
            rank.ravel()[place - r] = found
            if rate > 0 and len(some := np.flatnonzero(found != none)):
                found, r, place = found[some], r[some], place[some]
                judge(found, r, place + r)
                rank.ravel()[place - r] = found
    return out, counts


def _agenda(t: _Tables, ids: np.ndarray, key: np.uint64, rate: float) -> list[int]:
    """One long chunk with a heap."""
    n = len(ids)
    ids, after, before, ends = ids.tolist(), list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    agenda: list[tuple[int, int, int, int, int]] = []

    def offer(pairs: list[tuple[int, int]]) -> None:
        left, right = np.array([ids[a] for a, _ in pairs], np.int32), np.array([ids[b] for _, b in pairs], np.int32)
        made = t.pair(left, right)
        a, b = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
        c = np.array([ends[x] for _, x in pairs], np.int64)
        if rate > 0:
            made = np.where(_skipped(np.full(len(pairs), key, np.uint64), a, b, c, rate), -1, made)
        for (x, y), m, r, z in zip(pairs, made.tolist(), t.rank[made].tolist(), c.tolist(), strict=True):
            if m >= 0:
                heapq.heappush(agenda, (r, x, y, z, m))

    offer([(i, i + 1) for i in range(n - 1)])
    while agenda:
        _, x, y, end, made = heapq.heappop(agenda)
        if ids[x] < 0 or ids[y] < 0 or after[x] != y or ends[y] != end:
            continue
        ids[x], ids[y] = made, -1
        ends[x], after[x] = ends[y], after[y]
        if after[x] < n:
            before[after[x]] = x
        fresh = ([(before[x], x)] if before[x] >= 0 else []) + ([(x, after[x])] if after[x] < n else [])
        if fresh:
            offer(fresh)
    return [i for i in ids if i >= 0]


def _gather(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``values`` one after the other."""
    first = np.cumsum(sizes) - sizes
    return values[np.repeat(starts - first, sizes) + np.arange(int(sizes.sum()))]


def encode_texts(model: PieceModel, texts: list[str], keys: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all texts in a row, and where each text's begin."""
    t = _tables_of(model)
    lengths = np.array([len(x) + bool(x) for x in texts], np.int64)
    at = np.append(0, np.cumsum(lengths))
    codes = np.frombuffer("".join(" " + x for x in texts if x).encode("utf-32-le"), np.uint32).astype(np.int64)
    if not len(codes):
        return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    char = t.of_char[codes]
    cut = np.zeros(len(codes), bool)
    cut[at[:-1][lengths > 0]] = True
    cut[1:] |= (codes[1:] == _SPACE) & (codes[:-1] != _SPACE)
    strange = char < 0
    cut |= strange
    cut[1:] |= strange[:-1]
    starts = np.flatnonzero(cut)
    sizes = np.diff(np.append(starts, len(codes)))
    owner = np.searchsorted(at, starts, "right") - 1
    place = np.arange(len(codes)) - np.repeat(starts, sizes)
    content = mix(np.add.reduceat((codes.astype(np.uint64) + np.uint64(1)) * powers(int(sizes.max()))[place], starts))
    salted = mix(content ^ mix(keys.astype(np.int64).view(np.uint64)[owner])) if rate > 0 else content
    unique, first, back = np.unique(salted, return_index=True, return_inverse=True)
    u_start, u_size = starts[first], sizes[first]

    counts, parts, origin = np.zeros(len(unique), np.int64), [], []
    odd = strange[u_start]
    for i in np.flatnonzero(odd):
        data = chr(codes[u_start[i]]).encode("utf-8")
        parts.append(t.byte_ids[np.frombuffer(data, np.uint8)])
        origin.append(i)
        counts[i] = len(data)
    flat_parts = [(np.array(origin, np.int64), np.concatenate(parts) if parts else np.zeros(0, np.int32))]
    low = 0
    short = np.where(odd, 0, u_size)
    for width in (1, 4, 6, 8, 10, 12, 16, 24, _SHORT):
        rows = np.flatnonzero((short > low) & (short <= width))
        low = width
        if not len(rows):
            continue
        column = np.arange(width)[None, :]
        inside = column < u_size[rows, None]
        place = np.minimum(u_start[rows, None] + column, len(codes) - 1)
        ids = np.where(inside, char[place], t.none).astype(t.small)
        made, n = _agendas(t, ids, codes[place], u_size[rows], unique[rows], rate)
        counts[rows] = n
        flat_parts.append((rows, made[np.arange(width)[None, :] < n[:, None]].astype(np.int32)))
    for i in np.flatnonzero(short > _SHORT):
        made = np.array(_agenda(t, char[u_start[i] : u_start[i] + u_size[i]], unique[i], rate), np.int32)
        counts[i] = len(made)
        flat_parts.append((np.array([i]), made))
    pool = np.concatenate([p for _, p in flat_parts])
    order = np.concatenate([r for r, _ in flat_parts])
    begin = np.empty(len(unique), np.int64)
    begin[order] = np.cumsum(counts[order]) - counts[order]
    per_chunk = counts[back]
    out = _gather(pool, begin[back], per_chunk)
    total = np.append(0, np.cumsum(np.bincount(owner, per_chunk, len(texts)).astype(np.int64)))
    return out, total


def decode_pieces(model: PieceModel, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and where each text's begin; undoes ``encode_texts``."""
    t = _tables_of(model)
    sizes = t.piece_at[ids + 1] - t.piece_at[ids]
    data = _gather(t.piece_bytes, t.piece_at[ids], sizes)
    total = np.append(0, np.cumsum(sizes))[at]
    some = np.diff(total) > 0
    keep = np.ones(len(data), bool)
    keep[total[:-1][some]] = False
    return data[keep], total - np.append(0, np.cumsum(some))


def encode(text: Column, key: Column, model: PieceModel, rate: float = 0.1) -> Column:
    """Piece ids of a text (null: null, empty: none). ``key``: a long that varies the segmentation."""

    @F.arrow_udf("array<int>")
    def run(texts: pa.Array, keys: pa.Array) -> pa.Array:
        _, offsets = text_buffers(texts)
        salts = keys.fill_null(0).to_numpy(zero_copy_only=False)
        values, bounds = [], [np.zeros(1, np.int64)]
        for a, b in slices(offsets, _CHUNK):
            ids, at = encode_texts(model, [x or "" for x in texts.slice(a, b - a).to_pylist()], salts[a:b], rate)
            values.append(ids)
            bounds.append(at[1:] + bounds[-1][-1])
        valid = pa.array(np.concatenate(bounds).astype(np.int32), mask=None)
        if texts.null_count:
            gone = np.append(texts.is_null().to_numpy(zero_copy_only=False), False)
            valid = pa.array(np.concatenate(bounds).astype(np.int32), mask=gone)
        return pa.ListArray.from_arrays(valid, pa.array(np.concatenate(values) if values else np.zeros(0, np.int32), pa.int32()))

    return run(text, key)


def decode_lists(model: PieceModel, column: pa.ListArray) -> pa.StringArray:
    """The texts of lists of piece ids (null: null), made as buffers and not one by one."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    bounds = np.append(0, np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))
    parts: list[pa.StringArray] = []
    for first, last in slices(bounds, _PIECES):
        data, at = decode_pieces(model, flat[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first])
        raw = data.tobytes()
        raw.decode()  # raises where it is no UTF-8
        begins = at[:-1]
        if (data[begins[begins < len(data)]] & 0xC0 == 0x80).any():
            raise ValueError("a text ends inside a character")
        parts.append(pa.StringArray.from_buffers(last - first, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(raw)))
    texts = pa.concat_arrays(parts) if parts else pa.array([], pa.string())
    return pc.if_else(column.is_null(), pa.scalar(None, pa.string()), texts) if column.null_count else texts


def decode(pieces: Column, model: PieceModel) -> Column:
    """The text of an array of piece ids (null: null). Ids outside the model raise."""

    @F.arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        return decode_lists(model, column)

    return run(pieces)


def with_pieces(docs: DataFrame, model: PieceModel | None = None, id_col: str = "doc_id", text_col: str = "text", rate: float = 0.1, seed: int = 19, out: str = "pieces") -> DataFrame:
    """``docs`` with piece ids in ``out`` (an existing column of that name is replaced).

    Documents are independent: no shuffle, any text length, rows with equal id and
    text get equal pieces, rows with a null id share a key. An empty table gives none.
    """
    ship(docs)
    model = model or load_model()
    return docs.withColumn(out, encode(F.col(text_col), F.xxhash64(F.lit(seed), F.col(id_col)), model, rate))
