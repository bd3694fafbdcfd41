"""Licence scan: a trained paragraph classifier, confirmed against templates.

Texts are cut into paragraphs (lines, and sentences within them); notices wrapped
over lines are looked for in windows of neighbouring lines, without the comment
marks at their beginnings. Features are the
word pairs and triples that occur in the licence templates; all others weigh
nothing, so a paragraph without one is of the class ``unknown`` and costs a table
lookup per word. A softmax over these sparse features is trained on the templates
in varied forms and on paragraphs of the corpus; its temperature is then set on a
held-out part, which makes the chance of ``unknown`` mean what it says. A family
counts as found where it is likelier than ``least_chance`` and a template of that
family is largely contained in the paragraph.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shapeloom.llm.common import share, ship, slices, text_buffers
from shapeloom.llm.words import word_ngrams

#: Short statements by which texts name their licence.
TEMPLATES = {
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0", "you may not use this file except in compliance with the License", "distributed under the terms of the Apache License 2.0"),
    "BSD-3-Clause": ("Redistribution and use in source and binary forms, with or without modification, are permitted", "released under the 3-clause BSD license", "Licensed under the BSD 3-Clause License"),
    "CC-BY-4.0": ("Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC0-1.0": ("dedicated to the public domain under CC0 1.0", "To the extent possible under law, the author has waived all copyright"),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3", "you can redistribute it and/or modify it under the terms of the GNU General Public License", "released under the GPL version 3"),
    "LGPL-3.0": ("licensed under the GNU Lesser General Public License, version 3", "under the terms of the GNU Lesser General Public License"),
    "MIT": ("Released under the MIT License", "Licensed under the MIT License", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    "MPL-2.0": ("subject to the terms of the Mozilla Public License, v. 2.0", "Licensed under the Mozilla Public License, version 2.0"),
    "reserved": ("All rights reserved", "No part of this publication may be reproduced without written permission"),
}
#: Sentences close to licence wording that name none.
UNLIKE = (
    "the licence to drive was released under the old rules", "all of the rights of the public", "the general public was free to use the work",
    "licensed under the terms of the contract", "this work is under way", "permission is granted to the person in charge", "he was free of charge",
    "released under the name of the author", "the version 2.0 of the file", "you may not use the door", "in compliance with the rules", "the university of the state",
)
FAMILIES = (*TEMPLATES, "unknown")
#: How a prepared text names a version, a Creative Commons kind and a number of clauses.
_VERSION = re.compile(r"(?:\bversions?|\bv\.?|\blicen[cs]e|gpl|mpl|apache|\bcc0|\bby(?:-\w+)*|\battribution(?:[ -](?:non-?commercial|share-?alike|no-?deriv\w*))*)[\s-]*v?\.?\s*(\d+(?:\.\d+)*)")
_KIND = re.compile(r"\bcc[\s-]+by((?:[\s-]+(?:nc|sa|nd)\b)*)|\battribution((?:[\s-]+(?:non-?commercial|share-?alike|no-?deriv\w*))*)")
_CLAUSES = re.compile(r"\b(\d|two|three|four)[\s-]clause")


def _names(family: str, text: str) -> bool:
    """Whether the versions, kinds or clauses that a prepared text names, if any, include those of the family."""
    name, _, version = family.rpartition("-")
    if family == "BSD-3-Clause":
        named = set(_CLAUSES.findall(text))
        return not named or bool(named & {"3", "three"})
    if name.startswith("CC-BY"):
        kinds = ["".join(sorted({x for x in ("nc", "sa", "nd") if x in (short or "") or {"nc": "non", "sa": "share", "nd": "no-d"}[x] in (long or "") or (x == "nd" and "noderiv" in (long or ""))})) for short, long in _KIND.findall(text)]
        if kinds and name[6:].lower() not in kinds:
            return False
    if not version[:1].isdigit():
        return True
    named = {v.removesuffix(".0") for v in _VERSION.findall(text)}
    return not named or version.removesuffix(".0") in named


def _versioned(text: str) -> bool:
    return bool(_VERSION.search(text.lower().replace(",", "")))


_SLOTS = 1 << 20
_CHUNK = 1 << 19
#: Neighbouring lines over which a statement may be wrapped: as many as leave two words a line of the longest template, and more.
_LINES = 12


def _prepared(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case bytes with punctuation blanked, and where paragraphs begin (and the end)."""
    out = data.copy()
    out[(out >= 65) & (out <= 90)] += 32
    blank = np.zeros(256, bool)
    blank[list(b",;:()\"'*_<>[]{}|#=")] = True
    space = np.zeros(256, bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    after = np.ones(len(data), bool)
    after[:-1] = space[data[1:]]
    after[offsets[1:][offsets[1:] > 0] - 1] = True
    stop = np.isin(data, np.frombuffer(b".!?", np.uint8)) & after
    out[blank[data] | stop] = 32
    short = np.zeros(len(data), bool)  # the stop of "v. 2.0"
    short[2:] = stop[2:] & (out[1:-1] == ord("v")) & (space[data[:-2]] | blank[data[:-2]])
    cut = np.flatnonzero((stop & ~short) | (data == 10)) + 1
    return out, np.unique(np.concatenate([offsets, cut]))


def _unwrapped(clean: np.ndarray, bounds: np.ndarray, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``clean`` without comment marks before words, and where runs of lines begin (places in ``bounds``, and its last).

    A run ends at the end of a sentence, of the text, and at a line without words.
    """
    out = clean.copy()
    space, mark = np.zeros(256, bool), np.zeros(256, bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    mark[list(b"/-%!")] = True
    for _ in range(3):
        before = np.ones(len(out), bool)
        before[1:] = space[out[:-1]]
        before[offsets[:-1][offsets[:-1] < len(out)]] = True
        out[before & mark[out]] = 32
    words = np.append(0, np.cumsum(~space[out]))
    blank = np.diff(words[bounds]) == 0
    new = np.isin(bounds, offsets)
    new[1:-1] |= (data[bounds[1:-1] - 1] != 10) | blank[1:]
    return out, np.flatnonzero(new)


def _grams(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the word pairs and triples of each paragraph, without repeats."""
    two, at2 = word_ngrams(data, bounds, 2)
    three, at3 = word_ngrams(data, bounds, 3)
    owner = np.append(np.repeat(np.arange(len(bounds) - 1), np.diff(at2)), np.repeat(np.arange(len(bounds) - 1), np.diff(at3)))
    slots = (np.append(two, three) % np.uint64(_SLOTS)).astype(np.int64)
    return owner, slots


@dataclass
class LicenseModel:
    """``column_of``: feature number of a slot or -1; weights by feature and family; templates as feature sets."""

    column_of: np.ndarray
    weights: np.ndarray
    base: np.ndarray
    temperature: float
    templates: list[tuple[int, np.ndarray]]
    versioned: list[bool]
    least_chance: float
    least_contained: float

    def active(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(paragraph, feature) of every known feature, sorted, without repeats."""
        owner, slots = _grams(data, bounds)
        column = self.column_of[slots]
        use = column >= 0
        pair = np.unique(owner[use] * np.int64(1 << 20) + column[use])
        return pair >> 20, pair & ((1 << 20) - 1)

    def chances(self, owner: np.ndarray, column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The paragraphs with features, and their chances by family."""
        rows, place = np.unique(owner, return_inverse=True)
        z = np.tile(self.base, (len(rows), 1))
        np.add.at(z, place, self.weights[column])
        return rows, _softmax(z / self.temperature)

    def confirmed(self, clean: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(paragraph, family, chance) of those that are likely, hold a template of their family and name its version and kind."""
        owner, column = self.active(clean, bounds)
        rows, chance = self.chances(owner, column)
        best = chance.argmax(1)
        top = chance[np.arange(len(rows)), best]
        likely = np.flatnonzero((best < len(FAMILIES) - 1) & (top >= self.least_chance))
        kept = []
        for i in likely:
            own = column[np.searchsorted(owner, rows[i]) : np.searchsorted(owner, rows[i], "right")]
            held = [v for (f, t), v in zip(self.templates, self.versioned, strict=True) if f == best[i] and np.isin(t, own).mean() >= self.least_contained]
            if not held:
                continue
            said = " ".join(clean[bounds[rows[i]] : bounds[rows[i] + 1]].tobytes().decode(errors="replace").split())
            if _names(FAMILIES[best[i]], said) and (not all(held) or _VERSION.search(said)):
                kept.append(i)
        kept = np.array(kept, np.int64)
        return rows[kept], best[kept], top[kept]

    def wrapped(self, clean: np.ndarray, bounds: np.ndarray, runs: np.ndarray) -> Iterator[tuple[int, int, int, float]]:
        """(first line, end line, family, chance) of confirmed windows of lines, within runs of several that hold a template; short windows first."""
        owner, column = self.active(clean, bounds[runs])
        places = np.flatnonzero(np.diff(runs) > 1)
        for k in places[np.isin(places, owner)]:
            own = column[np.searchsorted(owner, k) : np.searchsorted(owner, k, "right")]
            if not any(np.isin(t, own).mean() >= self.least_contained for _, t in self.templates):
                continue
            for n in range(2, min(_LINES, runs[k + 1] - runs[k]) + 1):
                first = np.arange(runs[k], runs[k + 1] - n + 1)
                parts = [clean[bounds[i] : bounds[i + n]] for i in first]
                rows, family, chance = self.confirmed(np.concatenate(parts), np.append(0, np.cumsum([len(x) for x in parts])))
                for r, f, c in zip(rows, family, chance, strict=True):
                    yield int(first[r]), int(first[r]) + n, int(f), float(c)

    def find(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, first byte, end byte, family, chance) of every confirmed statement."""
        clean, bounds = _prepared(data, offsets)
        rows, family, chance = self.confirmed(clean, bounds)
        taken = {(int(f), int(r)) for f, r in zip(family, rows, strict=True)}
        spans = [(int(r), int(r) + 1, int(f), float(c)) for r, f, c in zip(rows, family, chance, strict=True)]
        joined, runs = _unwrapped(clean, bounds, offsets, data)
        for first, last, f, c in self.wrapped(joined, bounds, runs):
            own = {(f, line) for line in range(first, last)}
            if not own & taken:
                taken |= own
                spans.append((first, last, f, c))
        spans.sort()
        first, last, family = (np.array([x[i] for x in spans], np.int64) for i in range(3))
        start, end = bounds[first], bounds[last]
        text = np.searchsorted(offsets, start, "right") - 1
        return text, start - offsets[text], end - offsets[text], family, np.array([x[3] for x in spans], np.float64)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True)) if len(z) else z
    return e / e.sum(1, keepdims=True) if len(z) else z


def _joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.append(0, np.cumsum([len(d) for d in data]))


def _varied(texts: list[str], filler: list[str], draw: np.random.Generator, copies: int) -> list[str]:
    """Statements with words left out, swapped for filler, or set between filler words."""
    out = []
    for text in texts:
        for c in range(copies):
            words = text.split()
            if c:
                words = [w if draw.random() > 0.06 else str(draw.choice(filler)) for w in words if draw.random() > 0.03]
                words = [*draw.choice(filler, draw.integers(0, 6)), *words, *draw.choice(filler, draw.integers(0, 6))]
            out.append(" ".join(words).replace(".", "") if c % 2 else " ".join(words))
    return out


def _blank_model(least_chance: float, least_contained: float) -> LicenseModel:
    """Feature numbers and templates, without weights."""
    column_of = np.full(_SLOTS, -1, np.int32)
    sets = []
    for family, texts in TEMPLATES.items():
        for text in texts:
            data, offsets = _joined([text])
            clean, _ = _prepared(data, offsets)
            _, slots = _grams(clean, np.array([0, len(clean)]))
            slots = np.unique(slots)
            fresh = slots[column_of[slots] < 0]
            column_of[fresh] = np.arange(len(fresh)) + column_of.max() + 1
            sets.append((FAMILIES.index(family), column_of[slots]))
    n = int(column_of.max()) + 1
    return LicenseModel(column_of, np.zeros((n, len(FAMILIES))), np.zeros(len(FAMILIES)), 1.0, sets, [_versioned(t) for texts in TEMPLATES.values() for t in texts], least_chance, least_contained)


def fit_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_documents: int = 2000, least_chance: float = 0.6, least_contained: float = 0.6, copies: int = 60, seed: int = 29) -> LicenseModel:
    """Train on the templates and on corpus paragraphs that share features with them but contain none.

    The corpus gives at most ``max_documents`` documents (in expectation, picked by a
    hash of their id), of which the paragraphs with features come to the driver, as
    feature numbers.
    """
    ship(docs)
    model = _blank_model(least_chance, least_contained)
    total = docs.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch["text"])
            for a, b in slices(offsets, _CHUNK):
                clean, bounds = _prepared(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                owner, column = model.active(clean, bounds)
                first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else np.zeros(0, np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(owner)).astype(np.int32)), pa.array(column.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([lists], ["features"])

    picked = docs.where(share(id_col, seed=seed) < max_documents / max(total, 1)).select(F.col(text_col).alias("text"))
    plain = [np.array(x) for x in picked.mapInArrow(run, "features array<int>").groupBy("features").count().toArrow()["features"].to_pylist()]
    plain = [x for x in plain if not any(np.isin(t, x).mean() >= 0.5 for _, t in model.templates)]

    draw = np.random.default_rng(seed)
    filler = [w for s in UNLIKE for w in s.split()]
    rows: list[np.ndarray] = list(plain)
    labels = [len(FAMILIES) - 1] * len(plain)
    for family, texts in [*TEMPLATES.items(), ("unknown", UNLIKE)]:
        made = _varied(list(texts), filler, draw, copies)
        data, offsets = _joined([t.lower() for t in made])
        clean, _ = _prepared(data, offsets)
        owner, column = model.active(clean, offsets)
        for i in range(len(made)):
            rows.append(column[owner == i])
            labels.append(FAMILIES.index(family))
    y = np.array(labels)
    held = draw.random(len(y)) < 0.3
    _train(model, [r for r, h in zip(rows, held, strict=True) if not h], y[~held])
    _calibrate(model, [r for r, h in zip(rows, held, strict=True) if h], y[held])
    return model


def _design(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.concatenate(rows).astype(np.int64) if rows else np.zeros(0, np.int64)


def _train(model: LicenseModel, rows: list[np.ndarray], y: np.ndarray, rounds: int = 300, rate: float = 0.1, ridge: float = 1e-4) -> None:
    """Full gradients with adaptive steps; families weigh the same."""
    row, column = _design(rows)
    k, n = len(FAMILIES), len(model.weights)
    seen = np.bincount(y, minlength=k)
    weight = (1 / np.maximum(seen, 1))[y] / max((seen > 0).sum(), 1)
    x = np.zeros((n + 1, k))
    first, second = np.zeros_like(x), np.zeros_like(x)
    for t in range(1, rounds + 1):
        z = np.tile(x[-1], (len(rows), 1))
        np.add.at(z, row, x[column])
        error = _softmax(z)
        error[np.arange(len(y)), y] -= 1
        error *= weight[:, None]
        gradient = np.zeros_like(x)
        np.add.at(gradient, column, error[row])
        gradient[:-1] += ridge * x[:-1]
        gradient[-1] = error.sum(0)
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        x -= rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    model.weights, model.base = x[:-1], x[-1]


def _calibrate(model: LicenseModel, rows: list[np.ndarray], y: np.ndarray) -> None:
    """The temperature with the best held-out likelihood."""
    row, column = _design(rows)
    z = np.tile(model.base, (len(rows), 1))
    np.add.at(z, row, model.weights[column])
    grid = np.geomspace(0.25, 8, 41)
    losses = [-np.log(_softmax(z / t)[np.arange(len(y)), y] + 1e-12).mean() for t in grid]
    model.temperature = float(grid[int(np.argmin(losses))])


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: LicenseModel | None = None) -> DataFrame:
    """``id, licenses, found`` for every row: families in order of first mention, and each statement.

    ``found`` lists ``start`` and ``end`` (bytes of the UTF-8 text), ``family`` and ``chance``.
    Null and empty texts have none; null ids and repeated rows pass through. Texts
    are scanned whole, without a shuffle. An empty table gives none.
    """
    ship(docs)
    model = model or fit_licenses(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch["text"])
            for a, b in slices(offsets, _CHUNK):
                text, start, end, family, chance = model.find(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                at = np.searchsorted(text, np.arange(b - a + 1))
                names = [[FAMILIES[f] for f in dict.fromkeys(family[at[i] : at[i + 1]].tolist())] for i in range(b - a)]
                parts = pa.StructArray.from_arrays([pa.array(start), pa.array(end), pa.array([FAMILIES[f] for f in family], pa.string()), pa.array(chance)], ["start", "end", "family", "chance"])
                found = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), parts)
                yield pa.RecordBatch.from_arrays([batch["id"].slice(a, b - a), pa.array(names, pa.list_(pa.string())), found], ["id", "licenses", "found"])

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(run, f"id {kind}, licenses array<string>, found array<struct<start:long,end:long,family:string,chance:double>>")
