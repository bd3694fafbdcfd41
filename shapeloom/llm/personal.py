"""Personal data: rules find the plain spellings, a semi-Markov random field adds the disguised ones.

1. ``base_spans`` matches four kinds by rule, in time linear in the text.
2. ``train_field`` fits a semi-Markov conditional random field on spellings made from
   what the rules found in a bounded sample of documents (``509 555 6973``, ``ann at
   mail dot com``) and on look-alikes (dates, versions, failed checksums) around them.
   Its features see a whole candidate span at once: digit groups, checksum,
   separators, form of the at and dot marks, borders.
3. ``added_spans`` takes the stretches between base spans where candidates exist and
   chooses borders and kinds together by dynamic programming over segments of at most
   ``_TOKENS`` tokens; whatever lies in no candidate is outside in any case.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shapeloom.llm.common import share, ship, slices, text_buffers

KINDS = ("email", "ip", "card", "phone")
SPANS = "array<struct<kind:string,start:bigint,end:bigint,added:boolean>>"

# The plain spellings. Every one is matched once, without retries.
_AT_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NUMBER_RUN = re.compile(r"[0-9+][0-9 .()+-]*+")
CARD_DIGITS, PHONE_DIGITS, PART_MOST = (12, 19), (9, 15), 255


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _is_card(text: str) -> bool:
    digits = _digits(text)
    return CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits)


def _parts_fit(parts: list[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= PART_MOST for p in parts)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` by code points, in order: leftmost matches of every kind, those that fail their test left out."""
    out, end = [], 0
    for m in _AT_DOMAIN.finditer(text):
        first = m.start()
        while first > end and text[first - 1] in _LOCAL:
            first -= 1
        if first < m.start():
            out.append((first, 0, m.end()))
            end = m.end()
    for run in _NUMBER_RUN.finditer(text):
        if run.end() - run.start() < 7:
            continue
        a, b = run.span()
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text, a, b) if _parts_fit(m[0].split("."))]
        out += [(m.start(), 2, m.end()) for m in _CARD.finditer(text, a, b) if _is_card(m[0])]
        out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text, a, b) if PHONE_DIGITS[0] <= len(_digits(m[0])) <= PHONE_DIGITS[1]]
    return sorted(out)


# The field.

_CHUNK = 1 << 22
_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|[ \t ]+|(?s:.)")
#: Tokens and digits of a segment at most, characters of a window around evidence, tokens between two digit groups.
_TOKENS, _MOST_DIGITS, _AROUND, _GAP = 24, 19, 96, 4
_SEPARATORS = frozenset([".", "-", "/", "(", ")", "[", "]", "+", "_", ":", "\n", "–", "•", "dot"])
_WORD_AT, _WORD_DOT = frozenset(["at"]), frozenset(["dot"])
_OPEN, _CLOSE = frozenset("([{<"), frozenset(")]}>")
_DIGIT_EVIDENCE = re.compile(r"[0-9](?:(?:[^\w,;!?\"'=]|_){0,4}+(?:[dD][oO][tT][^\w,;!?\"'=]{0,3}+)?[0-9]){3,}+")
_AT_EVIDENCE = re.compile(r"[aA][tT](?=\W{1,3}[A-Za-z0-9-]+(?:\.[A-Za-z]|\W{1,3}[dD][oO][tT]))")
_AT_BYTES = re.compile(rb"[aA][tT](?=\W{1,9}[A-Za-z0-9-]+(?:\.[A-Za-z]|\W{1,9}[dD][oO][tT]))")
_FEATURES = 1 << 12
#: Features that say nothing of an address, whose parts have any length.
_SHAPE = ("digits", "groups", "checksum", "even", "zero")
_OUTSIDE = len(KINDS)


@dataclass(frozen=True)
class Field:
    """Weights of features by kind, and of one label after another (the last label is outside)."""

    weights: np.ndarray
    follows: np.ndarray


@dataclass
class _Segment:
    first: int
    last: int
    kind: int
    features: np.ndarray


def _number(names: list[str]) -> np.ndarray:
    return np.array([zlib.crc32(n.encode()) % _FEATURES for n in names], np.int64)


def _class(char: str) -> str:
    if not char:
        return "none"
    if char.isspace():
        return "line" if char == "\n" else "space"
    return "digit" if char.isdigit() else "letter" if char.isalpha() else char


def _border(tokens: list[str], first: int, last: int) -> list[str]:
    before = tokens[first - 1][-1] if first else ""
    after = tokens[last][0] if last < len(tokens) else ""
    further = tokens[last + 1][0] if last + 1 < len(tokens) else ""
    own = tokens[first][0]
    return [f"before {_class(before)}", f"after {_class(after)}", f"after {_class(after)} {_class(further)}", f"first {_class(own) if own not in '+(' else own}"]


def _number_features(tokens: list[str], first: int, last: int) -> tuple[list[str], list[str]]:
    """Features of a span of digit groups, and the groups."""
    groups = [t for t in tokens[first:last] if t[0].isdigit()]
    between, gap = [], ""
    for t in tokens[first:last]:
        if t[0].isdigit():
            between.append(gap)
            gap = ""
        else:
            gap += "_" if t.isspace() and t != "\n" else t.lower()
    lead, gaps = between[0], between[1:]
    total = sum(map(len, groups))
    shape = "-".join(str(len(g)) for g in groups)
    digits = "".join(groups)
    names = [
        "bias", f"digits {total}", f"groups {shape}", f"group count {len(groups)}", f"lead {lead}", f"kinds of gap {len(set(gaps))}",
        f"plain {lead == '' and not gaps}", f"checksum {CARD_DIGITS[0] <= total <= CARD_DIGITS[1] and luhn(digits)}",
        f"checksum {CARD_DIGITS[0] <= total <= CARD_DIGITS[1] and luhn(digits)} {shape}", f"parts fit {len(groups) == 4 and _parts_fit(groups)}",
        f"parts fit {len(groups) == 4 and _parts_fit(groups)} one gap {len(set(gaps)) == 1}", f"even {len({len(g) for g in groups[:-1]}) == 1}", f"zero {digits[0] == '0'}",
        *{f"gap {g}" for g in gaps}, *_border(tokens, first, last),
    ]
    return names, groups


def _number_segments(tokens: list[str], free: list[bool]) -> Iterator[_Segment]:
    for first, token in enumerate(tokens):
        begins = token[0].isascii() and token[0].isdigit() or token in "+(" and first + 1 < len(tokens) and tokens[first + 1][0].isdigit()
        if not begins or not free[first] or (first and (tokens[first - 1][-1].isalnum() or (token[0].isdigit() and tokens[first - 1] in "+("))):
            continue
        total, gap, word = 0, 0, False
        for last in range(first, min(len(tokens), first + _TOKENS)):
            t = tokens[last]
            if not free[last]:
                break
            if t[0].isascii() and t[0].isdigit():
                total, gap, word = total + len(t), 0, False
                if total > _MOST_DIGITS:
                    break
                ends = last + 1 == len(tokens) or not tokens[last + 1][0].isalnum()
                if not ends or total < 4:
                    continue
                names, groups = _number_features(tokens, first, last + 1)
                kinds = [k for k, fits in ((1, len(groups) == 4 and max(map(len, groups)) <= 3), (2, total >= CARD_DIGITS[0]), (3, 7 <= total <= PHONE_DIGITS[1])) if fits]
                if kinds:
                    shapeless = _number([n for n in names if not n.startswith(_SHAPE)])
                    found = _number(names)
                    yield from (_Segment(first, last + 1, k, shapeless if k == 1 else found) for k in kinds)
            else:
                gap += 1
                if gap > _GAP or not (t.lower() in _SEPARATORS or (t.isspace() and len(t) <= 2)):
                    break


def _mark(tokens: list[str], at: int, words: frozenset, sign: str) -> tuple[int, int, str] | None:
    """An at or dot mark around the token ``at``, as tokens from and to and its form."""
    token = tokens[at].lower()
    if token != sign and token not in words:
        return None
    first, last, form = at, at + 1, "sign" if token == sign else "word"

    def space(i: int) -> bool:
        return 0 <= i < len(tokens) and tokens[i].isspace() and tokens[i] != "\n" and len(tokens[i]) <= 2

    if first and last < len(tokens) and tokens[first - 1] in _OPEN and tokens[last] in _CLOSE:
        first, last, form = first - 1, last + 1, form + " in brackets"
    if space(first - 1) and space(last):
        return first - 1, last + 1, form + " in spaces"
    return None if form == "word" else (first, last, form)


def _email_segments(tokens: list[str], free: list[bool]) -> Iterator[_Segment]:
    for at, token in enumerate(tokens):
        if token != "@" and token.lower() not in _WORD_AT:
            continue
        mark = _mark(tokens, at, _WORD_AT, "@")
        if mark is None:
            continue
        left, right, form = mark
        if not all(free[left:right]):
            continue
        starts, i = [], left - 1
        while i >= max(0, left - 8) and free[i] and (tokens[i].isascii() and (tokens[i].isalnum() or tokens[i] in "._%+-")):
            if tokens[i].isalnum() and (i == 0 or not tokens[i - 1][-1].isalnum()):
                starts.append(i)
            i -= 1
        ends, i, dots = [], right, []
        while i < min(len(tokens), right + _TOKENS) and free[i]:
            if not (tokens[i].isascii() and tokens[i].isalnum()):
                break
            while i < len(tokens) and free[i] and tokens[i].isascii() and (tokens[i].isalnum() or tokens[i] == "-"):
                i += 1
            if dots and tokens[i - 1].isalpha() and 2 <= len(tokens[i - 1]) <= 10:
                ends.append((i, list(dots)))
            dot = next((m for j in range(i, min(i + 3, len(tokens))) if (m := _mark(tokens, j, _WORD_DOT, ".")) and m[0] == i), None)
            if dot is None or not all(free[dot[0] : dot[1]]):
                break
            dots.append(dot[2])
            i = dot[1]
        for first in starts:
            for last, forms in ends:
                if last - first <= _TOKENS:
                    kinds = sorted(set(forms))
                    names = [
                        "email", f"at {form}", f"dots {kinds}", f"at {form} dots {kinds}", f"dot count {len(forms)}", f"top {min(len(tokens[last - 1]), 6)}", f"top of {tokens[last - 1].lower()}",
                        f"more of the local part {first > 0 and tokens[first - 1] in '._%+-'}", f"more of the domain {any(m[0] == last for j in range(last, min(last + 3, len(tokens))) if (m := _mark(tokens, j, _WORD_DOT, '.')))}",
                        f"local digits {any(t.isdigit() for t in tokens[first:left])}", f"local tokens {left - first}", *_border(tokens, first, last),
                    ]
                    yield _Segment(first, last, 0, _number(names))


def _segments(tokens: list[str], free: list[bool]) -> list[_Segment]:
    return [*_number_segments(tokens, free), *_email_segments(tokens, free)]


def _best(field: Field, n: int, segments: list[_Segment]) -> list[_Segment]:
    """The best chain of segments over ``n`` tokens; what lies between them is outside."""
    by_end: dict[int, list[_Segment]] = {}
    for s in segments:
        by_end.setdefault(s.last, []).append(s)
    score = np.full((n + 1, _OUTSIDE + 1), -np.inf)
    score[0, _OUTSIDE] = 0
    back: dict[tuple[int, int], tuple[int, int, _Segment | None]] = {}
    for t in range(1, n + 1):
        came = score[t - 1] + field.follows[:, _OUTSIDE]
        k = int(came.argmax())
        score[t, _OUTSIDE], back[t, _OUTSIDE] = came[k], (t - 1, k, None)
        for s in by_end.get(t, ()):
            came = score[s.first] + field.follows[:, s.kind]
            k = int(came.argmax())
            value = came[k] + field.weights[s.kind, s.features].sum()
            if value > score[t, s.kind]:
                score[t, s.kind], back[t, s.kind] = value, (s.first, k, s)
    at, label, out = n, int(score[n].argmax()), []
    while at:
        at, label, s = back[at, label]
        if s is not None:
            out.append(s)
    return out[::-1]


def _windows(text: str) -> Iterator[tuple[int, int]]:
    """Stretches around what may be evidence, apart from each other."""
    seen = [m.span() for m in _DIGIT_EVIDENCE.finditer(text)]
    seen += [m.span() for m in _AT_EVIDENCE.finditer(text)]
    at = text.find("@")
    while at >= 0:
        seen.append((at, at + 1))
        at = text.find("@", at + 1)
    yield from _merged([(max(0, a - _AROUND), min(len(text), b + _AROUND)) for a, b in seen])


def _tokens(text: str, first: int, last: int, taken: list[tuple[int, int]]) -> tuple[list[str], list[int], list[bool]]:
    """Tokens of a window, where they begin, and which are whole and outside the (sorted, merged) spans ``taken``."""
    tokens = _TOKEN.findall(text, first, last)
    at = first + np.append(0, np.cumsum([len(t) for t in tokens], dtype=np.int64))
    blocked = np.zeros(len(text[first:last]) + 1, np.int64)
    for a, b in taken:
        if a < last and b > first:
            blocked[max(a, first) - first : min(b, last) - first] = 1
    covered = np.append(0, np.cumsum(blocked))
    free = (covered[at[1:] - first] == covered[at[:-1] - first]).tolist()
    if first and text[first - 1].isalnum() and text[first].isalnum():
        free[0] = False
    if last < len(text) and text[last - 1].isalnum() and text[last].isalnum():
        free[-1] = False
    return tokens, at.tolist(), free


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def added_spans(field: Field, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` that the field adds beside the base spans, none of which it touches."""
    out, taken, near = [], _merged([(a, b) for a, _, b in base]), 0
    for first, last in _windows(text):
        while near < len(taken) and taken[near][1] <= first:
            near += 1
        stop = near
        while stop < len(taken) and taken[stop][0] < last:
            stop += 1
        tokens, at, free = _tokens(text, first, last, taken[near:stop])
        segments = _segments(tokens, free)
        if segments:
            out += [(at[s.first], s.kind, at[s.last]) for s in _best(field, len(tokens), segments)]
    return out


# Training.


def _totals(field: Field, n: int, segments: list[_Segment], scores: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Log of the sum over all chains, chance of every segment, and expected uses of every pair of labels."""
    width = _OUTSIDE + 1
    ahead, behind = np.full((n + 1, width), -np.inf), np.full((n + 1, width), -np.inf)
    by_end: dict[int, list[int]] = {}
    by_first: dict[int, list[int]] = {}
    for i, s in enumerate(segments):
        by_end.setdefault(s.last, []).append(i)
        by_first.setdefault(s.first, []).append(i)
    ahead[0, _OUTSIDE] = 0
    for t in range(1, n + 1):
        ahead[t, _OUTSIDE] = np.logaddexp.reduce(ahead[t - 1] + field.follows[:, _OUTSIDE])
        for i in by_end.get(t, ()):
            s = segments[i]
            ahead[t, s.kind] = np.logaddexp(ahead[t, s.kind], np.logaddexp.reduce(ahead[s.first] + field.follows[:, s.kind]) + scores[i])
    behind[n] = 0
    for t in range(n - 1, -1, -1):
        behind[t] = field.follows[:, _OUTSIDE] + behind[t + 1, _OUTSIDE]
        for i in by_first.get(t, ()):
            s = segments[i]
            behind[t] = np.logaddexp(behind[t], field.follows[:, s.kind] + scores[i] + behind[s.last, s.kind])
    total = float(np.logaddexp.reduce(ahead[n]))
    chance, pairs = np.zeros(len(segments)), np.zeros((width, width))
    for i, s in enumerate(segments):
        came = np.exp(ahead[s.first] + field.follows[:, s.kind] + scores[i] + behind[s.last, s.kind] - total)
        chance[i] = came.sum()
        pairs[:, s.kind] += came
    step = ahead[:-1] + field.follows[:, _OUTSIDE] + behind[1:, _OUTSIDE, None] - total
    pairs[:, _OUTSIDE] += np.exp(step).sum(0)
    return total, chance, pairs


@dataclass
class _Example:
    n: int
    segments: list[_Segment]
    gold: list[int]


def _example(text: str, spans: list[tuple[int, int, int]]) -> _Example | None:
    """A window as an example; None where a span is no candidate."""
    base = _merged([(a, b) for a, _, b in base_spans(text)])
    tokens, at, free = _tokens(text, 0, len(text), base)
    segments = _segments(tokens, free)
    place = {(at[s.first], s.kind, at[s.last]): i for i, s in enumerate(segments)}
    gold = [place.get(x) for x in spans]
    return None if None in gold or not segments else _Example(len(tokens), segments, gold)


def _loss(field: Field, example: _Example) -> tuple[float, np.ndarray, np.ndarray]:
    """How much likelier other chains are, and the gradient for segments and label pairs."""
    scores = np.array([field.weights[s.kind, s.features].sum() for s in example.segments])
    total, chance, pairs = _totals(field, example.n, example.segments, scores)
    chosen = sorted((example.segments[i] for i in example.gold), key=lambda s: s.first)
    own, at, label = 0.0, 0, _OUTSIDE
    for s in [*chosen, None]:
        for _ in range(at, example.n if s is None else s.first):
            own += field.follows[label, _OUTSIDE]
            pairs[label, _OUTSIDE] -= 1
            label = _OUTSIDE
        if s is not None:
            own += field.follows[label, s.kind]
            pairs[label, s.kind] -= 1
            at, label = s.last, s.kind
    chance[example.gold] -= 1
    return total - own - scores[example.gold].sum(), chance, pairs


def fit(examples: list[_Example], rounds: int = 8, rate: float = 0.3, decay: float = 1e-5) -> Field:
    """Stochastic steps with a rate per weight (AdaGrad); examples in the order given."""
    field = Field(np.zeros((len(KINDS), _FEATURES)), np.zeros((_OUTSIDE + 1, _OUTSIDE + 1)))
    seen, pairs_seen = np.full_like(field.weights, 1e-6), np.full_like(field.follows, 1e-6)
    for turn in range(rounds):
        for i in np.random.default_rng(turn).permutation(len(examples)):
            example = examples[i]
            _, chance, pairs = _loss(field, example)
            moved = np.zeros_like(field.weights)
            for s, c in zip(example.segments, chance, strict=True):
                np.add.at(moved[s.kind], s.features, c)
            where = np.nonzero(moved)
            step = moved[where] + decay * field.weights[where]
            seen[where] += step * step
            field.weights[where] -= rate * step / np.sqrt(seen[where])
            pairs[_OUTSIDE, _OUTSIDE] = 0
            pairs_seen[...] += pairs * pairs
            field.follows[...] -= 0.3 * rate * pairs / np.sqrt(pairs_seen)
    return field


def _spellings(kind: int, found: str, draw: np.random.Generator) -> list[str]:
    """Disguised spellings of a span that the rules found (or of another address of its form); no rule matches them."""
    if kind == 0:
        local, domain = found.split("@")
        parts = domain.split(".")
        ats, dots = [" at ", " (at) ", " [at] ", "(at)", "[at]", " @ ", " AT "], [" dot ", " (dot) ", " [dot] ", "[dot]", "(dot)", " . ", " DOT "]
        return [local + a + ".".join(parts) for a in ats] + [local + a + d.join(parts) for a in ats for d in dots] + [local + "@" + d.join(parts) for d in dots]
    if kind == 1:
        parts = found.split(".") if draw.random() < 0.5 else [str(int(draw.integers(10 ** int(draw.integers(1, 4))) % (PART_MOST + 1))) for _ in range(4)]
        return [gap.join(parts) for gap in (" . ", "[.]", "(.)", " dot ", "-", " [.] ", ". ", "[dot]", "/")]
    digits = _digits(found)
    if kind == 2:
        fours = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        return [gap.join(fours) for gap in (".", "/", "  ", " - ", "\n", "_", " . ", " / ")]
    a, b, c = digits[-10:-7], digits[-7:-4], digits[-4:]
    lead = digits[:-10] or "1"
    tens = [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"({a}){b}-{c}", f"({a}) {b} {c}", f"{a}/{b}-{c}", f"{a}/{b}/{c}"]
    return tens + [f"{lead} {tens[0]}", f"{lead}-{tens[1]}", f"{lead}.{tens[2]}", f"{lead} {tens[3]}", f"00{lead} {tens[3]}", f"+{lead}/{a}/{b}/{c}", f"00{lead} {tens[1]}", f"({a})/{b}/{c}"]


def _lookalikes(draw: np.random.Generator) -> list[str]:
    """Numbers and words that are none of the kinds."""

    def n(size: int) -> str:
        return "".join(map(str, draw.integers(0, 10, size)))

    def wrong(size: int) -> str:
        digits = n(size)
        return digits if not luhn(digits) else digits[:-1] + str((int(digits[-1]) + 1) % 10)

    card = wrong(16)
    fours = [card[i : i + 4] for i in range(0, 16, 4)]
    year, month, day = 1900 + int(draw.integers(150)), int(draw.integers(1, 13)), int(draw.integers(1, 29))
    big = str(int(draw.integers(256, 999)))
    return [
        card, *(gap.join(fours) for gap in (" ", "-", ".", "/", "  ", " - ", "\n", "_")), wrong(12), wrong(13), wrong(14), wrong(15), wrong(19), n(7), n(8), n(9), n(10), n(11), n(20), n(24),
        f"{year}-{month:02}-{day:02}", f"{day:02}.{month:02}.{year}", f"{year}-{month:02}-{day:02} {n(1)}{n(1)}:{n(2)}:{n(2)}", f"{month:02}/{day:02}/{year}", f"{year}{month:02}{day:02}",
        f"{day:02}/{month:02}/{year} - {day:02}/{month:02}/{year + 1}", f"{year}-{year + 5}", f"{n(1)}.{n(1)}.{n(2)}", f"{n(1)}.{n(2)}.{n(1)}.{n(2)}.{n(3)}", f"10.{big}.20.3", f"{big} . {big} . 3 . 4",
        f"{n(3)}.{n(3)}.{n(3)}", f"1.{n(3)}.{n(3)},{n(2)}", f"{n(2)} {n(2)} {n(2)} {n(2)} {n(2)}", f"{n(1)}-{n(5)}-{n(2)}", f"978-{n(1)}-{n(2)}-{n(6)}-{n(1)}", f"{n(4)}-{n(4)}", f"{n(3)}-{n(4)}",
        f"{n(5)} {n(5)}", f"{n(6)}-{n(6)}", f"{n(1)}.{n(6)} {n(1)}.{n(6)}", f"({n(2)}.{n(1)}, {n(2)}.{n(1)})", f"{n(3)} + {n(4)}", f"{n(5)}/{n(6)}", f"({year}) {n(3)}", f"{n(1)}. {n(3)} {n(3)}",
        "look at the dot on the page", "stay at home. Then go", "we met at noon. Mr dot", "at one dot com fair", "all at once. And", "it was at rest . no more", "handle @name and more", "a @ b", "@ home. now",
    ]


def examples_from(windows: list[tuple[str, str, int, str]], seed: int = 29) -> list[_Example]:
    """Examples from ``(text before, span, kind, text after)`` (kind -1: a look-alike stands in the place of a span)."""
    out = []
    for i, (before, found, kind, after) in enumerate(windows):
        draw = np.random.default_rng([seed, i])
        spelled = _lookalikes(draw) if kind < 0 else _spellings(kind, found, draw)
        own = spelled[int(draw.integers(len(spelled)))]
        ends = ("", ".", ",", ")", "!", "\n", ";", " -", ":")
        end = ends[int(draw.integers(len(ends)))] if draw.random() < 0.4 else ""
        gap = "" if not before or draw.random() < 0.1 and kind != 0 and not before[-1].isalnum() else " " if draw.random() < 0.8 else "\n"
        head = before.rstrip() + gap if before else ""
        if head and head[-1].isalnum():
            head += " "
        text = head + own + end + " " + after.lstrip()
        spans = [] if kind < 0 else [(len(head), kind, len(head) + len(own))]
        if (made := _example(text, spans)) is not None:
            out.append(made)
    return out


def training_windows(docs: DataFrame, id_col: str, text_col: str, max_documents: int, seed: int, around: int = 48) -> list[tuple[str, str, int, str]]:
    """Base spans of a hashed sample of documents with the text around them, and a look-alike place for each."""

    @F.arrow_udf("array<struct<before:string,found:string,kind:int,after:string>>")
    def spans(texts: pa.Array) -> pa.Array:
        rows = []
        for text in texts.to_pylist():
            text = text or ""
            own = [{"before": text[max(0, a - around) : a], "found": text[a:b], "kind": k, "after": text[b : b + around]} for a, k, b in base_spans(text) if b - a <= around]
            rows.append(own[:8])
        return pa.array(rows, pa.list_(pa.struct([("before", pa.string()), ("found", pa.string()), ("kind", pa.int32()), ("after", pa.string())])))

    seen = docs.where(F.col(text_col).rlike("[0-9@]"))
    total = seen.count()
    if not total:
        return []
    picked = seen.where(share(F.col(id_col), F.col(text_col), seed=seed) < F.lit(min(1.0, 0.9 * max_documents / total)))
    found = picked.select(F.explode(spans(F.col(text_col))).alias("x")).select("x.*").distinct().orderBy("found", "before", "kind", "after").limit(max_documents)
    rows = [(r.before, r.found, r.kind, r.after) for r in found.collect()]
    return rows + [(b, f, -1, a) for b, f, _, a in rows]


#: Spans to learn from where documents hold none of a kind.
_MADE = [("", "ann.lee@mail.example.org", 0, ""), ("", "192.168.10.24", 1, ""), ("", "4111111111111111", 2, ""), ("", "+1 (555) 010-9988", 3, "")]


def train_field(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_documents: int = 800, seed: int = 29) -> Field:
    """Fit on at most ``max_documents`` spans from a sample of about as many documents with digits or an at sign.

    The sample is drawn by content, so the same table gives the same field. Where a
    kind is missing, made-up spans stand in.
    """
    windows = training_windows(docs, id_col, text_col, max_documents, seed)
    for _, found, kind, _ in _MADE:
        own = sum(w[2] == kind for w in windows)
        windows += [(f"the word {i % 7} was", found, k, "and so on") for i in range(max(0, 60 - own)) for k in (kind, -1)]
    return fit(examples_from(windows, seed))


def find_spans(text: Column, field: Field | None) -> Column:
    """All spans of a text (null: none), base ones and those that the field adds, by start and kind."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("added", pa.bool_())]))
    telling = np.isin(np.arange(256), [*range(48, 58), 64])

    def hints(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Texts with a digit, an at sign or (for the field) the word at before what may be a domain."""
        out = np.zeros(len(offsets) - 1, bool)
        for a, b in slices(offsets, _CHUNK):
            part = data[offsets[a] : offsets[b]]
            places = np.flatnonzero(telling[part])
            if field is not None:
                places = np.append(places, np.array([m.start() for m in _AT_BYTES.finditer(part)], np.int64))
            out[np.searchsorted(offsets, places + offsets[a], "right") - 1] = True
        return out

    @F.arrow_udf(SPANS)
    def run(texts: pa.Array) -> pa.Array:
        data, offsets = text_buffers(texts)
        sizes, found = np.zeros(len(texts) + 1, np.int32), []
        for i in np.flatnonzero(hints(data, offsets)).tolist():
            plain = data[offsets[i] : offsets[i + 1]].tobytes().decode()
            base = base_spans(plain)
            own = [(*x, False) for x in base]
            if field is not None:
                own += [(*x, True) for x in added_spans(field, plain, base)]
            sizes[i + 1] = len(own)
            found += sorted(own)
        starts, kinds, ends, added = zip(*found, strict=True) if found else ((), (), (), ())
        values = pa.StructArray.from_arrays([pa.array([KINDS[k] for k in kinds], pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64()), pa.array(added, pa.bool_())], fields=list(kind.value_type))
        return pa.ListArray.from_arrays(pa.array(np.cumsum(sizes, dtype=np.int32)), values).cast(kind)

    return run(text)


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; of spans that overlap the first one names all. Null stays null."""

    @F.arrow_udf("string")
    def run(texts: pa.Array, found: pa.Array) -> pa.Array:
        out = []
        for plain, own in zip(texts, found, strict=True):
            plain, at, pieces = plain.as_py(), 0, []
            for x in own.as_py() or () if plain is not None else ():
                if x["start"] >= at:
                    pieces += [plain[at : x["start"]], f"[{x['kind']}]"]
                at = max(at, x["end"])
            out.append(None if plain is None else "".join(pieces) + plain[at:])
        return pa.array(out, pa.string())

    return run(text, spans)


def with_personal_data(docs: DataFrame, field: Field | None = None, id_col: str = "doc_id", text_col: str = "text", out: str = "spans") -> DataFrame:
    """``docs`` with the spans of each text in ``out`` (an existing column of that name is replaced).

    ``field`` defaults to one trained on ``docs``. Null and empty texts have no spans;
    documents are independent, so repeated rows and any text length are fine, and ids
    (null ones too) only pick the sample. An empty table gives none.
    """
    ship(docs)
    field = train_field(docs, id_col, text_col) if field is None else field
    return docs.withColumn(out, find_spans(F.col(text_col), field))
