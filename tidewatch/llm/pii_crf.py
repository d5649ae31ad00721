"""Personal data: fixed base patterns, and a semi-Markov conditional random field that adds
spans which the patterns miss.

The base finds leftmost non-overlapping matches of a pattern for each kind and drops those
that fail a check; its spans always stay. The random field works on regions of text around
digits, at signs and written-out at signs. A region is cut into tokens; the model scores
whole segments of up to ``MAX_TOKENS`` tokens as one kind (by the segment's shape, digit
groups, Luhn sum, separators and neighbours) and single tokens as none, with weights for
the kinds of neighbouring segments. Dynamic programming over ends and kinds of segments picks
boundaries and kinds together. Base spans are given, so the field decides on what lies between
them; a card that it adds passes the Luhn sum, an address of numbers has four octets, a
phone number 7 to 15 digits.

Training maximises the penalised likelihood by forward-backward sums over all
segmentations. It learns from base matches in a bounded sample of documents, drawn for each
kind from those with a base match of it (and from some without any), from some made-up lines
of each kind, and from the same matches rewritten in forms that the patterns don't know (a phone number without its plus,
a card in groups with dots, an address with "(at)"), and from numbers that are no personal
data (dates, times, versions, prices, coordinates, octets out of range, failing Luhn sums).
"""

from __future__ import annotations

import heapq
import random
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import id_and_text, map_arrow, stage_table

KINDS = ("email", "ip", "card", "phone")
#: bound on the documents that the model is fitted on
SAMPLE_ROWS = 200
#: regions of a document in the sample that the model learns from (those with base matches first), and their longest
SAMPLE_REGIONS, SAMPLE_REGION_CHARS = 20, 500
#: made-up lines of each kind that the model learns from besides, since the table may have none
MADE_UP = 50
#: an entity has at most so many tokens, if it is no whole address
MAX_TOKENS = 24
#: characters around a trigger that belong to its region
REACH = 32

# fixed values: the contract's patterns (an address is found from its at sign, so that long words cost no time)
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_AFTER_AT = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_TRIGGER = re.compile(r"[0-9@]+|[(\[] ?at ?[)\]]", re.IGNORECASE)
_AT = re.compile(r" ?(?:@|[(\[] ?at[)\]]) ?", re.IGNORECASE)
_WORD = re.compile(r"[\w.%+-]")
_HOST = re.compile(r"[\w-]++(?:\.[\w-]++)*")
_LINE = re.compile(r"(?:\S+|\s{1,2}(?=\S)(?<!\n)(?<!\n.))+")
#: a word or number goes on across a mark
_ON_LEFT, _ON_RIGHT = re.compile(r"\w[.@+-]$"), re.compile(r"[.@+-]\w")
_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|\s+|.", re.DOTALL)

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def digits_of(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def base_spans(text: str) -> list[Span]:
    """Base matches, by kind as listed, then by start."""
    out: list[Span] = []
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text, start - 1):
            start -= 1
        m = _AFTER_AT.match(text, at) if start < at else None
        if m:
            out.append(("email", start, m.end()))
        done = m.end() if m else at + 1
        at = text.find("@", done)
    if not re.search("[0-9]", text):
        return out
    out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return out


def regions(text: str) -> Iterator[tuple[int, int]]:
    """Stretches of a text around its triggers, widened to white space or the edge of the text; they don't overlap."""
    start = end = -1
    for m in _TRIGGER.finditer(text):
        a, b = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        while a > max(end, 0) and not text[a - 1].isspace():
            a -= 1
        if start < 0 or a > end:
            if start >= 0:
                yield start, end
            start = a
        if b > end:
            while b < len(text) and not text[b - 1].isspace() and not text[b].isspace():
                b += 1
            end = b
    if start >= 0:
        yield start, end


def gaps(text: str, base: list[Span]) -> Iterator[tuple[int, int]]:
    """What lies between base spans in the regions, where it holds a trigger, cut at line breaks and wide space (no entity
    holds these, so that a decision on one side doesn't depend on the other)."""
    starts = sorted((s, e) for _, s, e in base)
    k = 0
    for a, b in regions(text):
        at, pieces = a, []
        while k < len(starts) and starts[k][0] < b:
            s, e = starts[k]
            if s > at:
                pieces.append((at, s))
            at = max(at, e)
            k += 1
        if at < b:
            pieces.append((at, b))
        for s, e in pieces:
            for m in _LINE.finditer(text, s, e):
                if _TRIGGER.search(text, m.start(), m.end()):
                    yield m.start(), m.end()


@dataclass
class Lattice:
    """Candidate segments of a region: ends in tokens, kinds that may hold, feature ids."""

    n: int
    segments: list[tuple[int, int]] = field(default_factory=list)
    features: list[list[str]] = field(default_factory=list)
    spans: list[tuple[int, int]] = field(default_factory=list)


def shape(text: str) -> str:
    s = re.sub(r"[0-9]+", lambda m: f"d{min(len(m[0]), 20)}", re.sub(r"[^\W\d_]+", "a", text))
    return s[:40]


def lattice(text: str, start: int, end: int) -> Lattice:
    """Tokens of a region as segments of one token (kind none), then the candidates for entities."""
    tokens = [(m.start(), m.end()) for m in _TOKEN.finditer(text, start, end)]
    lat = Lattice(len(tokens))
    for k, (a, b) in enumerate(tokens):
        t = text[a:b]
        lat.segments.append((k, k + 1))
        lat.spans.append((a, b))
        lat.features.append(["bias", "t:" + ("a" if t[0].isalpha() else f"d{min(b - a, 9)}" if t[0].isdigit() else t[0])])
    digits = [b - a if text[a].isdigit() and text[a].isascii() else 0 for a, b in tokens]
    for i, (a, _) in enumerate(tokens):
        c = text[a]
        if not (c.isalnum() or c in "+(") or (a and text[a - 1].isalnum()):
            continue
        n, at = 0, False
        for j in range(i, min(len(tokens), i + MAX_TOKENS)):
            x, b = tokens[j]
            t = text[x:b]
            if t.isspace() and (b - x > 2 or "\n" in t):
                break
            n += digits[j]
            if n > 19:
                break
            at = at or t == "@" or (t.lower() == "at" and x and text[x - 1] in "([ " and text[b:b + 1] in (")", "]"))
            if not (text[b - 1].isalnum() and (at or n >= 4)) or text[b:b + 1].isalnum():
                continue
            s = text[a:b]
            if not at and re.search(r"[^\W\d_]", s):
                break  # without an at sign, only digits and separators
            lat.segments.append((i, j + 1))
            lat.spans.append((a, b))
            lat.features.append(segment_features(s, n, at, text[max(a - 2, 0):a], text[b:b + 2]))
    # addresses as wide as their characters go, however many tokens that is
    seen = set(lat.spans[lat.n:])
    first, last = {a: k for k, (a, _) in enumerate(tokens)}, {b: k + 1 for k, (_, b) in enumerate(tokens)}
    for m in _AT.finditer(text, start, end):
        a = m.start()
        while a > start and _WORD.match(text, a - 1):
            a -= 1
        while a < m.start() and not text[a].isalnum():
            a += 1
        host = _HOST.match(text, m.end(), end)
        b = host.end() if host else m.end()
        while b > m.end() and not text[b - 1].isalnum():
            b -= 1
        if a < m.start() and b > m.end() and (a, b) not in seen and a in first and b in last:
            s = text[a:b]
            lat.segments.append((first[a], last[b]))
            lat.spans.append((a, b))
            lat.features.append(segment_features(s, sum(digits[first[a]:last[b]]), True, text[max(a - 2, 0):a], text[b:b + 2]))
    return lat


def segment_features(s: str, n: int, at: bool, before: str, after: str) -> list[str]:
    """Features of a whole segment, with two characters on each side of it."""
    goes_on = f"{bool(_ON_LEFT.search(before))}{bool(_ON_RIGHT.match(after))}"
    before, after = before[-1:], after[:1]
    sh = shape(s)
    groups = re.findall(r"[0-9]+", s)
    marks = "".join(sorted(set(re.sub(r"[\w]", "", s))))
    f = ["bias", "shape:" + sh if not at else "at-shape:" + re.sub(r"d[0-9]+", "d", re.sub(r"[a.]*a", "a", sh))[:24], f"digits:{n}", f"groups:{min(len(groups), 6)}", "marks:" + marks, f"first:{s[0] if not s[0].isalnum() else '0' if s[0].isdigit() else 'a'}"]
    f.append(f"around:{'s' if before.isspace() or not before else before if not before.isalnum() else 'x'}{'s' if after.isspace() or not after else after if not after.isalnum() else 'x'}")
    f.append("goes on:" + goes_on)
    if at:
        local, _, host = re.sub(r" ?[(\[] ?at ?[)\]] ?", "@", s, count=1, flags=re.IGNORECASE).partition("@")
        f += [f"dot:{'.' in host}", f"clean:{bool(re.fullmatch(r'[A-Za-z0-9._%+-]+', local))}{bool(re.fullmatch(r'[A-Za-z0-9-]+([.][A-Za-z0-9-]+)*', host))}", f"spaces:{min(s.count(' '), 3)}"]
    else:
        f.append(f"luhn:{n >= 13 and luhn(digits_of(s))}")
        f.append(f"octets:{len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups)}:{marks}")
        f.append("lens:" + ".".join(str(min(len(g), 9)) for g in groups[:6]))
    return f


@dataclass
class SemiCrf:
    index: dict[str, int]
    weights: np.ndarray  # features x (none, kinds)
    moves: np.ndarray  # kind before x kind

    def scores(self, lat: Lattice) -> np.ndarray:
        out = np.zeros((len(lat.segments), len(KINDS) + 1))
        for k, f in enumerate(lat.features):
            ids = [i for i in (self.index.get(x) for x in f) if i is not None]
            out[k] = self.weights[ids].sum(axis=0)
        out[: lat.n, 1:] = -np.inf  # a single token's own segment is none; entities have segments of theirs
        out[lat.n:, 0] = -np.inf
        at = np.array([f[1].startswith("at-shape:") for f in lat.features[lat.n:]], bool)  # an address, and nothing else, has an at sign
        out[lat.n:, 1][~at] = -np.inf
        out[lat.n:, 2:][at] = -np.inf
        return out

    def decode(self, lat: Lattice) -> list[Span]:
        """Best segmentation."""
        s, by_end = self.scores(lat), ends(lat)
        best = np.full((lat.n + 1, len(KINDS) + 1), -np.inf)
        best[0, 0] = 0.0
        back: dict[tuple[int, int], tuple[int, int]] = {}
        for e in range(1, lat.n + 1):
            for k in by_end[e]:
                step = (best[lat.segments[k][0]][:, None] + self.moves) + s[k]
                top = step.argmax(axis=0)
                for y in np.flatnonzero(np.isfinite(s[k])):
                    if step[top[y], y] > best[e, y]:
                        best[e, y] = step[top[y], y]
                        back[e, int(y)] = (k, int(top[y]))
        out, e, y = [], lat.n, int(best[lat.n].argmax())
        while e > 0:
            k, before = back[e, y]
            if y:
                out.append((KINDS[y - 1], *lat.spans[k]))
            e, y = lat.segments[k][0], before
        return out[::-1]


def ends(lat: Lattice) -> list[list[int]]:
    out: list[list[int]] = [[] for _ in range(lat.n + 1)]
    for k, (_, e) in enumerate(lat.segments):
        out[e].append(k)
    return out


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    m = np.where(np.isfinite(m), m, 0.0)
    with np.errstate(divide="ignore"):
        return np.log(np.exp(x - m).sum(axis=axis)) + m.squeeze(axis)


def forward(lat: Lattice, s: np.ndarray, by_end: list[list[int]], moves: np.ndarray) -> np.ndarray:
    """For each token edge and kind of the segment that ends there, the log sum over all segmentations up to it."""
    ahead = np.full((lat.n + 1, len(KINDS) + 1), -np.inf)
    ahead[0, 0] = 0.0
    for e in range(1, lat.n + 1):
        for k in by_end[e]:
            ahead[e] = np.logaddexp(ahead[e], _logsum(ahead[lat.segments[k][0]][:, None] + moves, 0) + s[k])
    return ahead


def train(examples: list[tuple[Lattice, dict[int, int]]], epochs: int = 5, rate: float = 0.3, l2: float = 1e-3, seed: int = 3) -> SemiCrf:
    """Adagrad on the likelihood. An example is a lattice and the kinds of its true entity segments (by number)."""
    names = sorted({f for lat, _ in examples for fs in lat.features for f in fs})
    crf = SemiCrf({f: i for i, f in enumerate(names)}, np.zeros((len(names), len(KINDS) + 1)), np.zeros((len(KINDS) + 1, len(KINDS) + 1)))
    w_sq, m_sq = np.full(crf.weights.shape, 1e-6), np.full(crf.moves.shape, 1e-6)
    ids = [[[crf.index[f] for f in fs] for fs in lat.features] for lat, _ in examples]
    tables = [ends(lat) for lat, _ in examples]
    rng = random.Random(seed)
    order = list(range(len(examples)))
    for _ in range(epochs):
        rng.shuffle(order)
        for x in order:
            lat, true = examples[x]
            s, by_end = crf.scores(lat), tables[x]
            ahead = forward(lat, s, by_end, crf.moves)
            behind = np.full_like(ahead, -np.inf)
            behind[lat.n] = 0.0
            total = float(_logsum(ahead[lat.n], 0))
            g_moves = np.zeros_like(crf.moves)
            grads: dict[int, np.ndarray] = {}
            for e in range(lat.n, 0, -1):
                for k in by_end[e]:
                    a = lat.segments[k][0]
                    out = s[k] + behind[e]
                    pair = ahead[a][:, None] + crf.moves + out - total
                    p = np.exp(pair)
                    g_moves += p
                    mass = p.sum(axis=0)
                    if k >= lat.n or mass[0] < 0.999999:
                        grads[k] = mass
                    behind[a] = np.logaddexp(behind[a], _logsum(crf.moves + out[None, :], 1))
            inside = {t for k in true for t in range(*lat.segments[k])}
            last, at = 0, 0
            starts = {lat.segments[k][0]: k for k in true}
            while at < lat.n:
                k = starts.get(at, at)
                y = true.get(k, 0)
                grads[k] = grads.get(k, np.eye(len(KINDS) + 1)[0] if k < lat.n and k not in inside else np.zeros(len(KINDS) + 1)).copy()
                grads[k][y] -= 1.0
                g_moves[last, y] -= 1.0
                last, at = y, lat.segments[k][1]
            for k, g in grads.items():
                if np.abs(g).max() < 1e-7:
                    continue
                i = ids[x][k]
                d = g + l2 * crf.weights[i]
                w_sq[i] += d * d
                crf.weights[i] -= rate * d / np.sqrt(w_sq[i])
            m_sq += g_moves * g_moves
            crf.moves -= rate * g_moves / np.sqrt(m_sq)
    return crf


def rewritten(kind: str, text: str, rng: random.Random) -> str | None:
    """A span in a form that the base patterns don't know."""
    d = digits_of(text)
    if kind == "phone" and len(d) >= 10:
        n = d[-10:]
        plain = rng.choice([f"({n[:3]}) {n[3:6]}-{n[6:]}", f"{n[:3]}-{n[3:6]}-{n[6:]}", f"{n[:3]}.{n[3:6]}.{n[6:]}", f"{n[:3]} {n[3:6]}-{n[6:]}"])
        return rng.choice(["", "", "", "1-" if plain[0] != "(" else "1 "]) + plain
    if kind == "card" and len(d) == 16:
        return rng.choice([".", "  "]).join(d[k:k + 4] for k in range(0, 16, 4))
    if kind == "email":
        local, _, host = text.partition("@")
        return local + rng.choice([" (at) ", "(at)", " [at] ", "[at]"]) + host
    return None


def counterexample(rng: random.Random) -> str:
    """A number that is no personal data."""
    r = rng.randint
    return rng.choice([
        f"{r(1900, 2099)}-{r(1, 12):02}-{r(1, 28):02}", f"{r(1, 28)}.{r(1, 12)}.{r(1900, 2099)}", f"{r(1, 12)}/{r(1, 28)}/{r(1900, 2099)}",
        f"{r(0, 23):02}:{r(0, 59):02}:{r(0, 59):02}", f"{r(1, 20)}.{r(0, 40)}.{r(0, 99)}", f"{r(1, 999)},{r(0, 999):03}.{r(0, 99):02}", f"{r(10**6, 10**12)}",
        f"{r(1900, 2000)}-{r(2001, 2099)}", f"{r(1, 99)}.{r(0, 10**6)}", f"{r(300, 999)}.{r(300, 999)}.{r(0, 99)}.{r(0, 9)}", f"{r(10**12, 10**18)}", f"{r(1, 9)} {r(10, 99)} {r(100, 999)} {r(1000, 9999)}",
        f"{r(100, 999)} {r(100, 999)} {r(100, 999)}", f"{r(1, 200)}@{r(1, 99)}", f"{r(0, 9)}{r(0, 9)} @ {r(0, 9)}", f"{rng.choice('abcxyz')}@{rng.choice('abcxyz')}", unlucky(r(4 * 10**15, 5 * 10**15)),
        f"{r(0, 89)}.{r(1000, 9999)} {r(0, 179)}.{r(1000, 9999)}", f"{r(0, 89)}.{r(10**4, 10**6)}, -{r(0, 179)}.{r(10**4, 10**6)}", f"{r(1, 255)}.{r(0, 255)}.{r(0, 255)}.{r(256, 999)}", f"{r(256, 999)}.{r(0, 255)}.{r(0, 255)}.{r(0, 255)}",
        rng.choice("- .").join(re.findall("....", unlucky(r(4 * 10**15, 5 * 10**15)))), f"{r(1900, 2099)}-{r(1, 12):02}-{r(1, 28):02} {r(0, 23):02}:{r(0, 59):02}:{r(0, 59):02}", f"{r(1, 30)}.{r(0, 99)}.{r(0, 9999)}.{r(1000, 9999)}",
        f"{r(100, 999)}-{r(10, 99)}-{r(1000, 9999)}", f"978-{r(0, 9)}-{r(100, 999)}-{r(10000, 99999)}-{r(0, 9)}",
    ])


def unlucky(n: int) -> str:
    """A number of card length that fails the Luhn sum."""
    return str(n + luhn(str(n)))


def examples_of(text: str, rng: random.Random) -> list[tuple[Lattice, dict[int, int]]]:
    """Examples from the regions of a training text: as they are, rewritten, and with the spans replaced by counterexamples."""
    out = []
    spans = base_spans(text)
    for a, b in regions(text):
        here = sorted((s, e, k) for k, s, e in spans if a <= s and e <= b)
        if any(x[1] > y[0] for x, y in zip(here, here[1:])):
            continue  # base spans that overlap aren't one segmentation
        for way in ("as is", "rewritten", "counter") if here else ("as is",):
            line, true, last = "", [], a
            for s, e, k in here:
                line += text[last:s]
                new = text[s:e] if way == "as is" else counterexample(rng) if way == "counter" else rewritten(k, text[s:e], rng) or text[s:e]
                if way != "counter":
                    true.append((len(line), len(line) + len(new), KINDS.index(k) + 1))
                line += new
                last = e
            line += text[last:b]
            lat = lattice(line, 0, len(line))
            where = {span: k for k, span in enumerate(lat.spans) if k >= lat.n}
            if all((s, e) in where for s, e, _ in true):
                out.append((lat, {where[s, e]: y for s, e, y in true}))
    return out


def made_up(kind: str, rng: random.Random) -> str:
    """A line with a base match of a kind."""
    r = rng.randint
    word = lambda: "".join(rng.choice("abcdefghijklmnoprstuvwxyz") for _ in range(r(2, 9)))
    if kind == "email":
        host = ".".join(rng.choice([word(), f"{word()}-{word()}"]) for _ in range(r(1, 3)))
        x = rng.choice([f"{word()}.{word()}", word(), f"{word()}{r(1, 99)}", f"{word()}-{word()}.{word()}"]) + f"@{host}.{rng.choice(['com', 'org', 'example.com', 'co.uk', 'de'])}"
    elif kind == "ip":
        x = ".".join(str(r(0, 255)) for _ in range(4))
    elif kind == "card":
        n = r(10**14, 10**15 - 1)
        x = next(d for k in range(10) if luhn(d := f"{n}{k}"))
        x = rng.choice(["", " ", "-"]).join(x[k:k + 4] for k in range(0, 16, 4))
    else:
        x = rng.choice([f"+{r(1, 99)} ({r(100, 999)}) {r(100, 999)}-{r(1000, 9999)}", f"+{r(1, 99)} {r(100, 999)} {r(100, 999)} {r(1000, 9999)}", f"+{r(10**10, 10**12)}"])
    return f"{word()} {word()} {x}{rng.choice(['', '', '.', ','])} {word()} {word()}"


def sample_ids(src: DataFrame, rows: int) -> list[int]:
    """Hashes of ``rows`` documents at most: for each kind in turn the least hash of those with a base match of it that is
    not taken yet, and likewise of those without any. ``src`` has ``h``, ``__text``."""
    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[set[int]] = [set() for _ in range(len(KINDS) + 1)]
        for b in batches:
            for h, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for k in {KINDS.index(x[0]) for x in base_spans(t)} or {len(KINDS)}:
                    found[k].add(h)
            found = [set(heapq.nsmallest(rows, x)) if len(x) > rows else x for x in found]
        out = [(k, h) for k, x in enumerate(found) for h in x]
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.int64())], names=["kind", "h"])

    every = stage_table(map_arrow(src, least, "kind int, h long"), "pii-hashes")
    groups = [every.filter(F.col("kind") == k).distinct().orderBy("h").limit(rows) for k in range(len(KINDS) + 1)]
    got = reduce(DataFrame.union, groups).collect()
    queues = [sorted((r["h"] for r in got if r["kind"] == k), reverse=True) for k in range(len(KINDS) + 1)]
    out: dict[int, None] = {}
    while any(queues) and len(out) < rows:
        for q in queues:
            while q and q[-1] in out:
                q.pop()
            if q and len(out) < rows:
                out[q.pop()] = None
    return list(out)


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE_ROWS) -> SemiCrf | None:
    """Fit on ``rows`` documents with a trigger, drawn evenly for all kinds, by the hashes of their ids. None for an empty table."""
    src = id_and_text(df, id_col, text_col).filter(F.col("__text").rlike(r"[0-9]{2}|@"))
    src = src.select(F.xxhash64(F.coalesce(F.col("__id").cast("string"), F.lit("")), F.lit("pii")).alias("h"), "__text")
    # the hashes alone are gathered, so that no task gathers texts
    ids = sample_ids(src, rows)
    if not ids and df.isEmpty():
        return None
    sample = src.filter(F.col("h").isin(ids))

    def snippets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for h, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                # first the regions with base matches, then the others
                starts = sorted(x[1] for x in base_spans(t))
                near = sorted((x for x in regions(t) if x[1] - x[0] < SAMPLE_REGION_CHARS), key=lambda x: bisect_left(starts, x[0]) == bisect_left(starts, x[1]))
                out += [(h, k, t[a:e]) for k, (a, e) in enumerate(near[:SAMPLE_REGIONS])]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.string())], names=["h", "k", "part"])

    # rows may share an id; the bound comes after the texts were cut
    got = sorted(map_arrow(sample, snippets, "h long, k long, part string").limit(2 * rows * SAMPLE_REGIONS).toArrow().to_pylist(), key=lambda r: (r["h"], r["k"], r["part"]))
    rng = random.Random(1)
    examples = [x for r in got for x in examples_of(r["part"], rng)]
    return train(examples + [x for kind in KINDS for _ in range(MADE_UP) for x in examples_of(made_up(kind, rng), rng)])


def find(text: str | None, crf: SemiCrf | None) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans (base and added), each by kind as listed, then start."""
    if not text:
        return [], []
    base = base_spans(text)
    if crf is None:
        return base, base
    added = [x for a, b in gaps(text, base) for x in crf.decode(lattice(text, a, b)) if holds(x[0], text[x[1]:x[2]])]
    return base, sorted({*base, *added}, key=lambda x: (KINDS.index(x[0]), x[1], x[2]))


def holds(kind: str, s: str) -> bool:
    """What a span of a kind must have, whatever the model says."""
    d = digits_of(s)
    if kind == "card":
        return 13 <= len(d) <= 19 and luhn(d)
    if kind == "ip":
        groups = re.findall("[0-9]+", s)
        return len(groups) == 4 and all(len(g.lstrip("0")) <= 3 and int(g) <= 255 for g in groups)
    return kind != "phone" or 7 <= len(d) <= 15


_SPANS = "array<struct<kind:string,start:int,end:int>>"
_SPANS_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def spans(df: DataFrame, crf: SemiCrf | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``base`` and ``spans``: arrays of (kind, start, end) in code points, end exclusive.

    Null and empty texts have no spans; repeated rows each give a row; other columns are left
    out; an empty table gives an empty result. Whole texts, no shuffle.
    """
    src = id_and_text(df, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [find(t, crf) for t in b.column(1).to_pylist()]
            cols = [pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in x[i]] for x in got], _SPANS_ARROW) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=[id_col, "base", "spans"])

    return map_arrow(src, run, f"`{id_col}` {src.schema['__id'].dataType.simpleString()}, base {_SPANS}, spans {_SPANS}")


def redact_text(text: str | None, found: list[Span]) -> str | None:
    """The text with each span, or run of overlapping ones, replaced by the name of its kind in brackets."""
    if not found or text is None:
        return text
    out, at = [], 0
    for kind, s, e in sorted(found, key=lambda x: (x[1], -x[2])):
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(df: DataFrame, crf: SemiCrf | None, text_col: str = "text") -> DataFrame:
    """The frame with the personal data of ``text_col`` replaced; all columns and rows stay."""
    name = text_col

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.schema.get_field_index(name)
            texts = b.column(at).to_pylist()
            yield b.set_column(at, b.schema.field(at), pa.array([redact_text(t, find(t, crf)[1]) for t in texts], b.schema.field(at).type))

    return map_arrow(df, run, df.schema)
