"""Personal data: fixed patterns, and a character-level bidirectional LSTM with CRF transitions, in numpy.

The patterns give the base spans. The network is trained on windows with labelled spans: those of the patterns in a bounded
sample of rows, and forms that the patterns miss, made from a seed and set into contexts of that sample. Texts are read in
overlapping windows. The emissions of all windows over a character are put together, the more central ones weighing more, and
one Viterbi search over them decides all tags of a text at once. A span must hold a digit or an @, so of the text only that
is read and searched which can bear on such spans: from each digit or @ on either side up to a character that is O for
certain, one where the emissions leave O ahead by more than transitions can make up for. What lies beyond can't change the
tags of these spans, so they are those of a search over the whole text. Spans that touch a base span are dropped, so base
spans stay as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transect.llm.common import Shipped, arrow_map, as_bytes, groups

KINDS = ("email", "ip", "card", "phone")
#: O, then B and I of each kind.
TAGS = 1 + 2 * len(KINDS)
WINDOW, STRIDE, HIDDEN = 64, 32, 16
#: How central a place in a window is.
WEIGHT = np.minimum(np.arange(WINDOW) + 1, WINDOW - np.arange(WINDOW)).astype(np.float32)
MARKS = "@.+-_%() /:,;#=&\"'\n\t[]<>|*$!?"
#: Classes of characters: padding, digits, capitals, small letters, other letters and signs, then each mark.
CLASSES = 5 + len(MARKS)
_CLASS = np.full(129, 4, np.uint8)
_CLASS[48:58], _CLASS[65:91], _CLASS[97:123] = 1, 2, 3
for _k, _c in enumerate(MARKS):
    _CLASS[ord(_c)] = 5 + _k
TRIGGERS = b"0123456789@"
DIGITS = b"0123456789"
_RIGHT = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LEFT = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    """Whether the last digit checks the others."""
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost, non-overlapping matches of local part, @, dotted name; each @ is looked at once, so long runs cost no more than their length."""
    free = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > free and text[start - 1] in _LEFT:
            start -= 1
        m = _RIGHT.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            free = at = m.end()
        else:
            at += 1


def base_spans(text: str, raw: bytes) -> list[Span]:
    """(kind, start, end) of the fixed patterns, by kind, then start; code points, end exclusive. raw: the same text in UTF-8."""
    out = [(0, a, b) for a, b in emails(text)] if b"@" in raw else []
    if len(raw.translate(None, DIGITS)) == len(raw):
        return out
    out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups())]
    out += [(2, m.start(), m.end()) for m in _CARD.finditer(text) if 13 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


def shown_spans(text: str) -> list[Span]:
    """What training shows as spans: those of the patterns, and numbers that are cards but for their check digit, which a network can't count; found_spans() asks for it."""
    base = base_spans(text, text.encode())
    return [(2, m.start(), m.end()) for m in _CARD.finditer(text) if 13 <= len(_digits(m[0])) <= 19] + base


def classes(text: str) -> np.ndarray:
    """Class of each character."""
    return _CLASS[np.minimum(np.frombuffer(text.encode("utf-32-le"), np.uint32), 128)]


def _tags(n: int, spans: list[Span]) -> np.ndarray:
    out = np.zeros(n, np.int64)
    for kind, a, b in spans:
        out[a:b] = 2 + 2 * kind
        out[a] = 1 + 2 * kind
    return out


class Tagger:
    """The network: lookup table of inputs, recurrences of both directions, output layer, CRF transitions (start in the last row)."""

    def __init__(self, seed: int = 5):
        rng, h = np.random.default_rng(seed), HIDDEN
        self.p = {
            "x": rng.normal(0, 0.2, (2, CLASSES, 4 * h)),
            "h": rng.normal(0, 0.25, (2, h, 4 * h)),
            "o": rng.normal(0, 0.25, (2 * h, TAGS)),
            "b": np.zeros(TAGS),
            "t": np.zeros((TAGS + 1, TAGS)),
        }
        self.p["x"][:, :, h : 2 * h] += 0.5  # remember at first
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _forward(self, x: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        """Emissions (window, position, tag), and what the way back needs."""
        h, (n, length) = HIDDEN, x.shape
        both = np.stack([x, x[:, ::-1]])
        state, cell = np.zeros((2, n, h), np.float32), np.zeros((2, n, h), np.float32)
        hidden, saved = np.empty((2, length, n, h), np.float32), []
        for t in range(length):
            z = np.stack([self.p["x"][0][both[0, :, t]], self.p["x"][1][both[1, :, t]]]) + state @ self.p["h"]
            gates, new = 1 / (1 + np.exp(-z[..., : 3 * h])), np.tanh(z[..., 3 * h :])
            i, f, o = gates[..., :h], gates[..., h : 2 * h], gates[..., 2 * h :]
            after = f * cell + i * new
            bent = np.tanh(after)
            if keep:
                saved.append((state, cell, i, f, o, new, bent))
            state, cell = o * bent, after
            hidden[:, t] = state
        features = np.concatenate([hidden[0], hidden[1, ::-1]], axis=2)
        return np.moveaxis(features @ self.p["o"] + self.p["b"], 0, 1), [both, features, saved]

    def _crf(self, e: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Mean loss and its gradients in emissions and transitions."""
        n, length, k = e.shape
        trans, start = self.p["t"][:k], self.p["t"][k]
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[:, 0] = e[:, 0] + start
        lse = lambda a: (m := a.max(1)) + np.log(np.exp(a - m[:, None]).sum(1))
        for t in range(1, length):
            alpha[:, t] = lse(alpha[:, t - 1, :, None] + trans) + e[:, t]
        for t in range(length - 2, -1, -1):
            beta[:, t] = lse(np.swapaxes(trans[None] + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 1, 2))
        whole = lse(alpha[:, -1])
        de = np.exp(alpha + beta - whole[:, None, None])
        dt = np.zeros_like(self.p["t"])
        dt[k] = de[:, 0].sum(0)
        for t in range(1, length):
            dt[:k] += np.exp(alpha[:, t - 1, :, None] + trans + (e[:, t] + beta[:, t])[:, None, :] - whole[:, None, None]).sum(0)
        rows = np.arange(n)
        gold = e[rows[:, None], np.arange(length), y].sum() + start[y[:, 0]].sum() + trans[y[:, :-1], y[:, 1:]].sum()
        de[rows[:, None], np.arange(length), y] -= 1
        np.subtract.at(dt, (k, y[:, 0]), 1)
        np.subtract.at(dt, (y[:, :-1], y[:, 1:]), 1)
        return float(whole.sum() - gold) / n, de / n, dt / n

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss of windows x with tags y, and its gradients."""
        h, length = HIDDEN, x.shape[1]
        e, (both, features, saved) = self._forward(x, True)
        loss, de, dt = self._crf(e, y)
        de = np.moveaxis(de, 0, 1)
        g = {"o": np.einsum("tnf,tnk->fk", features, de, optimize=True), "b": de.sum((0, 1)), "t": dt, "x": np.zeros_like(self.p["x"]), "h": np.zeros_like(self.p["h"])}
        df = de @ self.p["o"].T
        back = np.stack([df[..., :h], df[::-1, :, h:]])
        ds = dc = np.zeros(saved[0][0].shape, np.float32)
        turned = self.p["h"].swapaxes(1, 2)
        for t in range(length - 1, -1, -1):
            state, cell, i, f, o, new, bent = saved[t]
            ds = ds + back[:, t]
            dc = dc + ds * o * (1 - bent * bent)
            dz = np.concatenate([dc * new * i * (1 - i), dc * cell * f * (1 - f), ds * bent * o * (1 - o), dc * i * (1 - new * new)], axis=2)
            g["h"] += state.swapaxes(1, 2) @ dz
            for d in (0, 1):
                np.add.at(g["x"][d], both[d, :, t], dz[d])
            ds, dc = dz @ turned, dc * f
        return loss, g

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 700, batch: int = 64, rate: float = 0.02, seed: int = 5) -> list[float]:
        """Train by Adam with a falling rate; the loss of each step."""
        rng, losses = np.random.default_rng(seed), []
        m, v = ({k: np.zeros_like(p) for k, p in self.p.items()} for _ in range(2))
        for step in range(1, steps + 1):
            rows = rng.integers(0, len(x), batch)
            loss, g = self.gradients(x[rows], y[rows])
            losses.append(loss)
            size = np.sqrt(sum(float((d * d).sum()) for d in g.values()))
            for k in self.p:
                d = g[k] * min(1.0, 5.0 / max(size, 1e-9))
                m[k], v[k] = 0.9 * m[k] + 0.1 * d, 0.99 * v[k] + 0.01 * d * d
                self.p[k] -= (rate * (1 - 0.9 * step / steps) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        return losses

    def emissions(self, x: np.ndarray) -> np.ndarray:
        """Emissions (window, position, tag) of windows."""
        return self._forward(x, False)[0]

    def most_gained(self) -> float:
        """The most that the transitions to and from a tag other than O can be worth over those to and from O, between any two tags."""
        t = self.p["t"][:TAGS].astype(float)
        return float(((t[:, 1:, None] + t[None, 1:, :]) - (t[:, :1, None] + t[None, :1, :])).max())

    def best_tags(self, e: np.ndarray, block: int = 64) -> np.ndarray:
        """The best tags of one sequence of emissions that begins and ends with O, by Viterbi.

        Blocks are searched side by side from every tag that may stand before them; then their ends are chained, and each
        block is searched once more from the tag that it got. So a long sequence costs few steps and little memory.
        """
        k, trans = TAGS, self.p["t"][:TAGS]
        n = -(-len(e) // block)
        padded = np.full((n * block, k), -np.inf, np.float32)
        padded[: len(e)] = e
        padded[len(e) :, 0] = 0
        padded[[0, len(e) - 1], 1:] = -np.inf
        each = padded.reshape(n, block, k)
        through = trans[None] + each[:, 0, None]  # (block, tag before it, last tag)
        for t in range(1, block):
            through = (through[:, :, :, None] + trans).max(2) + each[:, t, None]
        score, came = np.zeros(k, np.float32), np.empty((n, k), np.int8)
        score[1:] = -np.inf
        for j in range(n):
            ways = score[:, None] + through[j]
            came[j], score = ways.argmax(0), ways.max(0)
            score = score - score.max()
        last, before = np.empty(n, np.int64), np.empty(n, np.int64)
        tag = 0
        for j in range(n - 1, -1, -1):
            last[j], before[j] = tag, came[j, tag]
            tag = int(came[j, tag])
        score, back = trans[before] + each[:, 0], np.empty((block, n, k), np.int8)
        for t in range(1, block):
            ways = score[:, :, None] + trans
            back[t], score = ways.argmax(1), ways.max(1) + each[:, t]
        out = np.empty((n, block), np.int8)
        out[:, -1] = last
        for t in range(block - 1, 0, -1):
            out[:, t - 1] = back[t, np.arange(n), out[:, t]]
        return out.reshape(-1)[: len(e)]


def _made(rng: np.random.Generator) -> tuple[int | None, str]:
    """A made-up item of personal data and its kind, or something that only looks like it and no kind."""
    d = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    w = lambda: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(2, 9)))
    pick = int(rng.integers(0, 22))
    if pick < 3:
        return 0, f"{w()}{rng.choice(['', '.', '_', '-', '+'])}{w()}{d(int(rng.integers(0, 3)))}@{w()}.{rng.choice(['com', 'org', 'net', 'co.uk', 'example.com'])}"
    if pick < 6:
        return 1, ".".join(str(int(x)) for x in rng.integers(0, 256, 4))
    if pick < 10:
        sep = str(rng.choice(["", "", " ", "-"]))
        return 2, sep.join((str(rng.choice(list("3456"))) + d(3), d(4), d(4), d(4)))
    if pick < 16:
        forms = (f"+{d(1)} ({d(3)}) {d(3)}-{d(4)}", f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"{d(3)}.{d(3)}.{d(4)}", f"+{d(2)} {d(2)} {d(4)} {d(4)}", f"00{d(2)} {d(3)} {d(6)}")
        return 3, str(forms[int(rng.integers(0, len(forms)))])
    forms = (f"{d(4)}", f"{d(2)}:{d(2)}", f"v{d(1)}.{d(1)}.{d(2)}", f"{d(2)}.{d(3)},{d(2)}", f"{d(4)}-{d(2)}-{d(2)}", f"${d(3)}.{d(2)}", f"@{w()}", f"{d(2)}%", f"{sha256(d(3).encode()).hexdigest()[: int(rng.integers(12, 41))]}", f"{w()}{d(3)}", f"({d(4)})")
    return None, str(forms[int(rng.integers(0, len(forms)))])


def training_windows(texts: list[str], made: int = 1600, most: int = 2400, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Windows and tags: `most` of those around digits and @s of texts, drawn evenly from all there are, and `made` with made-up items in contexts of texts."""
    rng = np.random.default_rng(seed)
    x, y = [], []

    def add(c: np.ndarray, tags: np.ndarray, at: int) -> None:
        c, tags = c[at : at + WINDOW], tags[at : at + WINDOW]
        x.append(np.pad(c, (0, WINDOW - len(c))))
        y.append(np.pad(tags, (0, WINDOW - len(tags))))

    coded = [(c, _tags(len(text), shown_spans(text))) for text in texts if ((c := classes(text)) == 1).any() or (c == 5).any()]
    blocks = [(k, int(p)) for k, (c, _) in enumerate(coded) for p in np.unique(np.flatnonzero((c == 1) | (c == 5)) // STRIDE)]
    for k in sorted(rng.permutation(len(blocks))[:most].tolist()):
        add(*coded[blocks[k][0]], max(0, blocks[k][1] * STRIDE - int(rng.integers(0, STRIDE))))
    long = [t for t in texts if len(t) > 40] or ["abc def ghijk lmno pqrst uvwxyz the end of it. " * 6]
    for _ in range(made):
        t = long[int(rng.integers(0, len(long)))]
        at = int(rng.integers(0, max(1, len(t) - WINDOW)))
        context = re.sub("[0-9@+]", "a", t[at : at + WINDOW])
        cut = int(rng.integers(0, len(context) + 1))
        kind, item = _made(rng)
        text = f"{context[:cut]} {item}{rng.choice(['', '', '.', ','])} {context[cut:]}"
        spans = [] if kind is None else [(kind, cut + 1, cut + 1 + len(item))]
        add(classes(text), _tags(len(text), spans), int(rng.integers(0, max(1, min(cut + 1, len(text) - WINDOW)))))
    return np.array(x, np.uint8), np.array(y, np.int64)


def _plausible(kind: int, text: str) -> bool:
    n = len(_digits(text))
    return ("@" in text[1:-1], text.count(".") == 3 and n >= 4, 13 <= n <= 19 and luhn(_digits(text)), 7 <= n <= 15)[kind]


def found_spans(text: str, tags: np.ndarray, base: list[Span]) -> list[Span]:
    """Spans of a tagged text that look like their kind and touch no base span and no earlier one."""
    out: list[Span] = []
    taken = np.zeros(len(text) + 1, bool)
    for _, a, b in base:
        taken[a:b] = True
    kinds = (tags.astype(np.int64) - 1) // 2
    inside = np.flatnonzero(tags > 0)
    if not len(inside):
        return out
    new = np.append(True, (np.diff(inside) > 1) | (kinds[inside[1:]] != kinds[inside[:-1]]) | (tags[inside[1:]] % 2 == 1))
    starts = inside[new]
    ends = np.append(inside[np.flatnonzero(new)[1:] - 1], inside[-1]) + 1
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        part = text[a:b]
        a, b = a + len(part) - len(part.lstrip()), b - (len(part) - len(part.rstrip()))
        if a < b and not taken[a:b].any() and _plausible(int(kinds[a]), text[a:b]):
            out.append((int(kinds[a]), a, b))
            taken[a:b] = True
    return out


def _runs(strides: np.ndarray) -> list[tuple[int, int]]:
    """First and last of each run of consecutive numbers."""
    cuts = np.flatnonzero(np.diff(strides) > 1)
    return list(zip(strides[np.append(0, cuts + 1)].tolist(), strides[np.append(cuts, len(strides) - 1)].tolist(), strict=True)) if len(strides) else []


class Reading:
    """One text on its way to its tags: the strides that are read, and in how long steps they are widened."""

    def __init__(self, text: str):
        self.c = classes(text)
        self.marks = np.flatnonzero((self.c == 1) | (self.c == 5))
        self.last = max(0, -(-len(self.c) // STRIDE) - 1)
        at = np.unique(self.marks // STRIDE)
        self.strides, self.step = self._within(np.concatenate([at - 1, at, at + 1])), 1

    def _within(self, strides: np.ndarray) -> np.ndarray:
        return np.unique(strides[(strides >= 0) & (strides <= self.last)])

    def windows(self) -> np.ndarray:
        """The windows over the strides, by the stride at which each begins."""
        both = np.unique(np.concatenate([self.strides - 1, self.strides]))
        return both[both >= 0]

    def merged(self, e: np.ndarray) -> np.ndarray:
        """Emissions of the strides one after the other (the last may be short), from those of the windows: of two over a character the more central one weighs more."""
        where, n = np.searchsorted(self.windows(), self.strides), len(self.strides)
        out, weight = e[where, :STRIDE] * WEIGHT[:STRIDE, None], np.tile(WEIGHT[:STRIDE], (n, 1))
        two = self.strides > 0
        out[two] += e[where[two] - 1, STRIDE:] * WEIGHT[STRIDE:, None]
        weight[two] += WEIGHT[STRIDE:]
        return (out / weight[:, :, None]).reshape(-1, TAGS)[: n * STRIDE - (((self.last + 1) * STRIDE - len(self.c)) if n and self.strides[-1] == self.last else 0)]

    def parts(self, e: np.ndarray, sure: float) -> list[tuple[int, int, np.ndarray]] | None:
        """(start, end, emissions) of the parts of the text that decide the tags of spans with a mark, each from a character that is O for certain, or the text's begin, to the next such; None if some part's end isn't known yet: then the strides are wider.

        Emissions for O that exceed all others by more than `sure`, the most that transitions can make up for, settle a tag
        whatever the rest of the text is.
        """
        certain = e[:, 0] - e[:, 1:].max(1) > sure
        out, wider, at = [], [], 0
        for first, last in _runs(self.strides):
            start, end = first * STRIDE, min((last + 1) * STRIDE, len(self.c))
            held = self.marks[np.searchsorted(self.marks, start) : np.searchsorted(self.marks, end)]
            here = np.flatnonzero(certain[at : at + end - start]) + start
            before, after = np.searchsorted(here, held[0]), np.searchsorted(here, held[-1])
            if before == 0 and start > 0:
                wider.append(np.arange(first - self.step, first))
            if after == len(here) and end < len(self.c):
                wider.append(np.arange(last + 1, last + 1 + self.step))
            low = int(here[before - 1]) if before else start
            high = int(here[after]) + 1 if after < len(here) else end
            part = e[at + low - start : at + high - start].copy()
            if before:
                part[0, 1:] = -np.inf
            if after < len(here):
                part[-1, 1:] = -np.inf
            out.append((low, high, part))
            at += end - start
        if wider:
            self.strides, self.step = self._within(np.concatenate([self.strides, *wider])), 2 * self.step
            return None
        return out


def tag_texts(tagger: Tagger, texts: list[str], batch: int = 2048) -> list[np.ndarray]:
    """Tags of each text as one Viterbi search over the emissions of all its windows gives them, wherever a run of tags other than O holds a digit or an @; all other runs, of which none can be a span, may be O.

    Windows around digits and @s are read first, then as many beside them as it takes to find O for certain on both sides.
    """
    sure = tagger.most_gained() + 1e-3
    readings = [Reading(t) for t in texts]
    out = [np.zeros(len(r.c), np.int8) for r in readings]
    gap = np.full((1, TAGS), -np.inf, np.float32)
    gap[0, 0] = 0

    def run(some: list[int]) -> list[int]:
        """Tag these texts; those that have to be read wider."""
        each = [readings[k].windows() for k in some]
        x = np.zeros((sum(map(len, each)), WINDOW), np.uint8)
        at = 0
        for k, windows in zip(some, each, strict=True):
            for s in windows.tolist():
                part = readings[k].c[s * STRIDE : s * STRIDE + WINDOW]
                x[at, : len(part)] = part
                at += 1
        e = np.concatenate([tagger.emissions(x[i : i + batch]) for i in range(0, len(x), batch)])
        again, rows, places, at = [], [], [], 0
        for k, windows in zip(some, each, strict=True):
            r = readings[k]
            parts = r.parts(r.merged(e[at : at + len(windows)]), sure)
            at += len(windows)
            if parts is None:
                again.append(k)
                continue
            for low, high, part in parts:
                rows += (gap, part)
                places.append((k, low, high))
        if rows:
            tags, done = tagger.best_tags(np.concatenate([*rows, gap])), 0
            for k, low, high in places:
                out[k][low:high] = tags[done + 1 : done + 1 + high - low]
                done += 1 + high - low
        return again

    waiting = [k for k, r in enumerate(readings) if len(r.marks)]
    while waiting:
        later, some, size = [], [], 0
        for k in waiting:
            some.append(k)
            size += len(readings[k].strides) + 1
            if size >= batch:
                later += run(some)
                some, size = [], 0
        if some:
            later += run(some)
        waiting = later
    return out


def training_rows(docs: DataFrame, id_col: str, text_col: str, sample: int, longest: int) -> list[str]:
    """At most 2 * sample texts of at most `longest` characters: those with the least hash of id and text, and those among the ones with a digit or @. Two scans: both kinds are counted, then only what can be among the least is sent."""
    few = docs.filter(F.length(text_col) <= longest).select(F.col(text_col).alias("text"), F.xxhash64(id_col, text_col).alias("h"), F.col(text_col).rlike("[0-9@]").alias("able"))
    n = few.agg(F.count("*"), F.count_if("able")).first()
    # But for a chance below one in a billion these have `sample` rows each, if the table has.
    least = [int(-(2**63) + 2**64 * min(1.0, 4 * sample / total)) - 1 if total else -(2**63) for total in n]
    rows = few.filter((F.col("h") <= least[0]) | (F.col("able") & (F.col("h") <= least[1]))).collect()
    rows.sort(key=lambda r: (r.h, r.text))
    return [r.text for r in rows if r.able][:sample] + [r.text for r in rows if r.h <= least[0]][:sample]


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = 300, longest: int = 20_000, seed: int = 5) -> Tagger:
    """Tagger from the training_rows() of docs. Without any it learns from made-up items alone."""
    tagger = Tagger(seed)
    tagger.fit(*training_windows(training_rows(docs, id_col, text_col, sample, longest), seed=seed), seed=seed)
    return tagger


def detected(docs: DataFrame, tagger: Tagger, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, spans array<struct<kind int, start, end, base boolean>>), one row for each row of docs, by kind, then start.

    A null text is empty and has no spans. Repeated rows and null ids keep their row; an empty table gives an empty one.
    Other columns aren't read.
    """
    shared = Shipped(docs.sparkSession, tagger)
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = as_bytes(b.column(1))
            out: list[list[dict]] = [[] for _ in raw]
            for i, j in groups(raw):
                able = [k for k in range(i, j) if raw[k] and len(raw[k].translate(None, TRIGGERS)) < len(raw[k])]
                texts = [raw[k].decode() for k in able]
                for k, text, tags in zip(able, texts, tag_texts(shared.value, texts), strict=True):
                    base = base_spans(text, raw[k])
                    every = [(*s, True) for s in base] + [(*s, False) for s in found_spans(text, tags, base)]
                    out[k] = [dict(zip(("kind", "start", "end", "base"), s, strict=True)) for s in sorted(every)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, kind)], names=["id", "spans"])

    few = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return arrow_map(few, work, f"id {few.schema[0].dataType.simpleString()}, spans array<struct<kind:int,start:int,end:int,base:boolean>>").withColumnRenamed("id", id_col)
