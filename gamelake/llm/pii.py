"""Personal data in texts (operator 12): rules, and a character BiLSTM with CRF transitions beside them.

The rules give the base spans. What they miss by their form (numbers that stand beside other numbers,
other separators, letters beyond ASCII, hidden dots) is left to the model: a bidirectional LSTM over
characters whose outputs go through a linear-chain CRF, trained in numpy on labelled windows. Labels are
the base spans of a bounded sample of the texts, and spans of known place written into its windows.

Every kind has a digit or an @ in it, so windows without either hold no span and aren't computed; that
leaves results as they are. Windows overlap by half. Each is decoded by itself; a document's candidates from
all its windows are then reconciled: pieces that a window's edge cuts are joined or give way, candidates
that fail their kind's check or touch a base span go, and of the rest the set of spans that don't overlap
and have the highest total score stays.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gamelake.llm.common import bounded_batches, fresh

KINDS = ("email", "ip", "card", "phone")
#: Characters of a window, and from one window to the next. Spans up to STRIDE lie whole in a window.
WIDTH, STRIDE = 96, 48
#: Windows computed together.
TOGETHER = 512
#: O, then B and I of each kind.
TAGS = 1 + 2 * len(KINDS)
#: Letters, one class for digits, ASCII signs, then: capital letters, other letters, other blanks, the rest, outside.
_SIGNS = "abcdefghijklmnopqrstuvwxyz0 \n!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
CAPITAL, LETTER, BLANK, OTHER, OUTSIDE = range(len(_SIGNS), len(_SIGNS) + 5)
SYMBOLS = len(_SIGNS) + 5

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_DIGITS = re.compile(r"[0-9]+(?:[ -][0-9]+)*")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    d = np.frombuffer(digits.encode("ascii"), np.uint8).astype(np.int64)[::-1] - 48
    d[1::2] *= 2
    return int((d - 9 * (d > 9)).sum()) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @ outwards: what a leftmost search finds, in time that grows with the text only."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            end = found.end()
        else:
            end = at + 1  # no match reaches over an @
        at = text.find("@", max(at + 1, end))


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    for run in _DOTTED.finditer(text):
        if run[0].count(".") >= 3:
            parts, at = run[0].split("."), run.start()
            for k in range(0, len(parts) - 3, 4):
                four = parts[k : k + 4]
                size = sum(map(len, four)) + 3
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                    yield at, at + size
                at += size + 1


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """start, kind, end of the spans that the rules find, by start, then kind."""
    found: list[tuple[int, int, int]] = []
    if "@" in text:
        found += [(a, 0, z) for a, z in _emails(text)]
    found += [(a, 1, z) for a, z in _addresses(text)]
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    return [(a, KINDS[k], z) for a, k, z in sorted(found)]


def symbols(text: str) -> np.ndarray:
    """The class of each character, and one of OUTSIDE for all beyond the text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = _ascii()[np.minimum(codes, 128)]
    wide = np.flatnonzero(codes >= 128)
    if len(wide):
        kinds, back = np.unique(codes[wide], return_inverse=True)
        out[wide] = np.array([LETTER if chr(c).isalpha() else BLANK if chr(c).isspace() else OTHER for c in kinds.tolist()], np.uint8)[back]
    return out


@lru_cache(maxsize=1)
def _ascii() -> np.ndarray:
    out = np.full(129, OTHER, np.uint8)
    for i, c in enumerate(_SIGNS):
        out[ord(c)] = i
    out[ord("A") : ord("Z") + 1] = CAPITAL
    out[ord("0") : ord("9") + 1] = _SIGNS.index("0")
    out[[ord(c) for c in "\t\r\x0b\x0c"]] = BLANK
    return out


# the network


@dataclass(frozen=True)
class Spec:
    """hidden: units a direction. max_docs texts of max_bytes in all (in the order of a hash of their ids; texts
    of over a sixteenth of it are left out) give at most ``windows`` windows to train on."""

    hidden: int = 24
    max_docs: int = 6_000
    max_bytes: int = 24_000_000
    windows: int = 3_200
    epochs: int = 7
    batch: int = 96
    rate: float = 0.012


def start_weights(spec: Spec, rng: np.random.Generator) -> dict[str, np.ndarray]:
    h = spec.hidden
    w = {}
    for side in "fb":
        w[f"x{side}"] = rng.normal(0, 0.3, (SYMBOLS, 4 * h)).astype(np.float32)  # a row for each symbol
        w[f"u{side}"] = rng.normal(0, h**-0.5, (h, 4 * h)).astype(np.float32)
        w[f"c{side}"] = np.repeat(np.array([0, 1, 0, 0], np.float32), h)  # gates: input, forget, output, new
    w["o"] = rng.normal(0, (2 * h) ** -0.5, (2 * h, TAGS)).astype(np.float32)
    w["d"] = np.array([2.0] + [0.0] * (TAGS - 1), np.float32)
    w["t"] = np.zeros((TAGS, TAGS), np.float32)
    return w


def allowed() -> np.ndarray:
    """From tag, to tag: inside a kind only after its begin or inside."""
    ok = np.ones((TAGS, TAGS), bool)
    for k in range(len(KINDS)):
        ok[:, 2 + 2 * k] = False
        ok[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = True
    return ok


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1.0)


def lstm(w: dict[str, np.ndarray], side: str, x: np.ndarray, keep: bool = False):
    """Outputs (steps, rows, hidden) of one direction for symbols x (rows, steps), in the order of the text."""
    rows, steps = x.shape
    n = w[f"u{side}"].shape[0]
    out, h, c, kept = np.empty((steps, rows, n), np.float32), np.zeros((rows, n), np.float32), np.zeros((rows, n), np.float32), []
    for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
        z = w[f"x{side}"][x[:, t]] + h @ w[f"u{side}"] + w[f"c{side}"]
        gates, new = _sigmoid(z[:, : 3 * n]), np.tanh(z[:, 3 * n :])
        before, c = c, gates[:, n : 2 * n] * c + gates[:, :n] * new
        turned = np.tanh(c)
        if keep:
            kept.append((t, h, before, gates, new, turned))
        h = gates[:, 2 * n :] * turned
        out[t] = h
    return (out, kept) if keep else out


def lstm_back(w: dict[str, np.ndarray], side: str, x: np.ndarray, kept: list, grad: np.ndarray, g: dict[str, np.ndarray]) -> None:
    """Adds the gradients of one direction to g, from those of its outputs."""
    n = w[f"u{side}"].shape[0]
    dh, dc = np.zeros_like(grad[0]), np.zeros_like(grad[0])
    seen, all_dz = [], []
    for t, h, before, gates, new, turned in reversed(kept):
        dh = dh + grad[t]
        i, f, o = gates[:, :n], gates[:, n : 2 * n], gates[:, 2 * n :]
        dc = dc + dh * o * (1 - turned * turned)
        dz = np.concatenate((dc * new * i * (1 - i), dc * before * f * (1 - f), dh * turned * o * (1 - o), dc * i * (1 - new * new)), 1)
        seen.append(x[:, t])
        all_dz.append(dz)
        g[f"u{side}"] += h.T @ dz
        g[f"c{side}"] += dz.sum(0)
        dh, dc = dz @ w[f"u{side}"].T, dc * f
    each = np.concatenate(seen)
    order = np.argsort(each, kind="stable")
    own, first = np.unique(each[order], return_index=True)
    g[f"x{side}"][own] += np.add.reduceat(np.concatenate(all_dz)[order], first, axis=0)


def emissions(w: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Tag scores (steps, rows, tags)."""
    return np.concatenate((lstm(w, "f", x), lstm(w, "b", x)), 2) @ w["o"] + w["d"]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def crf(e: np.ndarray, moves: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean negative log-likelihood of tags y (rows, steps), its gradients by emissions and by moves."""
    steps, rows, tags = e.shape
    ahead, back = np.empty_like(e), np.zeros_like(e)
    ahead[0] = e[0]
    ahead[0][:, 2::2] = -1e4  # no window begins inside a kind: cut pieces begin anew
    for t in range(1, steps):
        ahead[t] = e[t] + _log_sum(ahead[t - 1][:, :, None] + moves, 1)
    for t in range(steps - 2, -1, -1):
        back[t] = _log_sum(moves + (e[t + 1] + back[t + 1])[:, None, :], 2)
    total = _log_sum(ahead[-1], 1)
    de = np.exp(ahead + back - total[:, None])
    dm = np.zeros_like(moves)
    for t in range(1, steps):
        dm += np.exp(ahead[t - 1][:, :, None] + moves + (e[t] + back[t])[:, None, :] - total[:, None, None]).sum(0)
    r, score = np.arange(rows), np.zeros(rows)
    for t in range(steps):
        score += e[t, r, y[:, t]] + (moves[y[:, t - 1], y[:, t]] if t else 0.0)
        de[t, r, y[:, t]] -= 1
        if t:
            np.add.at(dm, (y[:, t - 1], y[:, t]), -1)
    return float((total - score).mean()), (de / rows).astype(np.float32), (dm / rows).astype(np.float32)


def loss_and_gradients(w: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    ok, n = allowed(), w["uf"].shape[0]
    (f, kept_f), (b, kept_b) = lstm(w, "f", x, True), lstm(w, "b", x, True)
    both = np.concatenate((f, b), 2)
    loss, de, dm = crf(both @ w["o"] + w["d"], np.where(ok, w["t"], -1e4), y)
    g = {k: np.zeros_like(v) for k, v in w.items()}
    g["o"], g["d"], g["t"] = np.einsum("tri,trk->ik", both, de), de.sum((0, 1)), np.where(ok, dm, 0)
    d = de @ w["o"].T
    lstm_back(w, "f", x, kept_f, np.ascontiguousarray(d[:, :, :n]), g)
    lstm_back(w, "b", x, kept_b, np.ascontiguousarray(d[:, :, n:]), g)
    return loss, g


def train(x: np.ndarray, y: np.ndarray, spec: Spec) -> dict[str, np.ndarray]:
    """Weights after Adam steps on shuffled batches of windows; the same windows give the same weights."""
    rng = np.random.default_rng(42)
    w = start_weights(spec, rng)
    first, second, step = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}, 0
    steps = spec.epochs * -(-len(x) // spec.batch)
    for _ in range(spec.epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), spec.batch):
            part = order[at : at + spec.batch]
            _, g = loss_and_gradients(w, x[part], y[part])
            size = np.sqrt(sum(float(np.square(v).sum()) for v in g.values()))
            step += 1
            rate = spec.rate * min(1.0, 2.0 * (1 - step / (steps + 1)))
            for k, v in g.items():
                v = v * min(1.0, 5.0 / max(size, 1e-9))
                first[k] = 0.9 * first[k] + 0.1 * v
                second[k] = 0.99 * second[k] + 0.01 * v * v
                w[k] = (w[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return w


def decode(w: dict[str, np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best tags (rows, steps), and how far each tag's score is above that of O."""
    e = emissions(w, x)
    moves, steps = np.where(allowed(), w["t"], -1e4).astype(np.float32), len(e)
    best, came = e[0].copy(), np.zeros(e.shape, np.int8)
    best[:, 2::2] = -1e4
    for t in range(1, steps):
        each = best[:, :, None] + moves
        came[t] = each.argmax(1)
        best = each.max(1) + e[t]
    tags, r = np.empty((e.shape[1], steps), np.int8), np.arange(e.shape[1])
    tags[:, -1] = best.argmax(1)
    for t in range(steps - 1, 0, -1):
        tags[:, t - 1] = came[t, r, tags[:, t]]
    return tags, np.take_along_axis(e, tags.T[:, :, None], 2)[:, :, 0].T - e[:, :, 0].T


# windows, labels and spans


def windows_of(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the windows that hold a digit or an @, and their symbols; beyond the text is OUTSIDE."""
    telling = np.flatnonzero((x == _SIGNS.index("0")) | (x == _SIGNS.index("@")))
    last = telling // STRIDE
    at = np.unique(np.concatenate((last, last - 1)))
    at = at[at >= 0] if len(x) else at[:0]
    starts = at * STRIDE
    wide = starts[:, None] + np.arange(WIDTH)
    return starts, np.where(wide < len(x), x[np.minimum(wide, max(0, len(x) - 1))], OUTSIDE).astype(np.uint8) if len(starts) else np.empty((0, WIDTH), np.uint8)


def tags_of(spans: list[tuple[int, str, int]], start: int) -> np.ndarray:
    """Tags of one window; a piece that the window's start cuts begins there."""
    y = np.zeros(WIDTH, np.int8)
    for a, kind, z in spans:
        a, z = max(a - start, 0), min(z - start, WIDTH)
        if a < z and not y[a:z].any():
            y[a:z] = 2 + 2 * KINDS.index(kind)
            y[a] -= 1
    return y


def _made(rng: np.random.Generator, kind: str) -> str:
    """A span in one of many forms, also such as the rules don't know."""
    pick = lambda *xs: xs[int(rng.integers(len(xs)))]
    digits = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    word = lambda a, z, more="": "".join(pick(*("abcdefghijklmnopqrstuvwxyz" + more)) for _ in range(int(rng.integers(a, z))))
    if kind == "email":
        far = pick("", "", "éüñßç")
        local = pick(word(2, 9, far), word(2, 8, far) + pick(".", "_", "-", "+") + word(2, 8, far), word(2, 7, far) + digits(2))
        host = pick(word(3, 9, far), "mail" + digits(1) + ".example", word(2, 6) + "-" + word(2, 6, far))
        return local + pick("@", "@", "@", " @ ") + host + "." + pick("com", "org", "net", "de", "fr", "es")
    if kind == "ip":
        return pick(".", ".", "[.]", "(.)", " . ").join(str(v) for v in rng.integers(0, 256, 4))
    if kind == "card":
        n = int(pick(12, 13, 14, 15, 16, 16, 16, 16, 16, 19))
        d = pick("4", "5", "3", "6") + digits(n - 2)
        d = next(d + str(c) for c in range(10) if luhn(d + str(c)))
        cut = pick("", "", " ", "-", ".", "_", "/", " ")
        return cut.join(d[k : k + 4] for k in range(0, n, 4))
    a, b, c = digits(3), digits(3), digits(4)
    return pick(f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"+{pick('44', '49', '33', '34')} {digits(2)} {digits(4)} {c}", f"{a}-{b}-{c}", f"00{pick('44', '49')} {digits(3)} {digits(7)}", f"+1/{a}/{b}/{c}", f"{a}.{b}.{c}", f"({a}){b}-{c}")


def _noise(rng: np.random.Generator) -> str:
    """Digits and signs that are no personal data."""
    pick = lambda *xs: xs[int(rng.integers(len(xs)))]
    digits = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    return pick(
        digits(int(rng.integers(1, 12))),
        f"{digits(4)}-{digits(2)}-{digits(2)}",
        f"{digits(2)}/{digits(2)}/{digits(4)} {digits(2)}:{digits(2)}:{digits(2)}",
        f"{digits(3)},{digits(3)},{digits(3)}.{digits(2)}",
        f"v{digits(1)}.{digits(2)}.{digits(1)}",
        f"{digits(1)}.{digits(int(rng.integers(3, 16)))}",
        "".join(pick(*"0123456789abcdef") for _ in range(int(rng.integers(8, 41)))),
        f"@{pick('home', 'all', 'work')}",
        f"{digits(2)} @ {digits(1)}.{digits(2)}",
        f"{digits(3)}.{digits(1)}",
        f"({digits(4)})",
        f"§ {digits(1)}.{digits(1)}.{digits(1)}",
    )


def training_windows(texts: list[str], spec: Spec) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and tags: windows of the texts with their base spans (a third at most), then windows into
    which spans or other numbers are written. Without texts, all are written into blanks."""
    rng = np.random.default_rng(7)
    xs: list[np.ndarray] = []
    ys: list[np.ndarray] = []
    for text in texts:
        if len(xs) < spec.windows // 3:
            spans = base_spans(text)
            starts, rows = windows_of(symbols(text))
            for start, row in list(zip(starts.tolist(), rows, strict=True))[:20]:
                xs.append(row)
                ys.append(tags_of(spans, start))
    plain = [t for t in texts if len(t) > 2 * WIDTH] or [" " * 4 * WIDTH]
    while len(xs) < spec.windows:
        text = plain[int(rng.integers(len(plain)))]
        at = int(rng.integers(0, len(text) - WIDTH))
        around = "".join(c for c in text[at : at + WIDTH] if c != "@" and not c.isdigit())
        body, spans, left = "", [], int(rng.integers(0, 60))
        body, around = around[:left], around[left:]
        for _ in range(int(rng.integers(1, 4))):
            if rng.random() < 0.4:
                body += _noise(rng)
            else:
                kind = KINDS[int(rng.integers(len(KINDS)))]
                made = _made(rng, kind)
                spans.append((len(body), kind, len(body) + len(made)))
                body += made
            gap = int(rng.integers(0, 14))
            body, around = body + (" " if rng.random() < 0.8 else ", ") + around[:gap] + (" " if gap and rng.random() < 0.8 else ""), around[gap:]
        x = symbols((body + around)[:WIDTH])
        xs.append(np.concatenate((x, np.full(WIDTH - len(x), OUTSIDE, np.uint8))))
        ys.append(tags_of(spans, 0))
    return np.array(xs, np.uint8), np.array(ys, np.int8)


def holds(kind: str, span: str) -> bool:
    """What a span of the model must have: the checks of the rules, without their forms."""
    digits = "".join(c for c in span if "0" <= c <= "9")
    if kind == "email":
        return re.fullmatch(r"[^\s@]+ ?@ ?[^\s@]*[^\s@.]\.[^\W\d_]{2,}", span) is not None
    if kind == "ip":
        parts = re.findall(r"[0-9]+", span)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts) and not re.search(r"[^\W\d_]", span)
    if re.search(r"[^\W\d_]|@", span):
        return False
    return 12 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 9 <= len(digits) <= 15


def candidates(starts: np.ndarray, tags: np.ndarray, gains: np.ndarray, size: int) -> list[tuple[int, str, int, float]]:
    """start, kind, end and score of a document's spans from all its windows. A piece that a window's edge
    cuts is joined with pieces of its kind that it overlaps or touches, and otherwise stays as it is."""
    whole: dict[tuple[int, str, int], float] = {}
    cut: list[tuple[str, int, int, float]] = []
    for start, y, gain in zip(starts.tolist(), tags, gains, strict=True):
        begins = np.flatnonzero((y > 0) & (y % 2 == 1))
        for a in begins.tolist():
            z = a + 1
            while z < WIDTH and y[z] == y[a] + 1:
                z += 1
            kind, score = KINDS[(y[a] - 1) // 2], float(gain[a:z].sum())
            s, e = start + a, min(start + z, size)
            if (a == 0 and start > 0) or (z == WIDTH and start + WIDTH < size):
                cut.append((kind, s, e, score))
            elif s < e:
                whole[s, kind, e] = max(score, whole.get((s, kind, e), -np.inf))
    joined: list[list] = []
    for kind, s, e, score in sorted(cut):
        if joined and joined[-1][0] == kind and s <= joined[-1][2]:
            joined[-1][2], joined[-1][3] = max(e, joined[-1][2]), joined[-1][3] + score
        else:
            joined.append([kind, s, e, score])
    for kind, s, e, score in joined:
        whole.setdefault((s, kind, e), score)
    return [(*k, v) for k, v in whole.items()]


def reconcile(text: str, base: list[tuple[int, str, int]], found: list[tuple[int, str, int, float]]) -> list[tuple[int, str, int]]:
    """The candidates, cut back and out to the ends of words, that hold, touch no base span, do not overlap and have the highest total score."""
    fit = []
    taken = sorted((a, z) for a, _, z in base)
    ends = list(np.maximum.accumulate([z for _, z in taken])) if taken else []
    for a, kind, z, score in found:
        while a < z and not (text[a].isalnum() or text[a] in "(+"):
            a += 1
        while a < z and not text[z - 1].isalnum():
            z -= 1
        # out to the ends of words and numbers; what lies in longer ones is none
        first, last = max(0, a - STRIDE), min(len(text), z + STRIDE)
        while a < z and a > first and text[a].isalnum() and text[a - 1].isalnum():
            a -= 1
        while a < z < last and text[z].isalnum():
            z += 1
        if (a and text[a : a + 1].isalnum() and text[a - 1].isalnum()) or text[z : z + 1].isalnum():
            continue
        k = bisect_right(taken, (z - 1, np.inf))  # base spans that begin before z
        if a < z and score > 0 and not (k and ends[k - 1] > a) and holds(kind, text[a:z]):
            fit.append((z, a, kind, score))
    fit.sort()
    best, last = [(0.0, -1, -1)], [f[0] for f in fit]
    for i, (_, a, _, score) in enumerate(fit):
        before = bisect_right(last, a, 0, i)
        best.append(max((best[before][0] + score, i, before), best[-1], key=lambda b: b[0]))
    out, at = [], len(fit)
    while at > 0:
        if best[at][1] == at - 1:
            z, a, kind, _ = fit[at - 1]
            out.append((a, kind, z))
            at = best[at][2]
        else:
            at -= 1
    return sorted(out)


def spans_of(texts: list[str], w: dict[str, np.ndarray] | None) -> list[list[tuple[int, str, int, bool]]]:
    """start, kind, end and whether a rule found it, for each text; windows of all texts run together."""
    base = [base_spans(t) for t in texts]
    if w is None:
        return [[(*s, True) for s in b] for b in base]
    out = []
    parts = [windows_of(symbols(t)) for t in texts]
    owner = np.repeat(np.arange(len(texts)), [len(p[0]) for p in parts])
    tags, gains = np.empty((len(owner), WIDTH), np.int8), np.empty((len(owner), WIDTH), np.float32)
    flat = np.concatenate([np.empty((0, WIDTH), np.uint8), *(p[1] for p in parts)])
    for at in range(0, len(flat), TOGETHER):
        tags[at : at + TOGETHER], gains[at : at + TOGETHER] = decode(w, flat[at : at + TOGETHER])
    edge = np.searchsorted(owner, np.arange(len(texts) + 1))
    for i, text in enumerate(texts):
        a, z = edge[i], edge[i + 1]
        found = candidates(parts[i][0], tags[a:z], gains[a:z], len(text)) if a < z else []
        more = [(*s, False) for s in reconcile(text, base[i], found)]
        out.append(sorted([(*s, True) for s in base[i]] + more, key=lambda s: (s[0], KINDS.index(s[1]))))
    return out


# on Spark


def fit(docs: DataFrame, spec: Spec = Spec(), key: str = "doc_id", text: str = "text") -> dict[str, np.ndarray]:
    """Weights trained on windows of a bounded sample of docs. Rows without an id or text take no part; of an
    id's rows the text with the smallest hash counts, once. An empty table gives a model of written
    windows only. Sizes are summed up before any text moves; one task gets the sample."""
    bounded_batches(docs.sparkSession)
    own = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).dropna().withColumns({"hash": F.xxhash64("text"), "size": F.octet_length("text")})
    first = own.groupBy("key").agg(F.min(F.struct("hash", "size")).alias("t")).select("key", "t.*", F.xxhash64("key").alias("order"))
    few = first.filter(F.col("size") <= spec.max_bytes // 16).orderBy("order", "key").limit(spec.max_docs)
    sums = F.sum("size").over(Window.partitionBy().orderBy("order", "key"))  # of max_docs rows of numbers
    few = few.withColumn("sum", sums).filter(F.col("sum") <= spec.max_bytes).select("key", "hash", "order")
    chosen = own.join(F.broadcast(few), ["key", "hash"]).groupBy("order", "key").agg(F.first("text").alias("text"))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = [t for batch in batches for t in batch.column("text").to_pylist()]
        if texts:
            yield _row(train(*training_windows(texts, spec), spec))

    def _row(w: dict[str, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"name": list(w), "shape": pa.array([list(v.shape) for v in w.values()], pa.list_(pa.int32())), "data": [v.tobytes() for v in w.values()]})

    got = chosen.repartition(1).sortWithinPartitions("order", "key").mapInArrow(learn, "name string, shape array<int>, data binary").collect()
    if not got:
        return train(*training_windows([], spec), spec)
    return {r["name"]: np.frombuffer(r["data"], np.float32).reshape(r["shape"]) for r in got}


def find(docs: DataFrame, weights: dict[str, np.ndarray] | None, text: str = "text", spans: str = "pii") -> DataFrame:
    """docs with ``pii``: array of (kind, start, end, base) for each whole text, by start, then kind; offsets are
    code points, ends exclusive; base is true for spans of the rules. Without weights there are only these.

    Null and empty texts have no spans; repeated rows are told alike; an empty table gives an empty one. All
    columns stay (``pii`` gets a name of its own if docs has one)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    sent, name = spark.sparkContext.broadcast(weights), fresh(docs, spans)[0]

    @F.pandas_udf("array<struct<kind: string, start: int, end: int, base: boolean>>")
    def told(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            found = spans_of([t or "" for t in part], sent.value)
            yield pd.Series([[{"kind": k, "start": a, "end": z, "base": b} for a, k, z, b in f] for f in found])

    return docs.withColumn(name, told(F.col(text).cast("string")))


def redact(docs: DataFrame, weights: dict[str, np.ndarray] | None, text: str = "text") -> DataFrame:
    """docs with each span of ``find`` replaced by its kind in brackets (of overlapping spans the first, and then
    what is left of the others). Null texts stay null; other odd rows as in ``find``."""
    found = find(docs, weights, text)
    name = found.columns[-1]
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc, s):
        begin = F.greatest(acc["at"], s["start"])
        shown = F.concat(acc["out"], F.substring(F.col(text), acc["at"] + 1, begin - acc["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.when(s["end"] > acc["at"], F.struct(shown.alias("out"), s["end"].alias("at"))).otherwise(acc)

    rest = lambda acc: F.concat(acc["out"], F.substring(F.col(text), acc["at"] + 1, F.length(F.col(text))))
    return found.withColumn(text, F.aggregate(name, start, step, rest)).drop(name)
