"""Personal data: fixed rules, and a character-level bidirectional LSTM with a CRF that adds what the rules miss.

The rules give the base spans, which always stay. The model is trained in numpy on the driver from labelled spans: windows
around base spans of a bounded sample of documents, and variants of such spans in the sample's text that the rules do not
match (spaces around an at sign, "(at)", "[.]", numbers without a plus sign, other separators), next to numbers that are no
personal data. At work it reads every run of digits and marks and every address, written or spelt out, that could pass the check
of an added span, from end to end whatever its length, with ``MARGIN`` characters of context; no span that passes can lie elsewhere.
Regions are cut into overlapping windows, each is decoded by Viterbi, and each character takes its tag from the window in
which it is most central. A span of the model counts if it is apart from base spans and its digits or its address hold up.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import columns, free_name, hash_sample, map_texts, quoted

KINDS = ["email", "ip", "card", "phone"]
SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"
#: Documents that give training text, windows made from them, and the seed of their making.
SAMPLE_DOCS, TRAIN_WINDOWS, SEED = 600, 1600, 5
#: Fewer digits are no card or telephone number.
LEAST_DIGITS = 9
WIDTH, STRIDE, MARGIN, HIDDEN, EPOCHS, BATCH, RATE = 64, 32, 24, 20, 9, 64, 0.02
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a run of digits matches as a whole or not at all, so starts inside a run need no try
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# what an added span can be made of: an at sign, written or spelt out, between parts joined by dots, written or spelt out; or digits and marks
_AT = re.compile(r"[@aA](?:(?<=@)|(?<=[\s(\[{][aA])[tT](?=[\s)\]}]))")
_DOT = r"(?:[(\[{]\s*+(?:[dD][oO][tT]|\.)\s*+[)\]}]|\.|(?<=\s)[dD][oO][tT](?=\s))"
_TOD = r"(?:[)\]}]\s*+(?:[tT][oO][dD]|\.)\s*+[(\[{]|\.|[tT][oO][dD](?=\s))"  # in reversed text
_AFTER = re.compile(rf"\s*+[)\]}}]?+\s*+[A-Za-z0-9-]++(?:\s*+{_DOT}\s*+[A-Za-z0-9-]++)++")
_BEFORE = re.compile(rf"\s*+[(\[{{]?+(?:\s*+{_TOD})*+\s*+[A-Za-z0-9_%+-]*+(?:(?:\s*+{_TOD})++\s*+[A-Za-z0-9_%+-]*+)*+\s*+")
_NUMBERS = re.compile(r"[0-9]++(?:(?:[().\-/\s\[\]{}]|[dD][oO][tT])++[0-9]++)*+")
# the same parts without white space around a plain dot, which may end a sentence
_NAME = re.compile(r"\s*+[)\]}]?+\s*+[A-Za-z0-9-]++(?:(?:\.|\s*+[(\[{]\s*+(?:[dD][oO][tT]|\.)\s*+[)\]}]\s*+|\s++[dD][oO][tT]\s++)[A-Za-z0-9-]++)*+")
_LOCAL_PART = re.compile(r"\s*+[(\[{]?+\s*+[A-Za-z0-9._%+-]++(?:(?:\s*+[)\]}]\s*+(?:[tT][oO][dD]|\.)\s*+[(\[{]\s*+|\s++[tT][oO][dD]\s++)[A-Za-z0-9._%+-]++)*+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def ip_holds(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in text.split("."))


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, end, kind) by start, then kind: leftmost non-overlapping matches of each kind that pass its check."""
    if not text:
        return []
    out = []
    at, free = text.find("@"), 0
    while at >= 0:
        m, start = _DOMAIN.match(text, at), at
        if m:
            while start > free and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                out.append((start, m.end(), 0))
                free = m.end()
        at = text.find("@", at + 1)
    out += [(m.start(), m.end(), 1) for m in _IP.finditer(text) if ip_holds(m.group())]
    out += [(m.start(), m.end(), 2) for m in _CARD.finditer(text) if 12 <= len(d := digits_of(m.group())) <= 19 and luhn(d)]
    if "+" in text:
        out += [(m.start(), m.end(), 3) for m in _PHONE.finditer(text) if 9 <= len(digits_of(m.group())) <= 15]
    return sorted(out, key=lambda s: (s[0], s[2]))


# ---- model

LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
MARKS = " \n.,-_+@()[]{}%:/;\"'#=&"
ALPHABET = {c: i + 4 for i, c in enumerate(LETTERS + MARKS)} | {c: 3 for c in "0123456789"}  # 0 padding, 1 other, 2 other letter
SIZE = 4 + len(LETTERS) + len(MARKS)
TAGS = 1 + 2 * len(KINDS)  # 0 outside, 1 + 2k begins kind k, 2 + 2k goes on with it
FORBIDDEN = np.array([[b > 0 and b % 2 == 0 and a not in (b - 1, b) for b in range(TAGS)] for a in range(TAGS)])


def encode(text: str) -> np.ndarray:
    return np.array([ALPHABET.get(c) or (2 if c.isalpha() else 1) for c in text], dtype=np.int64)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def new_model(rng: np.random.Generator) -> dict[str, np.ndarray]:
    h = HIDDEN
    p = {}
    for d in "fb":
        p["x" + d] = rng.normal(0, 0.3, (SIZE, 4 * h)).astype(np.float32)
        p["x" + d][:, h:2 * h] += 1.0  # remember at first
        p["h" + d] = rng.normal(0, 1 / np.sqrt(h), (h, 4 * h)).astype(np.float32)
    p["o"] = rng.normal(0, 0.2, (2 * h, TAGS)).astype(np.float32)
    p["c"] = np.zeros(TAGS, dtype=np.float32)
    p["t"] = np.zeros((TAGS, TAGS), dtype=np.float32)
    return p


def lstm(ids: np.ndarray, x: np.ndarray, wh: np.ndarray, trace: list | None = None) -> np.ndarray:
    """Hidden states (time, batch, hidden) of one direction; ids are (time, batch)."""
    steps, batch = ids.shape
    n = wh.shape[0]
    h, c = np.zeros((batch, n), np.float32), np.zeros((batch, n), np.float32)
    out = np.empty((steps, batch, n), np.float32)
    for s in range(steps):
        z = x[ids[s]] + h @ wh
        gates, g = sigmoid(z[:, :3 * n]), np.tanh(z[:, 3 * n:])
        i, f, o = gates[:, :n], gates[:, n:2 * n], gates[:, 2 * n:]
        before, c = c, f * c + i * g
        tc = np.tanh(c)
        if trace is not None:
            trace.append((h, before, i, f, o, g, tc))
        h = o * tc
        out[s] = h
    return out


def lstm_back(ids: np.ndarray, wh: np.ndarray, trace: list, grad: np.ndarray, shape: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the input table and the recurrent weights."""
    gx, gh = np.zeros(shape, np.float32), np.zeros_like(wh)
    dh_next, dc_next = np.zeros_like(grad[0]), np.zeros_like(grad[0])
    for s in range(len(trace) - 1, -1, -1):
        h, before, i, f, o, g, tc = trace[s]
        dh = grad[s] + dh_next
        dc = dc_next + dh * o * (1 - tc * tc)
        dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
        np.add.at(gx, ids[s], dz)
        gh += h.T @ dz
        dh_next, dc_next = dz @ wh.T, dc * f
    return gx, gh


def emissions(p: dict, ids: np.ndarray, traces: tuple | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Tag scores and the joined states, (time, batch, .), of windows (batch, time)."""
    fwd = ids.T
    a = lstm(fwd, p["xf"], p["hf"], traces and traces[0])
    b = lstm(fwd[::-1], p["xb"], p["hb"], traces and traces[1])[::-1]
    states = np.concatenate([a, b], axis=2)
    return states @ p["o"] + p["c"], states


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis=axis, keepdims=True))).squeeze(axis)


def crf_gradient(e: np.ndarray, t: np.ndarray, tags: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss (negative log likelihood a window) and its gradients for the scores and the transitions."""
    steps, batch, k = e.shape
    trans = np.where(FORBIDDEN, -1e4, t)
    alpha, beta = np.empty_like(e), np.zeros_like(e)
    begin = np.where((np.arange(k) > 0) & (np.arange(k) % 2 == 0), -1e4, 0)  # a window may cut a span; training windows do not
    alpha[0] = e[0] + begin
    for s in range(1, steps):
        alpha[s] = e[s] + log_sum(alpha[s - 1][:, :, None] + trans, 1)
    for s in range(steps - 2, -1, -1):
        beta[s] = log_sum(trans + (e[s + 1] + beta[s + 1])[:, None, :], 2)
    z = log_sum(alpha[-1], 1)
    unary = np.exp(alpha + beta - z[None, :, None])
    ge, gt = unary.copy(), np.zeros((k, k))
    rows = np.arange(batch)
    loss = z.sum() - e[0, rows, tags[0]].sum()
    ge[0, rows, tags[0]] -= 1
    for s in range(1, steps):
        pair = np.exp(alpha[s - 1][:, :, None] + trans + (e[s] + beta[s])[:, None, :] - z[:, None, None])
        gt += pair.sum(axis=0)
        np.add.at(gt, (tags[s - 1], tags[s]), -1)
        ge[s, rows, tags[s]] -= 1
        loss -= e[s, rows, tags[s]].sum() + t[tags[s - 1], tags[s]].sum()
    return loss / batch, (ge / batch).astype(np.float32), (np.where(FORBIDDEN, 0, gt) / batch).astype(np.float32)


def train(windows: list[tuple[str, list[tuple[int, int, int]]]], seed: int = SEED) -> dict[str, np.ndarray]:
    """Fit by Adam; windows are (text of WIDTH characters, spans)."""
    rng = np.random.default_rng(seed)
    p = new_model(rng)
    ids, tags = np.zeros((len(windows), WIDTH), np.int64), np.zeros((len(windows), WIDTH), np.int64)
    for r, (text, spans) in enumerate(windows):
        ids[r, :len(text)] = encode(text)
        for a, b, k in spans:
            tags[r, a:b] = 2 + 2 * k
            tags[r, a] = 1 + 2 * k
    m, v, step = {n: np.zeros_like(w) for n, w in p.items()}, {n: np.zeros_like(w) for n, w in p.items()}, 0
    total = EPOCHS * -(-len(windows) // BATCH)
    for _ in range(EPOCHS):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), BATCH):
            rows = order[at:at + BATCH]
            traces: tuple = ([], [])
            e, states = emissions(p, ids[rows], traces)
            _, ge, gt = crf_gradient(e.astype(np.float64), p["t"].astype(np.float64), tags[rows].T)
            gs = ge @ p["o"].T
            fwd = ids[rows].T
            g = {"o": np.einsum("tbh,tbk->hk", states, ge), "c": ge.sum(axis=(0, 1)), "t": gt}
            g["xf"], g["hf"] = lstm_back(fwd, p["hf"], traces[0], gs[:, :, :HIDDEN], p["xf"].shape)
            g["xb"], g["hb"] = lstm_back(fwd[::-1], p["hb"], traces[1], gs[::-1, :, HIDDEN:], p["xb"].shape)
            step += 1
            rate = RATE * (1 - step / (total + 1))
            norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
            for n in p:
                x = g[n] * min(1.0, 5.0 / (norm + 1e-9))
                m[n] = 0.9 * m[n] + 0.1 * x
                v[n] = 0.99 * v[n] + 0.01 * x * x
                p[n] -= (rate * (m[n] / (1 - 0.9 ** step)) / (np.sqrt(v[n] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return p


def viterbi(e: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Best tags (time, batch); a window may begin inside a span."""
    steps, batch, k = e.shape
    trans = np.where(FORBIDDEN, -1e4, t).astype(np.float32)
    score, back = e[0], np.zeros((steps, batch, k), np.int8)
    for s in range(1, steps):
        options = score[:, :, None] + trans
        back[s] = options.argmax(axis=1)
        score = options.max(axis=1) + e[s]
    tags = np.zeros((steps, batch), np.int64)
    tags[-1] = score.argmax(axis=1)
    for s in range(steps - 1, 0, -1):
        tags[s - 1] = back[s, np.arange(batch), tags[s]]
    return tags


def regions(text: str) -> list[tuple[int, int]]:
    """Disjoint spans of text, with a margin, that hold every span that ``holds`` can accept.

    An address needs an at sign with a dotted name behind it, four numbers need nine digits or three dots, the others nine digits.
    """
    found, turned = [], None
    for m in _NUMBERS.finditer(text):
        run = m.group()
        digits = len(digits_of(run))
        if digits >= LEAST_DIGITS or digits >= 4 and run.count(".") + run.lower().count("dot") >= 3:
            a = m.start()
            while a > 0 and text[a - 1] in " ().-/":
                a -= 1
            found.append((a, m.end()))
    for m in _AT.finditer(text):
        if after := _AFTER.match(text, m.end()):
            turned = text[::-1] if turned is None else turned
            found.append((len(text) - _BEFORE.match(turned, len(text) - m.start()).end(), after.end()))
    out: list[list[int]] = []
    for a, b in sorted(found):
        a, b = max(0, a - MARGIN), min(len(text), b + MARGIN)
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def model_spans(texts: list[str], p: dict) -> list[list[tuple[int, int, int]]]:
    """Spans that the model sees in each text, before any check."""
    cuts = []  # text, window start, region end, is first, is last
    for i, text in enumerate(texts):
        for a, b in regions(text) if text else ():
            starts = [a] if b - a <= WIDTH else [*range(a, b - WIDTH, STRIDE), b - WIDTH]
            cuts += [(i, s, min(s + WIDTH, b), j == 0, j + 1 == len(starts)) for j, s in enumerate(starts)]
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    tags_of: dict[int, dict[int, int]] = {}
    for at in range(0, len(cuts), 2048):
        part = cuts[at:at + 2048]
        ids = np.zeros((len(part), WIDTH), np.int64)
        for r, (i, s, e, _, _) in enumerate(part):
            ids[r, :e - s] = encode(texts[i][s:e])
        tags = viterbi(emissions(p, ids)[0], p["t"])
        for r, (i, s, e, first, last) in enumerate(part):
            # a window speaks for its middle, and for the ends of its region
            lo = s if first else s + (WIDTH - STRIDE) // 2
            hi = e if last else e - (WIDTH - STRIDE) // 2
            own = tags_of.setdefault(i, {})
            column = tags[:, r]
            for x in np.flatnonzero(column[:e - s]).tolist():
                if lo <= s + x < hi:
                    own.setdefault(s + x, int(column[x]))
    for i, own in tags_of.items():
        run = None
        for x in sorted(own):
            kind, begins = (own[x] - 1) // 2, own[x] % 2 == 1
            if run and run[1] == x and run[2] == kind and not begins:
                run[1] = x + 1
            else:
                if run:
                    out[i].append(tuple(run))
                run = [x, x + 1, kind]
        if run:
            out[i].append(tuple(run))
    return out


def plain(text: str, kind: int) -> str:
    """A span's text without what is written to hide it."""
    if kind <= 1:
        text = re.sub(r"\s{2,}", " ", text)
        text = re.sub(r"\s*[(\[{]\s?at\s?[)\]}]\s*|\s+at\s+", "@", text, flags=re.I)
        text = re.sub(r"\s*[(\[{]\s?(?:dot|\.)\s?[)\]}]\s*|\s+dot\s+", ".", text, flags=re.I)
        return re.sub(r"\s*([@.])\s*", r"\1", text)
    return digits_of(text)


def holds(text: str, kind: int) -> bool:
    """Whether a span of the model is what it claims to be."""
    t = plain(text, kind)
    if kind == 0:
        return base_spans(t) != [] and base_spans(t)[0][:2] == (0, len(t))
    if kind == 1:
        return re.fullmatch(r"[0-9]+(?:\.[0-9]+){3}", t) is not None and ip_holds(t)
    if kind == 2:
        return 12 <= len(t) <= 19 and luhn(t) and re.fullmatch(r"[0-9]+(?:[ .\-/]{1,3}[0-9]+)*", text) is not None
    return LEAST_DIGITS <= len(t) <= 15 and re.fullmatch(r"(?:00|\()[0-9 ().\-/]+[0-9]", text) is not None and len(re.findall(r"[0-9]+", text)) >= 3


def addresses(text: str, turned: str, a: int, b: int) -> list[tuple[int, int]]:
    """Whole addresses around the at signs in a span: windows and the model may end inside a long one."""
    out = []
    for m in _AT.finditer(text, a, min(len(text), b + 1)):
        left, right = _LOCAL_PART.match(turned, len(text) - m.start()), _NAME.match(text, m.end())
        if m.start() < b and left and right:
            out.append((len(text) - left.end(), right.end()))
    return out


def all_spans(texts: list[str | None], p: dict | None) -> list[list[tuple[int, int, int, bool]]]:
    """(start, end, kind, base) of each text, by start, then kind."""
    out = []
    base = [base_spans(t) for t in texts]
    added = model_spans([t or "" for t in texts], p) if p else [[] for _ in texts]
    for text, own, more in zip(texts, base, added):
        spans = [(*s, True) for s in own]
        turned = text[::-1] if any(k == 0 for _, _, k in more) else ""
        for a, b, k in more:
            for x, y in (addresses(text, turned, a, b) if k == 0 else []) + [(a, b)]:
                if all(y <= s[0] or s[1] <= x for s in spans) and holds(text[x:y], k):
                    spans.append((x, y, k, False))
        out.append(sorted(spans, key=lambda s: (s[0], s[2])))
    return out


# ---- training windows

def made_span(rng: np.random.Generator, kind: int, hidden: bool) -> str:
    """A span of a kind; hidden ones are written as the rules do not match them."""
    word = lambda n: "".join(rng.choice(list(LETTERS[:26]), n))
    number = lambda n: "".join(rng.choice(list("0123456789"), n))
    pick = lambda *x: x[rng.integers(len(x))]
    if kind == 0:
        name, parts = word(rng.integers(2, 8)) + pick("", ".", "_") + pick(number(2), word(3)), [word(rng.integers(3, 9)), pick("com", "org", "net", "example.com")]
        if not hidden:
            return name + "@" + ".".join(parts)
        at, dot = pick(" @ ", "(at)", " [at] ", " at ", "@ "), pick(".", " dot ", "[.]", "(dot)")
        return name + at + (dot if "a" in at or dot != "." else ".").join(parts) if at.strip() != "at" else name + at + " dot ".join(parts)
    if kind == 1:
        parts = [str(rng.integers(1, 256)) for _ in range(4)]
        return (pick("[.]", " . ", "(.)", " .") if hidden else ".").join(parts)
    if kind == 2:
        digits = number(15)
        digits += next(c for c in "0123456789" if luhn(digits + c))
        return pick(".", "  ", " - ", "/").join(digits[i:i + 4] for i in range(0, 16, 4)) if hidden else pick("", " ", "-").join(digits[i:i + 4] for i in range(0, 16, 4))
    if hidden:
        return pick(f"({number(3)}) {number(3)}-{number(4)}", f"00{number(2)} {number(3)} {number(4)} {number(2)}", f"({number(3)}) {number(3)} {number(4)}")
    return pick(f"+1 ({number(3)}) {number(3)}-{number(4)}", f"+{number(2)} {number(3)} {number(6)}", f"+{number(2)}-{number(3)}-{number(3)}-{number(4)}")


def made_other(rng: np.random.Generator) -> str:
    """A number that is no personal data."""
    number = lambda n: "".join(rng.choice(list("0123456789"), n))
    return [number(rng.integers(1, 12)), f"{number(4)}-{number(2)}-{number(2)}", f"{number(1)}.{number(1)}", f"{number(2)}:{number(2)}", number(2) + "%",
            "".join(rng.choice(list("0123456789abcdef"), 24)), f"v{number(1)}.{number(1)}.{number(2)}", f"{number(3)},{number(3)}.{number(2)}"][rng.integers(8)]


def training_windows(texts: list[str], seed: int = SEED, count: int = TRAIN_WINDOWS) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Windows of sampled texts: base spans as they stand, and made spans and numbers put between words."""
    rng = np.random.default_rng(seed)
    texts = [t for t in texts if t] or ["the words of a text without anything private in them and so on"]
    out = []
    for t in texts:
        for a, b, k in base_spans(t)[:4]:
            if b - a < WIDTH - 8:
                start = max(0, min(a - int(rng.integers(4, WIDTH - (b - a) - 3)), len(t)))
                spans = [(x - start, y - start, q) for x, y, q in base_spans(t) if start <= x and y <= start + WIDTH]
                out.append((t[start:start + WIDTH], [s for i, s in enumerate(spans) if all(s[0] >= o[1] for o in spans[:i])]))
    while len(out) < count:
        t = texts[rng.integers(len(texts))]
        at = int(rng.integers(0, max(1, len(t) - WIDTH)))
        words = re.sub(r"[0-9@+]", "", t[at:at + WIDTH]).split(" ")
        kind = int(rng.integers(0, len(KINDS) + 1))
        piece = made_other(rng) if kind == len(KINDS) else made_span(rng, kind, bool(rng.random() < 0.5))
        cut = int(rng.integers(0, len(words) + 1))
        before = " ".join(words[:cut]) + (" " if cut else "")
        before = before[-(WIDTH - len(piece) - 4):] if len(piece) < WIDTH - 4 else ""
        text = (before + piece + " " + " ".join(words[cut:]))[:WIDTH]
        if len(before) + len(piece) <= WIDTH:
            out.append((text, [] if kind == len(KINDS) else [(len(before), len(before) + len(piece), kind)]))
    return out


def fitted(docs: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE_DOCS) -> dict:
    """A model from at most ``sample`` keys' texts, chosen by hash; of each text the start of its first windows' neighbourhood.

    Only pieces of at most a few windows of each sampled text come to the driver: around its base spans, and from its start.
    """
    chosen = hash_sample(docs, key, sample)
    rows = docs.select(F.col(quoted(key)).alias("key"), F.col(quoted(text)).alias("text")).join(F.broadcast(chosen.select(F.col(quoted(key)).alias("key"))), "key")

    def make():
        def fn(texts):
            out = []
            for t in texts:
                t = t or ""
                around = [t[max(0, a - WIDTH):b + WIDTH] for a, b, _ in base_spans(t)[:3]]
                out.append([t[:4 * WIDTH], *around])
            return [out]
        return fn

    pieces = map_texts(rows, make, [("pieces", "array<string>")], ["key"]).select(F.explode("pieces").alias("t")).distinct()
    found = sorted(r["t"] for r in pieces.orderBy(F.xxhash64("t"), "t").limit(4 * sample).collect())
    return train(training_windows(found))


def with_spans(docs: DataFrame, name: str = "spans", key: str = "doc_id", text: str = "text", keep: list[str] | None = None, model: dict | None = None) -> DataFrame:
    """``keep`` columns (all by default) plus all spans by start, then kind; positions are code points, ends exclusive. They replace a column ``name``.

    Null and empty texts have none. Rows stand alone, so copies, repeated rows and an empty table need no care; the model
    is the same for the same documents.
    """
    p = docs.sparkSession.sparkContext.broadcast(model or fitted(docs, key, text))  # some tens of kB

    def make():
        def fn(texts):
            return [[[{"kind": KINDS[k], "start": a, "end": b, "base": base} for a, b, k, base in spans] for spans in all_spans(texts, p.value)]]
        return fn

    return map_texts(docs, make, [(name, SPANS)], docs.columns if keep is None else keep, [text])


def masked_text(text: str | None, spans: list) -> str | None:
    """The text with each span replaced by its kind; of overlapping spans the first one names all."""
    if not spans:
        return text
    out, at = [], 0
    for s in spans:
        if s["start"] >= at:
            out += [text[at:s["start"]], f"<{s['kind'].upper()}>"]
        at = max(at, s["end"])
    return "".join(out) + text[at:]


def masked(docs: DataFrame, key: str = "doc_id", text: str = "text", length: str = "n_chars", model: dict | None = None) -> DataFrame:
    """The documents with masked texts; a ``length`` column, if there is one, follows the new text (null stays null)."""
    new = free_name(docs, "masked")
    p = docs.sparkSession.sparkContext.broadcast(model or fitted(docs, key, text))

    def make():
        def fn(texts):
            found = all_spans(texts, p.value)
            return [[masked_text(t, [{"kind": KINDS[k], "start": a, "end": b} for a, b, k, _ in spans]) for t, spans in zip(texts, found)]]
        return fn

    rest = [c for c in docs.columns if c != text]
    done = map_texts(docs, make, [(new, "string")], rest, [text])
    out = []
    for c in docs.columns:
        if c == text:
            out.append(F.col(new).alias(c))
        elif c == length and dict(docs.dtypes)[c] in ("bigint", "int"):
            out.append(F.when(F.col(quoted(c)).isNotNull() & F.col(new).isNotNull(), F.length(new).cast(dict(docs.dtypes)[c])).otherwise(F.col(quoted(c))).alias(c))
        else:
            out += columns([c])
    return done.select(*out)
