"""Personal data: exact base patterns, and a character-level bidirectional LSTM with CRF transitions that adds spans.

The network is trained here, in numpy, from labelled spans: windows of the documents labelled by the patterns, and
windows with made-up personal data of looser form (other spacing, no plus sign, spelled-out at and dot, keys and
passwords). Texts are read in windows of WINDOW characters, each overlapping the next by half; every character
takes its tag from the window in whose middle it lies, and the runs of tags that result over the whole text are
the spans. A span that may be added holds a digit, an at sign, the word at or the name of a key or password
(plausible); decoding begins at the windows with one of them and goes on to the end of each run, so it gives what
decoding all windows would. Spans that overlap a base span are not added.

Positions count code points; ends are exclusive. Null and empty texts have no spans. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, fraction, map_rows, prepare, read, texts

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret")
#: Characters of a window; half of it is the step.
WINDOW = 64
#: Windows taken from the documents to train on, at most, and windows made up besides.
MOST_WINDOWS, MADE_UP = 1500, 2500

Span = tuple[str, int, int]

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_KEY = r"(?:password|passwd|secret|token|api_key)\s?[=:]"
#: One of these lies in every span that plausible() lets through, and the span holds its first character.
_SIGNAL = re.compile(rf"[0-9@]| at(?= )|(?i:{_KEY})")
_NAMED_SECRET = re.compile(rf"(?i:{_KEY})\s?[\"']?[^\s\"']{{8}}")
_SECRET = re.compile(r"AKIA[0-9A-Z]{16}|(?:password|passwd|secret|token|api_key)\s?[=:]\s?[\"']?[A-Za-z0-9_/+-]*[0-9][A-Za-z0-9_/+-]*[\"']?")


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """Leftmost non-overlapping matches, found from their at signs, so that long runs cost no more than once."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        before = text[done:at]
        start = done + len(before.rstrip(_LOCAL))
        if start < at and (m := _HOST.match(text, at)):
            out.append(("email", start, m.end()))
            done = m.end()
        else:
            done = at
        at = text.find("@", max(done, at + 1))
    return out


def ips(text: str) -> list[Span]:
    out = []
    for m in _CHAIN.finditer(text):
        if m[0].count(".") < 3:
            continue
        parts, at = m[0].split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                out.append(("ip", at, end))
            at = end + 1
    return out


def base_spans(text: str) -> list[Span]:
    """By kind as listed, then by start."""
    out = emails(text)
    if _SIGNAL.search(text):
        out += ips(text)
        out += [("card", *m.span()) for m in _CARD.finditer(text) if 16 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


def label_spans(text: str) -> list[Span]:
    """What documents are labelled with for training: base spans and plain secrets."""
    return base_spans(text) + [("secret", *m.span()) for m in _SECRET.finditer(text)]


def apart(spans: list[Span], more: list[Span]) -> list[Span]:
    """Those of more that overlap none of spans."""
    return [m for m in more if all(m[2] <= s[1] or m[1] >= s[2] for s in spans)]


# Characters and tags as numbers

PAD, OTHER_LOWER, OTHER_UPPER, OTHER = 0, 96, 97, 98
N_CHARS, N_TAGS = 99, 2 * len(KINDS) + 1  # tag 0: none; 2k+1 begins kind k, 2k+2 goes on


def char_codes(text: str) -> np.ndarray:
    u = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.where((u >= 32) & (u < 127), u - 31, OTHER).astype(np.int64)
    for i in np.flatnonzero(u >= 127):
        out[i] = OTHER_LOWER if (c := chr(u[i])).islower() else OTHER_UPPER if c.isupper() else OTHER
    return out


def tags_of(length: int, spans: list[Span]) -> np.ndarray:
    out = np.zeros(length, np.int64)
    for kind, a, b in spans:
        k = KINDS.index(kind)
        out[a:b] = 2 * k + 2
        out[a] = 2 * k + 1
    return out


def windows_of(text: str) -> list[int]:
    """Starts of the windows to decode first: multiples of half a window, with a signal inside."""
    half, starts = WINDOW // 2, set()
    for m in _SIGNAL.finditer(text):
        block = m.start() // half
        starts.update((block - 1, block))
    return [s * half for s in sorted(starts)]


def beside(starts: set[int], tags: np.ndarray) -> list[int]:
    """Starts of windows not decoded yet into which a run of tags may go on: the run ends where its window's part ends."""
    half, quarter, out = WINDOW // 2, WINDOW // 4, set()
    for s in starts:
        first, last = s + quarter, s + half + quarter - 1
        if s - half not in starts and 0 < first < len(tags) and tags[first]:
            out.add(s - half)
        if s + half not in starts and last + 1 < len(tags) and tags[last]:
            out.add(s + half)
    return sorted(out)


class Tagger:
    """Two LSTMs over one-hot characters, a linear layer on both, and a CRF. Weights are plain arrays."""

    def __init__(self, hidden: int = 20, seed: int = 5):
        rng, h = np.random.default_rng(seed), hidden
        self.h = h
        self.p = {"out": rng.normal(0, 0.2, (2 * h, N_TAGS)), "out_b": np.zeros(N_TAGS), "trans": np.zeros((N_TAGS, N_TAGS))}
        for d in "fb":
            self.p[f"in_{d}"] = rng.normal(0, 0.3, (N_CHARS, 4 * h))
            self.p[f"in_{d}"][:, h : 2 * h] += 1  # forget little at first
            self.p[f"rec_{d}"] = rng.normal(0, 1 / np.sqrt(h), (h, 4 * h))
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def run(self, x: np.ndarray, d: str) -> tuple[np.ndarray, list]:
        n, t, h = *x.shape, self.h
        states, kept, hid, cell = np.zeros((t, n, h), np.float32), [], np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
        order = range(t) if d == "f" else range(t - 1, -1, -1)
        for s in order:
            z = self.p[f"in_{d}"][x[:, s]] + hid @ self.p[f"rec_{d}"]
            gates = 1 / (1 + np.exp(-z[:, : 3 * h]))
            i, f, o, g = gates[:, :h], gates[:, h : 2 * h], gates[:, 2 * h :], np.tanh(z[:, 3 * h :])
            old, before, cell = cell, hid, f * cell + i * g
            squashed = np.tanh(cell)
            hid = o * squashed
            states[s] = hid
            kept.append((s, i, f, o, g, old, squashed, before))
        return states, kept

    def back(self, x: np.ndarray, d: str, kept: list, grad: np.ndarray, out: dict) -> None:
        n, h = x.shape[0], self.h
        d_in, d_rec = np.zeros_like(self.p[f"in_{d}"]), np.zeros_like(self.p[f"rec_{d}"])
        d_hid, d_cell = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
        for s, i, f, o, g, old, squashed, before in reversed(kept):
            d_hid = d_hid + grad[s]
            d_cell = d_cell + d_hid * o * (1 - squashed**2)
            dz = np.concatenate([d_cell * g * i * (1 - i), d_cell * old * f * (1 - f), d_hid * squashed * o * (1 - o), d_cell * i * (1 - g**2)], 1)
            np.add.at(d_in, x[:, s], dz)
            d_rec += before.T @ dz
            d_hid, d_cell = dz @ self.p[f"rec_{d}"].T, d_cell * f
        out[f"in_{d}"], out[f"rec_{d}"] = d_in, d_rec

    def emissions(self, x: np.ndarray) -> np.ndarray:
        both = np.concatenate([self.run(x, "f")[0], self.run(x, "b")[0]], 2)
        return both @ self.p["out"] + self.p["out_b"]

    def step(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Mean negative log likelihood of the tag sequences, and its gradients."""
        (hf, kf), (hb, kb) = self.run(x, "f"), self.run(x, "b")
        both = np.concatenate([hf, hb], 2)
        e, tr = both @ self.p["out"] + self.p["out_b"], self.p["trans"]
        t, n, k = e.shape
        lse = lambda a, axis: (m := a.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(a - m).sum(axis))
        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[0] = e[0]
        for s in range(1, t):
            alpha[s] = lse(alpha[s - 1][:, :, None] + tr, 1) + e[s]
        for s in range(t - 2, -1, -1):
            beta[s] = lse(tr + (e[s + 1] + beta[s + 1])[:, None, :], 2)
        z = lse(alpha[-1], 1)
        rows, yt = np.arange(n), y.T
        d_e = np.exp(alpha + beta - z[None, :, None])
        d_tr = np.zeros_like(tr)
        gold = np.zeros(n)
        for s in range(t):
            gold += e[s, rows, yt[s]]
            d_e[s, rows, yt[s]] -= 1
            if s:
                pair = np.exp(alpha[s - 1][:, :, None] + tr + (e[s] + beta[s])[:, None, :] - z[:, None, None])
                d_tr += pair.sum(0)
                np.add.at(d_tr, (yt[s - 1], yt[s]), -1)
                gold += tr[yt[s - 1], yt[s]]
        d_e /= n
        grads = {"trans": d_tr / n, "out": np.einsum("tnh,tnk->hk", both, d_e), "out_b": d_e.sum((0, 1))}
        d_both = d_e @ self.p["out"].T
        self.back(x, "f", kf, d_both[:, :, : self.h], grads)
        self.back(x, "b", kb, d_both[:, :, self.h :], grads)
        return float((z - gold).mean()), grads

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 8, batch: int = 64, rate: float = 0.01) -> list[float]:
        rng, losses, t = np.random.default_rng(3), [], 0
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(w) for k, w in self.p.items()}
        for epoch in range(epochs):
            order = rng.permutation(len(x))
            for part in np.array_split(order, max(1, len(x) // batch)):
                loss, grads = self.step(x[part], y[part])
                t += 1
                size = np.sqrt(sum(float((g**2).sum()) for g in grads.values()))
                for k, g in grads.items():
                    g = g * min(1.0, 5.0 / (size + 1e-9))
                    m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
                    pace = rate * (0.5 ** max(0, epoch - epochs // 2))
                    self.p[k] = (self.p[k] - pace * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
                losses.append(loss)
        return losses

    def decode(self, x: np.ndarray) -> np.ndarray:
        """Best tag sequences, for each row."""
        e, tr = self.emissions(x), self.p["trans"]
        t, n, k = e.shape
        best, back = e[0], np.zeros((t, n, k), np.int8)
        for s in range(1, t):
            all_ = best[:, :, None] + tr
            back[s] = all_.argmax(1)
            best = all_.max(1) + e[s]
        out = np.zeros((n, t), np.int64)
        out[:, -1] = best.argmax(1)
        for s in range(t - 1, 0, -1):
            out[:, s - 1] = back[s][np.arange(n), out[:, s]]
        return out

    def spans(self, many: list[str]) -> list[list[Span]]:
        """Spans of whole texts, as if all their windows were decoded: from those with a signal on, to the runs' ends."""
        where = [(i, s) for i, text in enumerate(many) for s in windows_of(text)]
        tags = {i: np.zeros(len(many[i]), np.int64) for i, _ in where}
        codes = {i: char_codes(many[i]) for i in tags}
        done: dict[int, set[int]] = {i: set() for i in tags}
        quarter = WINDOW // 4
        while where:
            for k in range(0, len(where), 512):
                x = np.zeros((len(part := where[k : k + 512]), WINDOW), np.int64)
                for row, (i, s) in zip(x, part, strict=True):
                    a, b = max(s, 0), min(s + WINDOW, len(codes[i]))
                    row[a - s : b - s] = codes[i][a:b]
                for row, (i, s) in zip(self.decode(x), part, strict=True):
                    a, b = max(s + quarter, 0), min(s + WINDOW - quarter, len(codes[i]))
                    tags[i][a:b] = row[a - s : b - s]
                    done[i].add(s)
            where = [(i, s) for i in dict.fromkeys(i for i, _ in where) for s in beside(done[i], tags[i])]
        return [runs(tags[i], text) if i in tags else [] for i, text in enumerate(many)]


def plausible(kind: str, s: str) -> bool:
    """The checks of the base patterns, whatever the form: an added span must be able to be what it is called."""
    d = _digits(s)
    if kind == "card":
        return 16 <= len(d) <= 19 and luhn(d)
    if kind == "phone":
        return 8 <= len(d) <= 15
    if kind == "ip":
        parts = re.findall("[0-9]+", s)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    return "@" in s or " at " in s if kind == "email" else bool(d or _NAMED_SECRET.search(s))


def runs(tags: np.ndarray, text: str) -> list[Span]:
    """Runs of one kind, cut where a new span begins; blanks at the rims go, and so do implausible runs."""
    out, kind = [], np.where(tags > 0, (tags + 1) // 2, 0)
    at = np.flatnonzero(kind)
    if not len(at):
        return out
    new = (np.diff(at, prepend=-2) > 1) | (np.diff(kind[at], prepend=0) != 0) | (tags[at] % 2 == 1)
    for part in np.split(at, np.flatnonzero(new))[1:]:
        a, b = int(part[0]), int(part[-1]) + 1
        s = text[a:b]
        a, b = a + len(s) - len(s.lstrip()), b - len(s) + len(s.rstrip())
        if b - a >= 6 and plausible(KINDS[kind[part[0]] - 1], text[a:b]):
            out.append((KINDS[kind[part[0]] - 1], a, b))
    return out


def made_up(n: int, contexts: list[str], seed: int = 9) -> tuple[list[str], list[list[Span]]]:
    """Windows with personal data of many forms in plain context."""
    rng = np.random.default_rng(seed)
    pick = lambda s: s[int(rng.integers(len(s)))]
    word = lambda a=3, b=9: "".join(pick("abcdefghijklmnopqrstuvwxyz") for _ in range(int(rng.integers(a, b))))
    num = lambda k: "".join(pick("0123456789") for _ in range(k))
    any_ = lambda k, s: "".join(pick(s) for _ in range(k))

    def card() -> str:
        s = pick("3456") + num(14)
        s += next(c for c in "0123456789" if luhn(s + c))
        sep = pick(["", " ", "-", "."])
        return sep.join(s[i : i + 4] for i in range(0, 16, 4))

    def phone() -> str:
        a, b, c = num(3), num(3), num(4)
        return pick([f"+{pick('123456789')} ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+{num(2)} {a} {b} {c}", f"00{num(2)} {a} {b}{c}", f"+{num(2)}{a}{b}{c}"])

    def email() -> str:
        name, host = pick([word(), f"{word()}.{word()}", f"{word()}{num(2)}"]), f"{pick([word(), f'{word()}{num(1)}.{word()}', f'mail{num(1)}.example'])}.{pick(['com', 'org', 'net', 'de', 'fr', 'es'])}"
        return pick([f"{name}@{host}", f"{name}@{host}", f"{name} @ {host}", f"{name}{pick(['', ' ' + word(), num(2)])} at {host.replace('.', ' dot ')}"])

    def ip() -> str:
        return ".".join(str(rng.integers(256)) for _ in range(4))

    def secret() -> str:
        return pick([f"AKIA{any_(16, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789')}", f"{pick(['password', 'passwd', 'token', 'secret', 'api_key'])}{pick(['=', ': ', ' = '])}{any_(int(rng.integers(12, 24)), pick(['0123456789abcdef', 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz']))}"])

    plain = [lambda: f"Version {num(1)}.{num(1)}", lambda: num(int(rng.integers(1, 9))), lambda: f"{word()} {num(4)}, {num(2)}", lambda: f"{num(2)}.{num(2)}.{num(4)}", lambda: f"{word()}{num(2)}", lambda: f"{num(1)},{num(3)}.{num(2)}", lambda: f"{word()} at {word()} {word()}"]
    forms = {"email": email, "ip": ip, "card": card, "phone": phone, "secret": secret}
    rows, spans = [], []
    for _ in range(n):
        base = pick(contexts) if contexts and rng.random() < 0.7 else " ".join(word(2, 10) for _ in range(16))
        cut = int(rng.integers(0, WINDOW - 8))
        kind = pick([*KINDS, "none"])
        what = pick(plain)() if kind == "none" else forms[kind]()
        left = (base[:cut] + " ") if cut else ""
        text = (left + what + pick([" ", ". ", ", "]) + base[cut:])[:WINDOW]
        end = min(len(left) + len(what), WINDOW)
        rows.append(text)
        spans.append([(kind, len(left), end)] if kind != "none" and len(left) < end else [])
    return rows, spans


def sample_windows(docs: DataFrame) -> tuple[list[str], list[list[Span]], list[str]]:
    """Labelled windows with a signal, of documents with digits or at signs, and windows without, from a bounded sample."""
    target = arrow_schema("part string, spans string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part, spans = [], []
            for text in b.column("text").to_pylist():
                found = label_spans(text)
                part.append(text[:WINDOW])
                spans.append(",".join(f"{k}:{a}:{min(e, WINDOW)}" for k, a, e in found if a < WINDOW))
                for m in list(_SIGNAL.finditer(text))[:: max(1, len(text) // 200)][:4]:
                    a = max(0, m.start() - WINDOW // 2)
                    part.append(text[a : a + WINDOW])
                    spans.append(",".join(f"{k}:{max(s - a, 0)}:{min(e - a, WINDOW)}" for k, s, e in found if s < a + WINDOW and e > a))
            yield pa.RecordBatch.from_pydict({"part": part, "spans": spans}, schema=target)

    signs = docs.filter(F.col("text").rlike("[0-9@]"))
    n = signs.count()
    rows = fraction(signs, "doc_id", MOST_WINDOWS / 2 / max(n, 1)).mapInArrow(run, "part string, spans string").limit(4 * MOST_WINDOWS).toPandas()
    rows = rows.sort_values(["part", "spans"]).drop_duplicates("part")
    rows = rows.sample(min(len(rows), MOST_WINDOWS), random_state=4)
    parsed = [[(k, int(a), int(b)) for k, a, b in (x.split(":") for x in s.split(",") if x)] for s in rows["spans"]]
    texts_ = rows["part"].tolist()
    return texts_, parsed, [t for t in texts_ if not _SIGNAL.search(t)]


def train(docs: DataFrame) -> Tagger:
    parts, spans, contexts = sample_windows(docs)
    more, more_spans = made_up(MADE_UP, contexts)
    x, y = np.zeros((len(parts) + len(more), WINDOW), np.int64), np.zeros((len(parts) + len(more), WINDOW), np.int64)
    rng = np.random.default_rng(6)
    for i, (text, found) in enumerate(zip(parts + more, spans + more_spans, strict=True)):
        at = int(rng.integers(WINDOW // 2 + 1)) if rng.random() < 0.3 else 0  # as in windows over a text's start
        n = min(len(text), WINDOW - at)
        x[i, at : at + n] = char_codes(text)[:n]
        y[i, at : at + n] = tags_of(len(text), [f for f in found if f[1] < f[2]])[:n]
    tagger = Tagger()
    tagger.train(x, y)
    return tagger


def named(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1])))


def find_pii(docs: DataFrame, tagger: Tagger, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, counts and digest of the base spans, and all spans, of every whole text; one narrow pass."""
    prepare(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(tagger)  # some 100 KB of weights

    def work():
        tagger = model.value

        def each(c: dict) -> dict:
            out: dict = {"doc_id": c["doc_id"], **{f"n_{k}": [] for k in BASE}, "base_sha256": [], "spans": []}
            for text, added in zip(c["text"], tagger.spans(c["text"]), strict=True):
                base = base_spans(text)
                for k in BASE:
                    out[f"n_{k}"].append(sum(s[0] == k for s in base))
                out["base_sha256"].append(hashlib.sha256(named(base).encode()).hexdigest())
                out["spans"].append(named(base + apart(base, added)))
            return out

        return each

    return map_rows(texts(docs, id_col, text_col), work, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def op9(spark, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = read(spark, sf_dir, "documents")
    return find_pii(docs, train(texts(docs)))
