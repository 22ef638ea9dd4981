"""Personal data in texts: fixed patterns, and a character model that adds what they miss.

The patterns give the base spans (see ``base_spans``). They drop a run of digits as a
whole when it fails its test, as two numbers written side by side do; the model finds the
numbers within. It is a bidirectional LSTM over characters with a linear layer and CRF
transitions between the tags, trained in numpy on the driver from spans labelled by the
patterns in a bounded sample of texts (``SAMPLE_SPANS``), with spans of several kinds
also put next to each other, which the patterns themselves could not label.

Texts are read in windows of ``WINDOW`` characters that overlap by half, wherever a digit
or an at sign is near; nothing that the kinds know is without one. Windows that overlap
form a stretch. Each character's tag scores are averaged over its windows, with more say
for the window in whose middle it lies, and the tags of the whole stretch are decoded
together by Viterbi, so no span is cut at a window's edge.

A span of the model counts only if it passes the test of its kind and meets no base span.
Offsets are code points, ends exclusive. Null and empty texts have no spans. Rows stay as
they are, repeated or not; other columns are left out. Without any base span to learn
from, nothing is added.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
WINDOW = 64
SAMPLE_SPANS = 3000
HIDDEN = 24
STEPS = 320
SEED = 7

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SIGN = re.compile(r"[0-9@]")
_NOT_DIGIT = re.compile(r"[^0-9]")

Span = tuple[str, int, int]


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if i % 2 == 0 else (2 * n if n < 5 else 2 * n - 9)
    return total % 10 == 0


def passes(kind: str, found: str) -> bool:
    """The test of a kind on a match of its pattern."""
    if kind == "email":
        return True
    if kind == "ip":
        return all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or "0") <= 255 for p in found.split("."))
    digits = _NOT_DIGIT.sub("", found)
    if kind == "card":
        return 16 <= len(digits) <= 19 and _luhn(digits)
    return 8 <= len(digits) <= 15


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from the at signs so that long runs of letters cost one pass."""
    begin, at = 0, text.find("@")
    while at >= 0:
        first = at
        while first > begin and text[first - 1] in _LOCAL:
            first -= 1
        domain = _DOMAIN.match(text, at + 1) if first < at else None
        if domain:
            yield first, domain.end()
            begin = domain.end()
        at = text.find("@", max(at + 1, begin))


def base_spans(text: str) -> list[Span]:
    """Leftmost matches per kind that do not overlap and pass the test of their kind."""
    if not _SIGN.search(text):
        return []
    spans = [("email", a, b) for a, b in _emails(text)]
    for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
        spans += [(kind, *m.span()) for m in pattern.finditer(text) if passes(kind, m[0])]
    return spans


_FULL = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+){3}"),
    "card": _CARD,
    "phone": _PHONE,
}

# Classes of characters that the model sees: letters by case, digits, and the signs that matter.
_SIGNS = " \n@.+-()_%:,\"'=/#"
CLASSES = 5 + len(_SIGNS)
TAGS = 1 + 2 * len(KINDS)  # none; first and later characters of each kind


def classes_of(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _TABLE[np.minimum(codes, 128)]


def _class_table() -> np.ndarray:
    table = np.full(129, 3, np.int64)
    table[48:58], table[65:91], table[97:123], table[128] = 0, 1, 2, 4
    for i, sign in enumerate(_SIGNS):
        table[ord(sign)] = 5 + i
    return table


_TABLE = _class_table()


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclass
class Tagger:
    """Weights of both directions (``f``, ``b``), of the layer above and of the transitions."""

    p: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, rng: np.random.Generator) -> Tagger:
        p = {}
        for d in "fb":
            p[f"x{d}"] = rng.normal(0, 0.3, (CLASSES, 4 * HIDDEN))
            p[f"h{d}"] = rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN))
            p[f"c{d}"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
        p["o"] = rng.normal(0, 0.2, (2 * HIDDEN, TAGS))
        p["ob"] = np.zeros(TAGS)
        p["t"] = np.zeros((TAGS, TAGS))
        return cls({k: v.astype(np.float32) for k, v in p.items()})

    def _run(self, x: np.ndarray, d: str) -> dict[str, np.ndarray]:
        """One direction over a batch of windows (rows) of character classes."""
        n, length = x.shape
        inputs = self.p[f"x{d}"][x] + self.p[f"c{d}"]
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        kept = {k: np.empty((length, n, HIDDEN * w), np.float32) for k, w in (("g", 4), ("c", 1), ("h", 1), ("t", 1))}
        for s in range(length) if d == "f" else range(length - 1, -1, -1):
            z = inputs[:, s] + h @ self.p[f"h{d}"]
            gates = _sigmoid(z[:, : 3 * HIDDEN])
            new = np.tanh(z[:, 3 * HIDDEN :])
            c = gates[:, HIDDEN : 2 * HIDDEN] * c + gates[:, :HIDDEN] * new
            t = np.tanh(c)
            h = gates[:, 2 * HIDDEN :] * t
            kept["g"][s, :, : 3 * HIDDEN], kept["g"][s, :, 3 * HIDDEN :] = gates, new
            kept["c"][s], kept["h"][s], kept["t"][s] = c, h, t
        return kept

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Tag scores by window, character and tag."""
        both = np.concatenate([self._run(x, "f")["h"], self._run(x, "b")["h"]], axis=2)
        return (both @ self.p["o"] + self.p["ob"]).transpose(1, 0, 2)

    def _back(self, x: np.ndarray, d: str, kept: dict, dh_out: np.ndarray, grads: dict) -> None:
        n, length = x.shape
        steps = list(range(length)) if d == "f" else list(range(length - 1, -1, -1))
        dh, dc = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        dz_all = np.empty((length, n, 4 * HIDDEN), np.float32)
        for k in range(length - 1, -1, -1):
            s = steps[k]
            before = steps[k - 1] if k else None
            g, t = kept["g"][s], kept["t"][s]
            i, f, o, new = (g[:, j * HIDDEN : (j + 1) * HIDDEN] for j in range(4))
            dh = dh + dh_out[s]
            dc = dc + dh * o * (1 - t * t)
            old = kept["c"][before] if before is not None else 0.0
            dz = np.concatenate([dc * new * i * (1 - i), dc * old * f * (1 - f), dh * t * o * (1 - o), dc * i * (1 - new * new)], axis=1)
            dz_all[s] = dz
            if before is not None:
                grads[f"h{d}"] += kept["h"][before].T @ dz
            dh, dc = dz @ self.p[f"h{d}"].T, dc * f
        shown = np.eye(CLASSES, dtype=np.float32)[x.T.ravel()]
        grads[f"x{d}"] += shown.T @ dz_all.reshape(-1, 4 * HIDDEN)
        grads[f"c{d}"] += dz_all.sum(axis=(0, 1))

    def step(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean negative log likelihood of the tags ``y``."""
        n, length = x.shape
        f, b = self._run(x, "f"), self._run(x, "b")
        both = np.concatenate([f["h"], b["h"]], axis=2)
        e = both @ self.p["o"] + self.p["ob"]
        t = self.p["t"]
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[0] = e[0]
        for s in range(1, length):
            alpha[s] = e[s] + _log_sum(alpha[s - 1][:, :, None] + t, 1)
        for s in range(length - 2, -1, -1):
            beta[s] = _log_sum(t + (e[s + 1] + beta[s + 1])[:, None, :], 2)
        total = _log_sum(alpha[-1], 1)
        marginal = np.exp(alpha + beta - total[None, :, None])
        grads = {k: np.zeros_like(v) for k, v in self.p.items()}
        for s in range(1, length):
            pair = alpha[s - 1][:, :, None] + t + (e[s] + beta[s])[:, None, :] - total[:, None, None]
            grads["t"] += np.exp(pair).sum(axis=0)
        np.add.at(grads["t"], (y[:, :-1].ravel(), y[:, 1:].ravel()), -1.0)
        de = marginal
        de[np.arange(length)[:, None], np.arange(n)[None, :], y.T] -= 1.0
        grads["o"] = both.reshape(-1, 2 * HIDDEN).T @ de.reshape(-1, TAGS)
        grads["ob"] = de.sum(axis=(0, 1))
        dh = de @ self.p["o"].T
        self._back(x, "f", f, dh[:, :, :HIDDEN], grads)
        self._back(x, "b", b, dh[:, :, HIDDEN:], grads)
        return {k: v / n for k, v in grads.items()}

    def decode(self, scores: np.ndarray) -> np.ndarray:
        """The best tags of one stretch."""
        t, back = self.p["t"], np.empty(scores.shape, np.int64)
        best = scores[0]
        for s in range(1, len(scores)):
            paths = best[:, None] + t
            back[s] = paths.argmax(axis=0)
            best = paths[back[s], np.arange(TAGS)] + scores[s]
        tags = np.empty(len(scores), np.int64)
        tags[-1] = best.argmax()
        for s in range(len(scores) - 1, 0, -1):
            tags[s - 1] = back[s, tags[s]]
        return tags


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def tags_of(length: int, spans: list[Span]) -> np.ndarray:
    tags = np.zeros(length, np.int64)
    for kind, a, b in spans:
        k = 1 + 2 * KINDS.index(kind)
        tags[a:b] = k + 1
        tags[a : a + 1] = k
    return tags


def examples(labelled: list[tuple[str, list[Span]]]) -> tuple[np.ndarray, np.ndarray]:
    """Windows with tags: as found, between other words, and with spans side by side."""
    rng = random.Random(SEED)
    found = {k: [t[a:b] for t, spans in labelled for kind, a, b in spans if kind == k] for k in KINDS}
    present = [k for k in KINDS if found[k]]
    words = [w for t, spans in labelled for w in (t[: spans[0][1]] if spans else t).split()] or ["and"]
    texts = list(labelled)
    for _ in range(min(3 * len(labelled), SAMPLE_SPANS)):
        text, spans = " ".join(rng.choices(words, k=rng.randint(0, 6))) + " ", []
        for k in rng.choices(present, k=rng.randint(1, 3)):
            piece = rng.choice(found[k])
            spans.append((k, len(text), len(text) + len(piece)))
            text += piece + rng.choice((" ", " ", " ", ", ", "\n", " " + rng.choice(words) + " "))
        texts.append((text + " ".join(rng.choices(words, k=rng.randint(0, 6))), spans))
    xs, ys = [], []
    for text, spans in texts:
        x, y = classes_of(text), tags_of(len(text), spans)
        begin = max(0, rng.randint(0, max(0, len(x) - WINDOW)))
        x, y = x[begin : begin + WINDOW], y[begin : begin + WINDOW]
        xs.append(np.pad(x, (0, WINDOW - len(x)), constant_values=5))
        ys.append(np.pad(y, (0, WINDOW - len(y))))
    return np.array(xs), np.array(ys)


def fit(labelled: list[tuple[str, list[Span]]], steps: int = STEPS, batch: int = 64) -> Tagger | None:
    """A tagger trained by Adam, or nothing where there is no span to learn from."""
    if not any(spans for _, spans in labelled):
        return None
    rng = np.random.default_rng(SEED)
    x, y = examples(labelled)
    model = Tagger.fresh(rng)
    first = {k: np.zeros_like(v) for k, v in model.p.items()}
    second = {k: np.zeros_like(v) for k, v in model.p.items()}
    order = np.concatenate([rng.permutation(len(x)) for _ in range(-(-steps * batch // len(x)))])
    for t in range(1, steps + 1):
        rows = order[(t - 1) * batch : t * batch]
        grads = model.step(x[rows], y[rows])
        rate = 0.01 * (1 - t / steps) + 0.0005
        norm = float(np.sqrt(sum((g * g).sum() for g in grads.values())))
        for k, g in grads.items():
            g = g * min(1.0, 5.0 / (norm + 1e-9))
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            model.p[k] -= (rate * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return model


def stretches(text: str) -> list[tuple[int, int]]:
    """Runs of half windows with a sign in or beside them, merged."""
    half, found = WINDOW // 2, []
    for m in re.finditer(r"[0-9@][0-9@.()+ -]*", text):
        a, b = max(0, m.start() // half - 1) * half, min(len(text), (m.end() // half + 2) * half)
        if found and a <= found[-1][1]:
            found[-1][1] = max(b, found[-1][1])
        else:
            found.append([a, b])
    return [(a, b) for a, b in found]


_SAY = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(np.float32)


def model_spans(texts: list[str], model: Tagger, most: int = 4096) -> list[list[Span]]:
    """What the model finds in each text; windows of many texts are scored together."""
    half, jobs = WINDOW // 2, []
    for i, text in enumerate(texts):
        for a, b in stretches(text):
            x = classes_of(text[a:b])
            count = max(1, -(-(len(x) - half) // half))
            padded = np.pad(x, (0, max(0, (count + 1) * half - len(x))), constant_values=5)
            jobs.append((i, a, len(x), padded, count))
    found: list[list[Span]] = [[] for _ in texts]
    group, held = [], 0
    for k, job in enumerate(jobs):
        group.append(job)
        held += job[4]
        if held < most and k + 1 < len(jobs):
            continue
        windows = np.concatenate([np.lib.stride_tricks.sliding_window_view(j[3], WINDOW)[::half][: j[4]] for j in group])
        scored = np.concatenate([model.scores(windows[s : s + 1024]) for s in range(0, len(windows), 1024)])
        row = 0
        for i, a, length, padded, count in group:
            total = np.zeros((len(padded), TAGS), np.float32)
            say = np.zeros((len(padded), 1), np.float32)
            for w in range(count):
                total[w * half : w * half + WINDOW] += scored[row + w] * _SAY[:, None]
                say[w * half : w * half + WINDOW] += _SAY[:, None]
            row += count
            tags = model.decode((total / np.maximum(say, 1e-6))[:length])
            found[i] += _spans_of(tags, a)
        group, held = [], 0
    return found


def _spans_of(tags: np.ndarray, at: int) -> list[Span]:
    spans, open_kind, begin = [], None, 0
    for i, tag in enumerate([*tags.tolist(), 0]):
        kind = (tag - 1) // 2 if tag else None
        if open_kind is not None and (kind != open_kind or tag % 2 == 1):
            spans.append((KINDS[open_kind], at + begin, at + i))
            open_kind = None
        if kind is not None and open_kind is None:
            open_kind, begin = kind, i
    return spans


def all_spans(text: str, base: list[Span], extra: list[Span]) -> list[Span]:
    """The base spans and those of the model that pass and meet none of them."""
    taken = list(base)
    for kind, a, b in extra:
        piece = text[a:b]
        a, b = a + len(piece) - len(piece.lstrip(" \n")), b - len(piece) + len(piece.rstrip(" \n.,;:"))
        m = _FULL[kind].fullmatch(text, a, b) if a < b else None
        if m and passes(kind, m[0]) and all(b <= c or a >= d for _, c, d in taken):
            taken.append((kind, a, b))
    return sorted(taken, key=lambda s: (KINDS.index(s[0]), s[1]))


def joined(spans: list[Span]) -> str:
    ordered = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1]))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in ordered)


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Around each base span, as far as no failing match lies near, its text and spans."""
    schema = pa.schema([("around", pa.string()), ("spans", pa.string())])
    for batch in batches:
        rows = []
        for text in batch.column(0).to_pylist():
            spans = base_spans(text or "")
            taken = sorted((a, b) for _, a, b in spans)
            for kind, a, b in spans:
                first, last = max(0, a - WINDOW // 2), min(len(text), b + WINDOW // 2)
                near = [s for s in spans if s[1] < last and s[2] > first]
                if any(s[1] < first or s[2] > last for s in near):
                    continue
                rest = "".join(c for i, c in enumerate(text[first:last], first) if not any(p <= i < q for p, q in taken))
                if not _SIGN.search(rest):
                    rows.append((text[first:last], joined([(k, p - first, q - first) for k, p, q in near])))
        yield pa.record_batch([[r[0] for r in rows], [r[1] for r in rows]], schema=schema)


def _parsed(spans: str) -> list[Span]:
    return [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in spans.split(","))]


def train(docs: DataFrame, text_column: str = "text", most: int = SAMPLE_SPANS) -> Tagger | None:
    """A tagger from at most ``most`` labelled stretches of text, those of least hash."""
    texts = docs.select(text_column).filter(F.col(text_column).rlike("[0-9@]"))
    around = texts.mapInArrow(_sampled, "around string, spans string").distinct()
    rows = around.orderBy(F.xxhash64("around", "spans"), "around", "spans").limit(most).collect()
    return fit([(r["around"], _parsed(r["spans"])) for r in rows])


def _find(batches: Iterator[pa.RecordBatch], model: Tagger | None) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("base", pa.list_(pa.string())), ("spans", pa.list_(pa.string()))])
    for batch in batches:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        base = [base_spans(t) for t in texts]
        near = [i for i, t in enumerate(texts) if _SIGN.search(t)]
        extra: list[list[Span]] = [[] for _ in texts]
        if model:
            for i, spans in zip(near, model_spans([texts[i] for i in near], model)):
                extra[i] = spans
        spans = [joined(all_spans(t, b, e)).split(",") if b or e else [] for t, b, e in zip(texts, base, extra)]
        yield pa.record_batch(
            [batch.column(0), pa.array([joined(b).split(",") if b else [] for b in base]), pa.array([[x for x in s if x] for s in spans])],
            schema=schema,
        )


def find_personal_data(docs: DataFrame, model: Tagger | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``base`` and ``spans`` of each row, as lists of ``kind:start:end``."""
    texts = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].alias("text"))
    return texts.mapInArrow(lambda it: _find(it, model), "doc_id long, base array<string>, spans array<string>")
