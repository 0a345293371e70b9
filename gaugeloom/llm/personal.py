"""Personal data in text: fixed patterns, and a character-level BiLSTM with a CRF for what they miss.

Four kinds are found: mail addresses, IP addresses, card numbers and phone
numbers. Their patterns (the base) are exact rules. A bidirectional LSTM reads characters,
a linear-chain CRF with learned transitions labels each one as outside of, first in or
further in a span of some kind. Both are trained in NumPy, on windows around spans of
the base and around other digits, from a bounded sample of the documents; some spans are respelled (an accented
letter in an address, other separators, no plus sign), so that the network learns to go by context and shape.

Every text is cut into overlapping windows. Each is decoded on its own; the spans of
all windows of a document are then reconciled at once: equal ones fall together, what a window's
border cuts gives way to the window that holds it whole, and of spans that overlap the set with the largest
total score stays. Base spans always stay, and nothing is added across them.
A window without a digit and without @ cannot hold a span that passes the check of its kind, so it is not decoded.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeloom.llm.common import text_or_empty

KINDS = ("email", "ip", "card", "phone")
LABELS = 1 + 2 * len(KINDS)  # outside, then first and further for each kind
#: Documents whose spans the model is fitted on, about, and windows taken from them.
FIT_ROWS = 100_000
FIT_WINDOWS = 1500
#: Characters of a window in training; of a decoded one, and by how many two of these overlap.
TRAINED = 64
WINDOW, OVERLAP = 192, 64
EMBEDDING, HIDDEN = 12, 16
EPOCHS, BATCH, RATE = 8, 64, 0.01
#: Mean probability of its labels from which on a decoded span is added.
SCORE = 0.9
DECODED = 256
SEED = 11
SYMBOLS = 130  # ASCII, one for all other characters, one behind the end of a text
OTHER, PAD = 128, 129

Span = tuple[int, int, int]  # kind, start, stop

_TRIGGER = re.compile("[0-9@]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match that could begin within a run of digits would have begun with the run.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return (sum(values[::2]) + sum(2 * v - 9 * (v > 4) for v in values[1::2])) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The pattern matches at each @ at most once, from the first character of the run before it."""
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            free = found.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", at + 1)


def _small(number: str) -> bool:
    return len(number.lstrip("0")) < 4 and int(number.lstrip("0") or 0) <= 255


def base_spans(text: str) -> list[Span]:
    """The spans of the patterns, by kind and then by place."""
    if not _TRIGGER.search(text):
        return []
    out = [(0, a, b) for a, b in _emails(text)]
    out += [(1, *m.span()) for m in _IP.finditer(text) if all(map(_small, m.group().split(".")))]
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return out


_ADDRESS = re.compile(r"[^\s@<>()\[\]\"',;:]+@[^\s@<>()\[\]\"',;:]+\.[^\s@<>()\[\]\"',;:.]+")
_NUMBERS = re.compile(r"[0-9]{1,3}(?:[\[( ]{0,2}\.[\]) ]{0,2}[0-9]{1,3}){3}")
_GROUPS = re.compile(r"[0-9](?:[ ./_-]{0,2}[0-9])+")
_CALL = re.compile(r"\+?\(?[0-9](?:[ ()./-]{0,3}[0-9])+")


def passes(kind: int, text: str) -> bool:
    """Whether a decoded span can be what its label says."""
    digits = _digits(text)
    if kind == 0:
        return _ADDRESS.fullmatch(text) is not None and any(c.isalpha() for c in text)
    if kind == 1:
        return _NUMBERS.fullmatch(text) is not None and all(int(n) <= 255 for n in re.findall("[0-9]+", text))
    if kind == 2:
        return _GROUPS.fullmatch(text) is not None and 13 <= len(digits) <= 19 and luhn(digits)
    return _CALL.fullmatch(text) is not None and 9 <= len(digits) <= 15 and digits != text


# --- the network ---------------------------------------------------------------------------------


class Model(NamedTuple):
    """Both directions side by side; ``gates`` holds the input's share of the four gates for every symbol."""

    embedding: np.ndarray  # symbols, EMBEDDING
    inner: np.ndarray  # 2, EMBEDDING, 4 HIDDEN
    recurrent: np.ndarray  # 2, HIDDEN, 4 HIDDEN
    bias: np.ndarray  # 2, 1, 4 HIDDEN
    out: np.ndarray  # 2 HIDDEN, LABELS
    out_bias: np.ndarray  # LABELS
    change: np.ndarray  # LABELS, LABELS
    first: np.ndarray  # LABELS


def _allowed() -> np.ndarray:
    """``further`` labels follow a label of their own kind only; the last row is for the beginning."""
    ok = np.ones((LABELS + 1, LABELS), dtype=bool)
    for kind in range(len(KINDS)):
        inside = 2 + 2 * kind
        ok[:, inside] = False
        ok[[inside - 1, inside], inside] = True
    return ok


ALLOWED = _allowed()


def fresh(rng: np.random.Generator) -> Model:
    spread = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[-2])).astype(np.float32)
    bias = np.zeros((2, 1, 4 * HIDDEN), dtype=np.float32)
    bias[..., HIDDEN : 2 * HIDDEN] = 1  # forget gates begin open
    return Model(
        (rng.standard_normal((SYMBOLS, EMBEDDING)) * 0.5).astype(np.float32), spread(2, EMBEDDING, 4 * HIDDEN), spread(2, HIDDEN, 4 * HIDDEN), bias,
        spread(2 * HIDDEN, LABELS), np.zeros(LABELS, np.float32), np.zeros((LABELS, LABELS), np.float32), np.zeros(LABELS, np.float32),
    )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def _both(x: np.ndarray) -> np.ndarray:
    """(B, T) as (T, 2, B), the second direction backwards."""
    return np.stack([x.T, x.T[::-1]], axis=1)


def _run(model: Model, symbols: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Emission scores (T, B, LABELS); ``keep`` collects what training needs of each step."""
    steps, batch = symbols.shape[1], symbols.shape[0]
    gates = model.embedding @ model.inner + model.bias  # 2, SYMBOLS, 4 HIDDEN
    both = _both(symbols)
    h = np.zeros((2, batch, HIDDEN), dtype=gates.dtype)
    c = np.zeros_like(h)
    states = np.empty((steps, 2, batch, HIDDEN), dtype=gates.dtype)
    for t in range(steps):
        z = np.stack([gates[0][both[t, 0]], gates[1][both[t, 1]]]) + h @ model.recurrent
        s = _sigmoid(z[..., : 3 * HIDDEN])
        g = np.tanh(z[..., 3 * HIDDEN :])
        before, last = c, h
        c = s[..., HIDDEN : 2 * HIDDEN] * c + s[..., :HIDDEN] * g
        bent = np.tanh(c)
        h = s[..., 2 * HIDDEN :] * bent
        states[t] = h
        if keep is not None:
            keep.append((s, g, before, last, bent))
    joined = np.concatenate([states[:, 0], states[::-1, 1]], axis=2)
    if keep is not None:
        keep.append((both, joined))
    return joined @ model.out + model.out_bias


def _outside(scores: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """Places behind the end of a text are outside."""
    scores = scores.astype(np.float64)
    scores[(symbols == PAD).T] = np.r_[0.0, np.full(LABELS - 1, -50.0)]
    return scores


def _chain(model: Model, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward with every step scaled to one: probabilities (T, B, LABELS), and what pairs need."""
    steps, batch, _ = scores.shape
    emit = np.exp(scores - scores.max(axis=2, keepdims=True))
    change = np.exp(model.change.astype(np.float64)) * ALLOWED[:-1]
    begin = np.exp(model.first.astype(np.float64)) * ALLOWED[-1]
    alpha, beta = np.empty_like(emit), np.ones_like(emit)
    for t in range(steps):
        alpha[t] = (begin if t == 0 else alpha[t - 1] @ change) * emit[t]
        alpha[t] /= alpha[t].sum(axis=1, keepdims=True)
    for t in range(steps - 2, -1, -1):
        beta[t] = (emit[t + 1] * beta[t + 1]) @ change.T
        beta[t] /= beta[t].sum(axis=1, keepdims=True)
    chance = alpha * beta
    chance /= chance.sum(axis=2, keepdims=True)
    return chance, alpha, beta, emit, change


def gradient(model: Model, symbols: np.ndarray, gold: np.ndarray) -> tuple[float, Model]:
    """Mean negative log-likelihood of the gold labels (B, T) and its derivatives."""
    batch, steps = symbols.shape
    keep: list = []
    scores = _outside(_run(model, symbols, keep), symbols)
    both, joined = keep.pop()
    chance, alpha, beta, emit, change = _chain(model, scores)
    labels = gold.T
    rows = np.arange(batch)

    expected = np.zeros((LABELS, LABELS))
    observed = np.zeros((LABELS, LABELS))
    gain = np.zeros(batch)
    for t in range(steps):
        gain += scores[t, rows, labels[t]]
        if t:
            pair = alpha[t - 1][:, :, None] * change * (emit[t] * beta[t])[:, None, :]
            expected += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            np.add.at(observed, (labels[t - 1], labels[t]), 1)
            gain += model.change[labels[t - 1], labels[t]]
    gain += model.first[labels[0]]
    loss = float((_log_total(model, scores) - gain).mean())

    d = chance.copy()
    d[np.arange(steps)[:, None], rows[None, :], labels] -= 1
    d_first = d[0].sum(axis=0) * ALLOWED[-1] / batch
    d[(symbols == PAD).T] = 0
    d = (d / batch).astype(model.out.dtype)
    d_out = joined.reshape(-1, 2 * HIDDEN).T @ d.reshape(-1, LABELS)
    back = d @ model.out.T
    d_states = np.stack([back[..., :HIDDEN], back[::-1, :, HIDDEN:]], axis=1)  # T, 2, B, HIDDEN
    d_gates = np.zeros((2, SYMBOLS, 4 * HIDDEN), dtype=d.dtype)
    d_recurrent = np.zeros_like(model.recurrent)
    dh = np.zeros((2, batch, HIDDEN), dtype=d.dtype)
    dc = np.zeros_like(dh)
    for t in range(steps - 1, -1, -1):
        s, g, before, last, bent = keep[t]
        i, f, o = s[..., :HIDDEN], s[..., HIDDEN : 2 * HIDDEN], s[..., 2 * HIDDEN :]
        dh = dh + d_states[t]
        dc = dc + dh * o * (1 - bent * bent)
        dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * bent * o * (1 - o), dc * i * (1 - g * g)], axis=2)
        dc = dc * f
        d_recurrent += last.transpose(0, 2, 1) @ dz
        for side in (0, 1):
            np.add.at(d_gates[side], both[t, side], dz[side])
        dh = dz @ model.recurrent.transpose(0, 2, 1)
    return loss, Model(
        sum(d_gates[s] @ model.inner[s].T for s in (0, 1)),
        model.embedding.T @ d_gates,
        d_recurrent,
        d_gates.sum(axis=1, keepdims=True),
        d_out,
        d.sum(axis=(0, 1)),
        ((expected - observed) / batch * ALLOWED[:-1]).astype(np.float32),
        d_first.astype(np.float32),
    )


def _log_total(model: Model, scores: np.ndarray) -> np.ndarray:
    """Logarithm of the summed weight of all label sequences."""
    change = np.exp(model.change.astype(np.float64)) * ALLOWED[:-1]
    at = np.exp(model.first.astype(np.float64)) * ALLOWED[-1]
    total = np.zeros(scores.shape[1])
    for t, row in enumerate(scores):
        top = row.max(axis=1, keepdims=True)
        at = (at if t == 0 else at @ change) * np.exp(row - top)
        size = at.sum(axis=1, keepdims=True)
        at = at / size
        total += (np.log(size) + top)[:, 0]
    return total


def best_labels(model: Model, scores: np.ndarray) -> np.ndarray:
    """The most likely label sequence of each window, (B, T)."""
    change = np.where(ALLOWED[:-1], model.change, -np.inf)
    at = scores[0] + np.where(ALLOWED[-1], model.first, -np.inf)
    came = np.zeros(scores.shape, dtype=np.int8)
    for t in range(1, len(scores)):
        ways = at[:, :, None] + change
        came[t] = ways.argmax(axis=1)
        at = ways.max(axis=1) + scores[t]
    path = np.empty(scores.shape[1::-1], dtype=np.int64)
    path[:, -1] = at.argmax(axis=1)
    for t in range(len(scores) - 1, 0, -1):
        path[:, t - 1] = came[t][np.arange(len(path)), path[:, t]]
    return path


# --- training ------------------------------------------------------------------------------------


def symbols_of(text: str, size: int) -> np.ndarray:
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    out = np.full(size, PAD, dtype=np.int64)
    out[: len(code)] = np.minimum(code, OTHER)
    return out


def labels_of(spans: list[Span], size: int) -> np.ndarray:
    """Labels of ``size`` characters; a span that begins before them has lost its first label."""
    out = np.zeros(size, dtype=np.int64)
    for kind, start, stop in spans:
        a, b = max(start, 0), min(stop, size)
        if a < b:
            out[a:b] = 2 + 2 * kind
            out[a] = 1 + 2 * kind
    return out


def respelled(kind: int, text: str, rng: np.random.Generator) -> str:
    """Another way to write a span that the patterns do not cover."""
    if kind == 0:
        letters = [i for i, c in enumerate(text) if c.isalpha()]
        if not letters:
            return text
        at = letters[int(rng.integers(len(letters)))]
        return text[:at] + "äéøñüç"[int(rng.integers(6))] + text[at + 1 :]
    if kind == 1:
        return text.replace(".", ("[.]", " . ", "(.)")[int(rng.integers(3))])
    digits = _digits(text)
    if kind == 2:
        return ("./_"[int(rng.integers(3))]).join(digits[i : i + 4] for i in range(0, len(digits), 4))
    if rng.integers(2):
        return text.lstrip("+")
    mark = "./"[int(rng.integers(2))]
    return f"{digits[:-7]}{mark}{digits[-7:-4]}{mark}{digits[-4:]}"


def _respell(text: str, spans: list[Span], rng: np.random.Generator) -> tuple[str, list[Span]]:
    parts, out, at, size = [], [], 0, 0
    for kind, start, stop in sorted(spans, key=lambda s: s[1]):
        if start < at:
            continue
        own = text[start:stop] if rng.random() < 0.4 else respelled(kind, text[start:stop], rng)
        parts += [text[at:start], own]
        size += start - at
        out.append((kind, size, size + len(own)))
        size += len(own)
        at = stop
    return "".join(parts) + text[at:], out


def fit(examples: list[tuple[str, list[Span]]], epochs: int = EPOCHS, seed: int = SEED) -> Model:
    """Train on texts with their spans; each comes as it is and respelled."""
    rng = np.random.default_rng(seed)
    examples = examples + [_respell(text, spans, rng) for text, spans in examples if spans]
    cut = []
    for text, spans in examples:
        middle = (spans[int(rng.integers(len(spans)))][1] if spans else len(text) // 2) - int(rng.integers(4, TRAINED - 8))
        start = max(0, min(middle, len(text) - TRAINED // 2))
        own = text[start : start + TRAINED]
        cut.append((symbols_of(own, TRAINED), labels_of([(k, a - start, b - start) for k, a, b in spans], TRAINED)))
    symbols, gold = np.stack([c[0] for c in cut]), np.stack([c[1] for c in cut])
    gold[symbols == PAD] = 0
    model = fresh(rng)
    mean, square, step = [np.zeros_like(p) for p in model], [np.zeros_like(p) for p in model], 0
    for _ in range(epochs):
        order = rng.permutation(len(symbols))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            _, slope = gradient(model, symbols[some], gold[some])
            norm = float(np.sqrt(sum((g.astype(np.float64) ** 2).sum() for g in slope)))
            step += 1
            moved = []
            for j, (p, g) in enumerate(zip(model, slope, strict=True)):
                g = g * min(1.0, 5.0 / max(norm, 1e-12))
                mean[j] = 0.9 * mean[j] + 0.1 * g
                square[j] = 0.999 * square[j] + 0.001 * g * g
                moved.append((p - RATE * (mean[j] / (1 - 0.9**step)) / (np.sqrt(square[j] / (1 - 0.999**step)) + 1e-8)).astype(np.float32))
            model = Model(*moved)
    return model


EXAMPLES = "text string, spans array<struct<kind:int,start:int,stop:int>>, order long"


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches around spans of the base, and around digits and @ that are in none."""
    kind = pa.schema([("text", pa.string()), ("spans", pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32())])))])
    for batch in batches:
        rows = []
        for text in batch.column(0).to_pylist():
            spans = base_spans(text)
            places = [a for _, a, _ in spans]
            at = 0
            while found := _TRIGGER.search(text, at):
                if not any(a <= found.start() < b for _, a, b in spans):
                    places.append(found.start())
                at = found.start() + TRAINED
            for place in places:
                lo, hi = max(0, place - TRAINED), place + 2 * TRAINED
                own = [{"kind": k, "start": a - lo, "stop": b - lo} for k, a, b in spans if a >= lo and b <= hi]
                rows.append({"text": text[lo:hi], "spans": own})
        if rows:
            yield pa.RecordBatch.from_pylist(rows, kind)


def train(docs: DataFrame, rows: int = FIT_ROWS, windows: int = FIT_WINDOWS) -> Model | None:
    """A model fitted on at most ``windows`` stretches of about ``rows`` documents; None if they hold no span."""
    count = docs.count()
    some = docs if count <= rows else docs.sample(rows / count, seed=SEED)
    found = some.select(text_or_empty().alias("text")).mapInArrow(_examples, EXAMPLES.rsplit(",", 1)[0])
    halves = [found.where(w).orderBy(F.xxhash64("text"), "text").limit(windows // 2).collect() for w in ("size(spans) > 0", "size(spans) = 0")]
    if not halves[0]:
        return None
    return fit([(r.text, [(s.kind, s.start, s.stop) for s in r.spans]) for half in halves for r in half])


# --- decoding ------------------------------------------------------------------------------------


def _windows(text: str) -> Iterator[tuple[int, str]]:
    step = WINDOW - OVERLAP
    for start in range(0, max(len(text) - OVERLAP, 1), step):
        if _TRIGGER.search(text, start, start + WINDOW):
            yield start, text[start : start + WINDOW]


def decoded(model: Model, windows: list[str]) -> list[list[tuple[int, int, int, float]]]:
    """(kind, start, stop, score) of the spans of each window."""
    symbols = np.stack([symbols_of(w, WINDOW) for w in windows])
    scores = _outside(_run(model, symbols), symbols)
    chance = _chain(model, scores)[0]
    labels = best_labels(model, scores)
    likely = np.take_along_axis(chance.transpose(1, 0, 2), labels[:, :, None], axis=2)[:, :, 0]
    out: list[list[tuple[int, int, int, float]]] = [[] for _ in windows]
    for w, at in zip(*np.nonzero(labels % 2 == 1), strict=True):
        inside = labels[w, at] + 1
        stop = at + 1
        while stop < WINDOW and labels[w, stop] == inside:
            stop += 1
        out[w].append(((int(inside) - 2) // 2, int(at), int(stop), float(likely[w, at:stop].mean())))
    return out


def reconcile(found: list[tuple[int, int, int, float]], fixed: list[Span]) -> list[Span]:
    """Of (kind, start, stop, score) spans, those without overlap that have the largest total score and touch no fixed one."""
    edges = sorted((a, b) for _, a, b in fixed)
    starts = [a for a, _ in edges]
    reach = np.maximum.accumulate([b for _, b in edges]).tolist() if edges else []
    free: dict[Span, float] = {}
    for kind, start, stop, score in found:
        k = bisect_right(starts, stop - 1)
        if not k or reach[k - 1] <= start:
            free[kind, start, stop] = max(score, free.get((kind, start, stop), 0.0))
    spans = sorted(free, key=lambda s: (s[2], s[1], s[0]))
    stops = [s[2] for s in spans]
    best, take = [0.0], []
    for i, span in enumerate(spans):
        before = bisect_right(stops, span[1], hi=i)
        value = best[before] + free[span]
        take.append(before if value > best[-1] else -1)
        best.append(max(value, best[-1]))
    out, i = [], len(spans)
    while i:
        if take[i - 1] < 0:
            i -= 1
        else:
            out.append(spans[i - 1])
            i = take[i - 1]
    return sorted(out)


class _Waiting(NamedTuple):
    doc: int
    start: int
    last: bool
    text: str


def added_spans(model: Model, texts: list[str], base: list[list[Span]], least: float = SCORE) -> list[list[Span]]:
    """For each text the spans that the model adds to the base."""
    found: list[list[tuple[int, int, int, float]]] = [[] for _ in texts]
    waiting: list[_Waiting] = []

    def decode() -> None:
        for window, spans in zip(waiting, decoded(model, [w.text for w in waiting]), strict=True):
            text = texts[window.doc]
            for kind, a, b, score in spans:
                start, stop = window.start + a, window.start + b
                cut = (a == 0 and start > 0) or (b == len(window.text) and not window.last)
                alone = not (start and text[start - 1].isalnum()) and not (stop < len(text) and text[stop].isalnum())
                if score >= least and not cut and alone and passes(kind, text[start:stop]):
                    found[window.doc].append((kind, start, stop, score))
        waiting.clear()

    for doc, text in enumerate(texts):
        for start, own in _windows(text):
            waiting.append(_Waiting(doc, start, start + WINDOW >= len(text), own))
            if len(waiting) == DECODED:
                decode()
    if waiting:
        decode()
    return [reconcile(f, b) for f, b in zip(found, base, strict=True)]


SCHEMA = "doc_id long, base array<struct<kind:string,start:long,stop:long>>, added array<struct<kind:string,start:long,stop:long>>"


def _find(model: Model | None):
    spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))
    listed = lambda found: [{"kind": KINDS[k], "start": a, "stop": b} for k, a, b in found]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                rows = batch.slice(at, 512)
                texts = rows.column(1).to_pylist()
                base = [base_spans(t) for t in texts]
                added = added_spans(model, texts, base) if model else [[] for _ in texts]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array([listed(b) for b in base], spans), pa.array([listed(a) for a in added], spans)], ["doc_id", "base", "added"]
                )

    return each


def find(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, base, added) of every row of ``docs`` (doc_id, text; other columns are ignored).

    Both are lists of (kind, start, stop) by kind in the order of ``KINDS``, then
    by start; places count code points from 0, ``stop`` is exclusive. Base spans of one kind
    do not overlap, those of different kinds may. An added span overlaps no base span and no other added one.

    A null or empty text has no spans. Without a model nothing is added. Repeated rows and rows with a null
    doc_id come out as often as they came in. An empty table gives an empty result.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(_find(model), SCHEMA)
