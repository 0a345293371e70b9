"""Language of every word by a linear-chain conditional random field.

Emission scores come from the bytes of a word: its first and last one to three
bytes, all runs of three bytes (with the word's borders), and whether it stands in the learned
lexicon. Transitions between the languages of neighbouring words are learned
with them, on sequences spliced from documents of different languages, so that
a switch within a text is possible but costs something. Forward-backward gives
each word's distribution over the languages; a document has the mean of its words'.

Texts of any length are handled whole: each is cut into blocks of words, the
blocks' transfer matrices are multiplied up side by side, and
forward-backward runs within all blocks at once from exact border values.

The model is fitted on a bounded sample of labelled rows and is small; every
document is then labelled where it lies, without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeloom.llm import words as wd

#: Labelled documents the model is fitted on, about; chosen by a hash of their doc_id.
SAMPLE = 1200
#: Words of each sampled document that are used, as stretches of SPAN words.
SPANS, SPAN = 4, 40
TABLE = 1 << 15
LEXICON = 20_000
EPOCHS, BATCH, RATE, PENALTY = 6, 64, 0.3, 1e-6
BLOCK = 64
#: Bytes of text whose features lie in memory at once; a longer text is taken whole.
PIECE_BYTES = 1 << 18
UNKNOWN = "und"
_LETTER = re.compile(rb"[A-Za-z]")


class Model(NamedTuple):
    labels: list[str]
    affix: np.ndarray
    gram: np.ndarray
    lexicon: np.ndarray
    known: np.ndarray
    bias: np.ndarray
    change: np.ndarray


class Features(NamedTuple):
    """Of n words: rows of the affix table (n, 6), of the gram table for every byte with each word's first one, lexicon entries."""

    affix: np.ndarray
    gram: np.ndarray
    first: np.ndarray
    entry: np.ndarray
    letters: np.ndarray


def lowered(data: np.ndarray) -> np.ndarray:
    """Bytes in lower case, for ASCII and the letters of Latin-1."""
    out = data.copy()
    out[(data >= 65) & (data <= 90)] += 32
    behind = data[1:]
    out[1:][(data[:-1] == 0xC3) & (behind >= 0x80) & (behind <= 0x9E) & (behind != 0x97)] += 32
    return out


def _slots(h: np.ndarray) -> np.ndarray:
    h = h * np.uint32(0x9E3779B1)
    return (h >> np.uint32(17)).astype(np.int64) & (TABLE - 1)


def features(words: wd.Words, lexicon: np.ndarray) -> Features:
    data = lowered(words.data)
    size = words.stop - words.start
    last = len(data) - 1
    slots = []
    for k in range(3):
        at = np.minimum(words.start + k, last), np.maximum(words.stop - 1 - k, 0)
        for side in (0, 1):
            letter = np.where(size > k, data[at[side]], 0).astype(np.uint32)
            previous = slots[-2][1] if k else np.uint32(side + 1)
            code = (previous << np.uint32(8)) | letter
            slots.append((_slots(code ^ np.uint32(k << 29)), code))
    affix = np.stack([s for s, _ in slots], axis=1) if len(size) else np.zeros((0, 6), dtype=np.int64)
    first = np.cumsum(size) - size
    place = np.arange(int(size.sum())) + np.repeat(words.start - first, size)
    own = data[place].astype(np.uint32)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[first] = 1
    after[first + size - 1] = 1
    gram = _slots((before << np.uint32(16)) | (own << np.uint32(8)) | after)
    letter = (own >= 97) & (own <= 122) | (own >= 128)
    letters = np.logical_or.reduceat(letter, first) if len(size) else np.zeros(0, dtype=bool)
    h = wd.hashes(wd.Words(data, words.start, words.stop, words.first))
    at = np.searchsorted(lexicon, h)
    entry = np.where((at < len(lexicon)) & (lexicon[np.minimum(at, max(len(lexicon) - 1, 0))] == h), at, len(lexicon)) if len(lexicon) else np.zeros(len(h), dtype=np.int64)
    return Features(affix, gram, first, entry, letters)


def emissions(f: Features, model: Model) -> np.ndarray:
    if not len(f.first):
        return np.zeros((0, len(model.labels)), dtype=np.float32)
    out = np.add.reduceat(model.gram[f.gram], f.first, axis=0) + model.known[f.entry] + model.bias
    for k in range(f.affix.shape[1]):
        out += model.affix[f.affix[:, k]]
    return out


def _scaled(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def posteriors(score: np.ndarray, first: np.ndarray, change: np.ndarray) -> np.ndarray:
    """(n, labels) marginals of the words; text t holds words ``first[t]`` up to ``first[t + 1]``."""
    n, labels = score.shape
    if not n:
        return np.zeros((0, labels))
    count = np.diff(first)
    blocks = -(-count // BLOCK)
    base = np.cumsum(blocks) - blocks
    text = np.repeat(np.arange(len(count)), count)
    place = np.arange(n) - first[text]
    row, column = base[text] + place // BLOCK, place % BLOCK
    total = int(blocks.sum())
    weight = np.exp(np.clip(score - score.max(axis=1, keepdims=True), -60, 0)).astype(np.float64)
    step = np.exp(change - change.max()).astype(np.float64)
    node = np.ones((BLOCK, total, labels))
    node[column, row] = weight
    real = np.zeros((BLOCK, total), dtype=bool)
    real[column, row] = True
    opens = np.zeros(total, dtype=bool)
    opens[base[blocks > 0]] = True
    full = bool(real.all())

    # A step leads from the words before to word t; the first word of a text has none before it.
    product = np.broadcast_to(np.eye(labels), (total, labels, labels)).copy()
    for t in range(BLOCK):
        moved = product @ step if t else np.where(opens[:, None, None], product, product @ step)
        moved = moved * node[t][:, None, :]
        if not full:
            moved = np.where(real[t][:, None, None], moved, product)
        product = moved / moved.sum(axis=(1, 2), keepdims=True)
    enter, leave = np.full((total, labels), 1 / labels), np.ones((total, labels))
    most = int(blocks.max())
    for k in range(1, most):
        own = base[blocks > k] + k
        enter[own] = _scaled((enter[own - 1][:, None, :] @ product[own - 1])[:, 0, :])
    for k in range(most - 2, -1, -1):
        own = base[blocks > k + 1] + k
        leave[own] = _scaled((product[own + 1] @ leave[own + 1][:, :, None])[:, :, 0])
    ahead = np.empty((BLOCK, total, labels))
    now = enter
    for t in range(BLOCK):
        moved = now @ step if t else np.where(opens[:, None], now, now @ step)
        moved = _scaled(moved * node[t])
        now = moved if full else np.where(real[t][:, None], moved, now)
        ahead[t] = now
    now = leave
    for t in range(BLOCK - 1, -1, -1):
        ahead[t] = _scaled(ahead[t] * now)
        moved = _scaled((now * node[t]) @ step.T)
        now = moved if full else np.where(real[t][:, None], moved, now)
    return ahead[column, row]


def _chain(weight: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals (b, t, l) and expected transitions (l, l) of sequences of equal length."""
    b, n, labels = weight.shape
    ahead, back = np.empty_like(weight), np.ones_like(weight)
    ahead[:, 0] = _scaled(weight[:, 0])
    for t in range(1, n):
        ahead[:, t] = _scaled((ahead[:, t - 1] @ step) * weight[:, t])
    for t in range(n - 2, -1, -1):
        back[:, t] = _scaled((weight[:, t + 1] * back[:, t + 1]) @ step.T)
    pairs = np.zeros((labels, labels))
    for t in range(1, n):
        p = ahead[:, t - 1, :, None] * step * (weight[:, t] * back[:, t])[:, None, :]
        pairs += (p / p.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    return _scaled(ahead * back), pairs


def fit(rows: list[tuple[str, str]], seed: int = 7) -> Model | None:
    """A model from (text, language) of labelled documents; null without any word."""
    labels = sorted({lang for _, lang in rows})
    rng = np.random.default_rng(seed)
    spans = []
    for text, lang in rows:
        tokens = text.encode().split()
        for _ in range(SPANS):
            if len(tokens) >= SPAN:
                at = int(rng.integers(len(tokens) - SPAN + 1))
                spans.append((tokens[at : at + SPAN], labels.index(lang)))
            elif tokens:
                spans.append(((tokens * (SPAN // len(tokens) + 1))[:SPAN], labels.index(lang)))
    if not spans:
        return None
    # Two stretches of words in a row: half of the sequences switch the language, if the sample has several.
    other = rng.permutation(len(spans))
    turn = rng.integers(1, SPAN, len(spans))
    texts, gold = [], []
    for i, (tokens, label) in enumerate(spans):
        then, second = spans[other[i]] if i % 2 else (tokens, label)
        texts.append(b" ".join(tokens[: turn[i]] + then[turn[i] :]))
        gold.append(np.where(np.arange(SPAN) < turn[i], label, second))
    found = wd.find_words(texts)
    own = wd.Words(lowered(found.data), found.start, found.stop, found.first)
    value, times = np.unique(wd.hashes(own), return_counts=True)
    often = value[np.argsort(-times, kind="stable")[:LEXICON]]
    lexicon = np.sort(often[np.isin(often, value[times >= 5])])
    f = features(found, lexicon)
    k, gold = len(labels), np.array(gold)
    tables = [np.zeros((TABLE, k)), np.zeros((TABLE, k)), np.zeros((len(lexicon) + 1, k)), np.zeros(k), np.zeros((k, k))]
    squares = [np.full_like(t, 1e-3) for t in tables]
    size = np.diff(np.r_[f.first, len(f.gram)])
    for _ in range(EPOCHS):
        order = rng.permutation(len(texts))
        for a in range(0, len(order), BATCH):
            own = (order[a : a + BATCH, None] * SPAN + np.arange(SPAN)).ravel()
            grams = np.arange(int(size[own].sum())) + np.repeat(f.first[own] - (np.cumsum(size[own]) - size[own]), size[own])
            part = Features(f.affix[own], f.gram[grams], np.cumsum(size[own]) - size[own], f.entry[own], f.letters[own])
            model = Model(labels, tables[0], tables[1], lexicon, tables[2], tables[3], tables[4])
            score = emissions(part, model).reshape(-1, SPAN, k)
            seen, pairs = _chain(np.exp(score - score.max(axis=2, keepdims=True)), np.exp(tables[4]))
            truth = gold[order[a : a + BATCH]]
            error = seen.copy()
            np.put_along_axis(error, truth[:, :, None], np.take_along_axis(error, truth[:, :, None], 2) - 1, 2)
            flat = error.reshape(-1, k) / len(own)
            np.subtract.at(pairs, (truth[:, :-1].ravel(), truth[:, 1:].ravel()), 1)
            slopes = [np.zeros_like(t) for t in tables]
            for j in range(f.affix.shape[1]):
                np.add.at(slopes[0], part.affix[:, j], flat)
            np.add.at(slopes[1], part.gram, np.repeat(flat, size[own], axis=0))
            np.add.at(slopes[2], part.entry, flat)
            slopes[3], slopes[4] = flat.sum(axis=0), pairs / len(own)
            for table, square, slope in zip(tables, squares, slopes, strict=True):
                slope += PENALTY * table
                square += slope**2
                table -= RATE * slope / np.sqrt(square)
    small = [t.astype(np.float32) for t in tables]
    return Model(labels, small[0], small[1], lexicon, small[2], small[3], small[4])


def train(docs: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Fit on about ``sample`` rows of ``docs`` (doc_id, text, lang) whose columns are all known."""
    rows = docs.where("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "text", "lang")
    n = rows.count()
    if not n:
        return None
    chosen = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(n)) < sample)
    got = sorted(chosen.limit(4 * sample).collect())
    return fit([(r.text, r.lang) for r in got or rows.limit(sample).collect()])


def _has_letter(text: bytes) -> bool:
    return bool(_LETTER.search(text)) or (not text.isascii() and any(c.isalpha() for c in text.decode()))


def label(texts: list[bytes], model: Model | None) -> list[tuple[str, float, list[dict]]]:
    """(language, score, runs of words with one language) of each text."""
    out: list[tuple[str, float, list[dict]]] = []
    if model is None:
        return [(UNKNOWN, 0.0, []) for _ in texts]
    for a, b in wd.pieces(texts, PIECE_BYTES):
        found = wd.find_words(texts[a:b])
        f = features(found, model.lexicon)
        shares = posteriors(emissions(f, model), found.first, model.change)
        best = shares.argmax(axis=1)
        total = np.vstack([np.zeros((1, shares.shape[1])), np.cumsum(shares * f.letters[:, None], axis=0)])
        count = np.r_[0, np.cumsum(f.letters)]
        for t, text in enumerate(texts[a:b]):
            lo, hi = int(found.first[t]), int(found.first[t + 1])
            if count[hi] == count[lo] or not _has_letter(text):
                out.append((UNKNOWN, 0.0, []))
                continue
            mean = (total[hi] - total[lo]) / (count[hi] - count[lo])
            edge = np.flatnonzero(np.diff(best[lo:hi])) + 1
            sides = np.r_[0, edge, hi - lo]
            runs = [{"lang": model.labels[best[lo + x]], "words": int(y - x)} for x, y in zip(sides[:-1], sides[1:], strict=True)]
            out.append((model.labels[int(mean.argmax())], float(min(max(mean.max(), 0.0), 1.0)), runs))
    return out


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` (text; all columns are kept) with lang_pred, score and runs.

    ``score`` is the mean probability of the predicted language over the words
    with a letter, ``runs`` the stretches of words of one language in the
    order of the text. A null text, one without a letter, and every text if no labelled row was
    known has ``und``, 0 and no runs. Columns of those names are replaced.
    """
    kind = pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int64())]))

    docs = docs.drop("lang_pred", "score", "runs")
    place = [name.lower() for name in docs.columns].index("text")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [t or b"" for t in part.column(place).cast(pa.binary()).to_pylist()]
                lang, score, runs = zip(*label(texts, model), strict=True)
                columns = [*part.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(runs, kind)]
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, "lang_pred", "score", "runs"])

    more = T.StructType.fromDDL("lang_pred string, score double, runs array<struct<lang:string,words:bigint>>")
    return docs.mapInArrow(each, T.StructType(docs.schema.fields + more.fields))
