"""Token ids of whole batches of texts from a public vocabulary file.

White space always ends a token of a vocabulary with word ends, so a text is split
at ASCII white space and each distinct chunk is encoded once; with any other vocabulary whole texts are encoded. Most chunks
are letters with some punctuation behind, which this kind of vocabulary also parts: ASCII letters in lower case and what
follows them are chunks of their own. New letters are encoded many at a time, joined by spaces, as each of them is one word
with one end token. Other chunks are joined by a special token.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache
from itertools import islice

import numpy as np

from gaugeloom.llm import words as wd

#: Bytes of chunks and their ids a task remembers before it begins anew, and what an entry costs beside its bytes.
REMEMBERED = 64_000_000
ENTRY = 150
#: What of it a worker keeps for its next task: the chunks learned first, which are mostly the most frequent.
KEPT = 32_000_000
JOINED = 2000
#: Text looked up together; the longer, the rarer a chunk is looked up again.
PIECE_BYTES = 4_000_000
TAIL = b".,;:!?"
END = "</w>"


class Encoder:
    """Ids as bytes: little-endian, two bytes an id if the vocabulary allows, else four."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.remembered = remembered
        special = [t for t in self.tokenizer.get_added_tokens_decoder().values() if t.special]
        self.join = special[0].content if special else None
        self.join_id = self.tokenizer.token_to_id(self.join) if special else None
        self.names = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(END)]] = True
        self.chunked = bool(self.ends.any())
        self.parted = self.chunked and "\\p{L}" in self.tokenizer.to_str()[:2000]
        self.seen: dict[bytes, bytes] = {}
        self.held = 0

    def release(self, kept: int = 0) -> None:
        """Forget all chunks but the first ones, of about ``kept`` bytes, so that an idle worker holds little."""
        if self.held > kept:
            self.seen = dict(islice(self.seen.items(), len(self.seen) * kept // self.held))
            self.held = kept if self.seen else 0

    def _raw(self, text: str) -> np.ndarray:
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(found, dtype=self.kind)

    def _learn(self, chunks: list[bytes]) -> None:
        """Letters with or without punctuation behind go one way, all else the other."""
        plain = [c for c in chunks if c.isalpha() and c.islower()] if self.parted else []
        self.seen.update(self._letters(plain))
        parts, others = [], []
        for chunk in chunks:
            if chunk in self.seen:
                continue
            body = chunk.rstrip(TAIL)
            key = body.lower()
            if self.parted and (key.isalpha() or (key and not key.isascii() and key.decode().isalpha())):
                parts.append((chunk, key, chunk[len(body) :]))
            else:
                others.append(chunk)
        letters: dict[bytes, bytes | None] = {key: self.seen.get(key) for _, key, _ in parts}
        others.extend(t for t in {t for _, _, t in parts} if t and t not in self.seen)
        letters.update(self._letters([k for k, v in letters.items() if v is None]))
        self.seen.update(letters)
        self._learn_others(others)
        for chunk, key, tail in parts:
            ids = letters[key]
            self.seen[chunk] = ids + self.seen[tail] if tail else ids

    def _letters(self, keys: list[bytes]) -> dict[bytes, bytes]:
        """Ids of words of letters, many at a time."""
        found: dict[bytes, bytes] = {}
        for at in range(0, len(keys), JOINED):
            some = keys[at : at + JOINED]
            ids = self._raw(b" ".join(some).decode())
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(some):
                found.update(self._cut(some, ids, np.r_[0, cuts[:-1]], cuts))
            else:  # a letter that is no single letter in lower case
                found.update((k, self._raw(k.decode()).tobytes()) for k in some)
        return found

    def _cut(self, chunks: list[bytes], ids: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> dict[bytes, bytes]:
        raw, width = ids.tobytes(), self.kind.itemsize
        pairs = zip(chunks, (begins * width).tolist(), (ends * width).tolist(), strict=True)
        return {chunk: raw[a:b] for chunk, a, b in pairs}

    def _learn_others(self, chunks: list[bytes]) -> None:
        odd = {c for c in chunks if self.join is None or any(n in c for n in self.names)}
        for chunk in odd:
            self.seen[chunk] = self._raw(chunk.decode()).tobytes()
        plain = [c for c in chunks if c not in odd]
        for at in range(0, len(plain), JOINED):
            some = plain[at : at + JOINED]
            ids = self._raw(self.join.join(c.decode() for c in some))
            cuts = np.flatnonzero(ids == self.join_id)
            self.seen.update(self._cut(some, ids, np.r_[0, cuts + 1], np.r_[cuts, len(ids)]))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if not self.chunked:
            found = self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
            return [np.array(f.ids, dtype=self.kind).tobytes() for f in found]
        out: list[bytes] = []
        for a, b in wd.pieces(texts, PIECE_BYTES):
            out.extend(self._piece(texts[a:b]))
        return out

    def _piece(self, texts: list[bytes]) -> list[bytes]:
        """Each distinct chunk of the texts is looked up once. Chunks of equal hash are compared byte by byte."""
        words = wd.find_words(texts)
        if not len(words.start):
            return [b""] * len(texts)
        if self.parted:
            words = wd.letters_apart(words, TAIL)
        spelled = wd.blocks(words.data, words.start, words.stop)
        _, where, which = np.unique(wd.block_hashes(spelled), return_index=True, return_inverse=True)
        # A chunk that only shares its hash with another one stands for itself.
        odd = np.flatnonzero(~wd.same(spelled, np.arange(len(which)), where[which]))
        which[odd] = len(where) + np.arange(len(odd))
        where = np.concatenate([where, odd])
        data = words.data.tobytes()
        chunks = [data[a:b] for a, b in zip(words.start[where].tolist(), words.stop[where].tolist(), strict=True)]
        found = list(map(self.seen.get, chunks))
        new = [c for c, ids in zip(chunks, found, strict=True) if ids is None]
        if new:
            if self.held > self.remembered:
                self.release()
                new = list(dict.fromkeys(chunks))
            before = len(self.seen)
            self._learn(list(dict.fromkeys(new)))
            self.held += sum(map(len, new)) * 2 + ENTRY * (len(self.seen) - before)
            found = list(map(self.seen.__getitem__, chunks))
        size = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // self.kind.itemsize
        begin = np.cumsum(size) - size
        taken = size[which]
        upto = np.cumsum(taken)
        at = np.arange(upto[-1]) + np.repeat(begin[which] - (upto - taken), taken)
        ids = np.frombuffer(b"".join(found), dtype=self.kind)[at]
        cuts = np.r_[0, upto][words.first].tolist()
        return [ids[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


@lru_cache(maxsize=1)
def _loaded(path: str) -> Encoder:
    return Encoder(path)


@contextmanager
def encoder(path: str) -> Iterator[Encoder]:
    """The encoder of this worker for one task. Most of what the task has learned goes with it."""
    own = _loaded(path)
    try:
        yield own
    finally:
        own.release(KEPT)


def wide(raw: bytes, kind: np.dtype) -> np.ndarray:
    """Stored ids as little-endian unsigned 32-bit numbers."""
    return np.frombuffer(raw, dtype=kind).astype("<u4")
