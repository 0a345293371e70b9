import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gaugeloom.llm import packing, records, tokens, words
from gaugeloom.llm.tokens import Encoder, encoder
from gaugeloom.session import shared_dir

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " \n\t", "Don't STOP, it's 12345 o'clock", "naïve café x é ́a", "<|startoftext|>a<|endoftext|> b<|start",
    "İstanbul ΣΑΣ ß", "\x1c\x1dq \x0b\x0cw", "日本語テキスト 🙂🙂", "x" * 5000, "'s't're", "a\x00b",
]


def ids_of(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [2]


def rows(seed=1):
    rnd = random.Random(seed)
    texts = [" ".join(rnd.choice(["Alpha,", "beta", "gámma!", "x1y2", "of"]) for _ in range(rnd.randrange(300))) for _ in range(60)]
    texts += ODD + ["word " * 20000, None, texts[0], texts[0]]
    ids = [rnd.randrange(40) for _ in texts]
    return list(zip([*ids[:-1], None], texts, strict=True))


def frame_of(spark, data):
    return spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "'x' AS ids", "1 AS start", "2 AS n_tokens")


@pytest.mark.parametrize("remembered", [3, 400_000])
def test_encoder_is_exact(remembered):
    texts = [t or "" for _, t in rows()]
    got = Encoder(PATH, remembered).encode([t.encode() for t in texts])
    plain = Tokenizer.from_file(PATH)
    assert [np.frombuffer(g, "<u2").tolist() for g in got] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_checksums():
    assert records.checksums([b"123456789"])[0] == 0xE3069283
    rnd = random.Random(2)
    parts = [rnd.randbytes(n) for n in (4, 5, 255, 256, 257, 511, 512, 513, 5000)]

    def slow(data):
        crc = 0xFFFFFFFF
        for b in data:
            crc ^= b
            for _ in range(8):
                crc = crc >> 1 ^ (records.POLYNOMIAL if crc & 1 else 0)
        return crc ^ 0xFFFFFFFF

    assert records.checksums(parts).tolist() == [slow(p) for p in parts]
    with pytest.raises(ValueError):
        records.checksums([b"abc"])


def test_damage_is_found():
    whole = b"".join(records.frame([b"payload one", b"payload two"]))
    offsets = np.array([0, 27])
    assert [bytes(p) for p in records.unframe(memoryview(whole), offsets)] == [b"payload one", b"payload two"]
    for at in (0, 9, 13, 24, 30, len(whole) - 1):
        bad = bytearray(whole)
        bad[at] ^= 1
        with pytest.raises((ValueError, struct.error)):
            records.unframe(memoryview(bytes(bad)), offsets)


def test_records_round_trip(spark):
    data = rows()
    for file_bytes in (1, records.FILE_BYTES):
        folder = shared_dir(spark, "records")
        folder = folder if ":" in folder else f"file://{folder}"
        manifest = records.write_records(frame_of(spark, data), PATH, folder, file_bytes=file_bytes)
        got = sorted((r.start, r.doc_id, r.n_tokens, zlib.crc32(r.ids)) for r in records.read_records(spark, manifest, folder).collect())
        assert len(got) == len(data)
        order = [(-1, 0) if r[1] is None else (0, r[1]) for r in got]
        assert order == sorted(order)
        total = 0
        for start, _, n, _ in got:
            assert start == total
            total += n
        want = sorted((str(i), len(x := ids_of(t)), zlib.crc32(np.array(x, "<u4").tobytes())) for i, t in data)
        assert sorted((str(i), n, c) for _, i, n, c in got) == want


def test_records_of_empty_table(spark):
    folder = f"file://{shared_dir(spark, 'records')}"
    manifest = records.write_records(frame_of(spark, []), PATH, folder)
    assert records.read_records(spark, manifest, folder).count() == 0


def check_packing(data, got):
    """Every id in exactly one piece, no gaps, no window over its size; returns padding and all ids."""
    windows, docs = {}, {}
    for r in got:
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert len(r.ids) == 4 * r.length > 0
        docs.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
    padding = 0
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
        padding += 0 if at & (at - 1) == 0 else packing.CAPACITY - at
    want = {}
    for i, t in data:
        x = ids_of(t)
        want.setdefault((i, len(x)), []).extend(enumerate(x))
    have = {k: sorted((s + j, x) for s, ids in v for j, x in enumerate(ids)) for k, v in docs.items()}
    assert have == {k: sorted(v) for k, v in want.items()}
    return padding


def test_packing(spark):
    data = rows() + rows(2) + [(99, None)]
    for most_open in (1, packing.OPEN):
        got = packing.pack(frame_of(spark, data).repartition(3), PATH, most_open=most_open).collect()
        assert check_packing(data, got) == 0


def test_packing_of_empty_table(spark):
    assert packing.pack(frame_of(spark, []), PATH).count() == 0


def test_placement_keeps_the_sum_of_squares_least():
    rnd = random.Random(4)
    packer, square = packing.Packer(20), lambda c: sum(x * x for x in c[1:20])
    for doc in range(400):
        size = rnd.randrange(1, 20)
        counts = [int(x) for x in packer.level]
        options = []
        for level in range(20 - size + 1):
            if level == 0 or counts[level]:
                c = list(counts)
                if level:
                    c[level] -= 1
                c[level + size] += 1
                options.append(square(c))
        packer.place(doc, size)
        assert square([int(x) for x in packer.level]) == min(options)
    assert packer.open == packer.level.sum()


def thue_morse(letters, n):
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


@pytest.mark.parametrize("length", [1024, 2048])
def test_words_that_sum_alike(spark, length):
    """A word and its complement, whose polynomials agree modulo 2**64, get their own ids."""
    texts = [thue_morse("ab", length), thue_morse("ba", length)]
    found = words.find_words([t.encode() for t in texts])
    assert len(set(words.hashes(found).tolist())) == 2
    got = Encoder(PATH).encode([" ".join(texts).encode()])[0]
    assert np.frombuffer(got, "<u2").tolist() == ids_of(" ".join(texts))[:-1]


def test_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(words, "block_hashes", lambda spelled, seed=0: spelled.size.astype(np.uint64))
    texts = ["one two six", "ten eleven twelve two", "", "abcdefgh abcdefgi abcdefghabcdefgh abcdefgiabcdefgh"]
    got = Encoder(PATH).encode([t.encode() for t in texts])
    assert [np.frombuffer(g, "<u2").tolist() for g in got] == [ids_of(t)[:-1] for t in texts]


def test_an_idle_worker_holds_little(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT", 4000)
    texts = [f"the word number {i} of x{i}y" for i in range(500)]
    plain = Tokenizer.from_file(PATH)
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    for _ in range(3):
        with encoder(PATH) as own:
            got = own.encode([t.encode() for t in texts])
            assert [np.frombuffer(g, "<u2").tolist() for g in got] == want
            assert own.held > 4000
        assert 0 < len(own.seen) < 40 and own.held <= 4000 and b"the" in own.seen
    own.release()
    assert not own.seen and not own.held


def test_vocabulary_without_word_ends():
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [t or "" for _, t in rows()]
    plain = Tokenizer.from_file(path)
    got = Encoder(path).encode([t.encode() for t in texts])
    assert [np.frombuffer(g, "<u2").tolist() for g in got] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_a_word_has_one_hash_whatever_lies_beside_it():
    alone = words.hashes(words.find_words([b"short"]))[0]
    beside = words.hashes(words.find_words([b"a word of more than eight bytes: extraordinary", b"short"]))
    assert beside[-1] == alone
    data = b"".join(bytes([i]) * n + b" " for i in (65, 195) for n in range(1, 40))
    found = words.find_words([data])
    spelled = words.blocks(found.data, found.start, found.stop)
    n = len(found.start)
    one, other = np.repeat(np.arange(n), n), np.tile(np.arange(n), n)
    assert (words.same(spelled, one, other) == (one == other)).all()
    assert len(set(words.hashes(found).tolist())) == n


def test_letters_in_both_cases_and_their_punctuation_are_learned_once():
    own = tokens.Encoder(PATH)
    texts = ["The the THE. the, the?! thE;", "\u00c4pfel, \u00e4pfel. a1. A1 .. . x-Y, don't <|endoftext|>. Z\u0130z", ""]
    got = [np.frombuffer(r, dtype=own.kind).tolist() for r in own.encode([t.encode() for t in texts])]
    assert got == [own.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert b"the" in own.seen and b"?!" in own.seen and not {b"The", b"THE.", b"the,", b"thE;"} & own.seen.keys()
    found = words.letters_apart(words.find_words([b"Ab, C1. ..", b"dE?x F"]), b".,")
    spelled = [bytes(found.data[a:b]) for a, b in zip(found.start, found.stop, strict=True)]
    assert spelled == [b"ab", b",", b"C1.", b"..", b"dE?x", b"f"] and found.first.tolist() == [0, 4, 6]
