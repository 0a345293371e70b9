import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from gaugeloom.llm import phrases, registry, words

CAPS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows):
    counts, total = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(CAPS)):
            w = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(w)
            for size in (1, 2, 3):
                counts.update((lang, tuple(w[i : i + size])) for i in range(len(w) - size + 1))
    return counts, total


def plain(rows, least=10, share=50, top=2000):
    counts, total = counted(rows)
    out = {}
    for (lang, words_), a in counts.items():
        if len(words_) == 1 or a < least:
            continue
        cuts = []
        for k in range(1, len(words_)):
            left, right = counts[lang, words_[:k]], counts[lang, words_[k:]]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        longer = [f for (other, w), f in counts.items() if other == lang and len(w) == 3 and len(words_) == 2 and words_ in (w[:2], w[1:]) and f >= least]
        if any(100 * f >= share * a for f in longer):
            continue
        out.setdefault(lang, []).append((-score, -a, " ".join(words_).encode(), left, right))
    return sorted(
        (lang, r, p.decode(), -a, left, right, total[lang], -score)
        for lang, found in out.items()
        for r, (score, a, p, left, right) in enumerate(sorted(found)[:top], start=1)
    )


def run(spark, rows, **how):
    docs = spark.createDataFrame(rows, "lang string, text string").selectExpr("*", "1 AS f", "'x' AS phrase", "2 AS size", "3 AS n")
    got = phrases.collocations(docs, **how)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, got.collect()))


def corpus(seed, n=150):
    rnd = random.Random(seed)
    common = ["the", "of", "é", "A-B", "x"]
    rare = [f"w{i}" for i in range(40)]
    fixed = ["New york city", "on  the\tother hand", "ad hoc", "　ab cd"]
    rows = []
    for _ in range(n):
        parts = [rnd.choice(fixed) if rnd.random() < 0.15 else rnd.choice(common if rnd.random() < 0.5 else rare) for _ in range(rnd.randrange(60))]
        rows.append((rnd.choice(["en", "fr", None]), "".join(p + rnd.choice([" ", " ", "  ", ", ", ".\n", "\t"]) for p in parts)))
    return rows + [("en", None), ("xx", ""), ("en", ". ,;"), ("fr", "word " * 300), rows[0], rows[0]]


def test_against_plain(spark):
    rows = corpus(1)
    want = plain(rows)
    assert want and run(spark, rows) == want
    assert run(spark, rows, least=3, share=80, top=5) == plain(rows, 3, 80, 5)


@pytest.mark.parametrize("sample_bytes", [1, 2_000])
def test_border_failures_are_made_good(spark, monkeypatch, sample_bytes):
    """With next to nothing in the sample, phrases of the border are frequent and further passes follow."""
    rows = corpus(2)
    passes = []
    own = phrases._pass
    monkeypatch.setattr(phrases, "_pass", lambda docs, now, *rest: passes.append(now) or own(docs, now, *rest))
    assert run(spark, rows, sample_bytes=sample_bytes) == plain(rows)
    assert 3 <= len(passes) <= 4  # the sample, and two or three passes over all texts


def test_crowded_bitmaps_only_cost_work(spark):
    rows = corpus(3, 80)
    assert run(spark, rows, bits=6, sample_bytes=500) == plain(rows)


@pytest.mark.parametrize("size", [40, 90, 500])
def test_long_texts_in_slices(spark, size):
    rows = [(lang, " ".join(t or "" for _, t in corpus(4, 12))) for lang in ("en", None)]
    rows += [("en", "a b c d " * 60), ("en", ("q" * 120 + " ") * 12 + "a b c d"), ("en", "  a\t\tb  " * 40)]
    assert run(spark, rows, piece_bytes=size) == plain(rows)
    for _, text in rows:
        own = list(phrases._slices(text.encode(), size))
        assert all(lead in (0, 1, 2) for _, lead in own)


def test_words_of_equal_hash(spark, monkeypatch):
    rows = corpus(5, 40)
    monkeypatch.setattr(words, "block_hashes", lambda spelled, seed=0: spelled.size.astype(np.uint64))
    everything = phrases.Proposal(*[b"\xff" * 8] * 3)
    for lang, text in rows:
        own = phrases._Words((text or "").encode(), 0, lang or "und", exact=True)
        got = {p.decode(): f for _, numbers, _, counts in own.phrases(everything, None) for p, f in zip(own.spelled(numbers), counts.tolist(), strict=True)}
        assert got == {" ".join(w): f for (_, w), f in counted([(lang, text)])[0].items()}


def test_empty_tables(spark):
    assert run(spark, []) == []
    assert run(spark, [("en", None), (None, "")]) == []


def test_sql(spark, sf_dir="/root/testdata/sf0.001"):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = con.execute(registry.ORACLE["op12_phrases"]).fetchall()
    assert sorted(map(tuple, registry.op12_phrases(spark, sf_dir).collect())) == sorted(want)
