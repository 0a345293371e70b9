import random
import re

from gaugeloom.llm import substring

WORD = re.compile("[^\\x20\\x09-\\x0D]+")


def plain(rows, window=13):
    first = {}
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    for i, w in words:
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            if i is not None and i < first.get(key, float("inf")):
                first[key] = i
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=str)


def run(spark, rows, **how):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS piece", "1 AS n_words", "2 AS kept")
    got = substring.remove_repeats(docs, **how).collect()
    for r in got:
        assert sum(x.length for x in r.runs) == r.n_removed
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=str)


def corpus(seed):
    rnd = random.Random(seed)
    vocabulary = [f"{c}{i}" for c in ("a", "é", "Z") for i in range(60)]
    passages = [[rnd.choice(vocabulary) for _ in range(rnd.randrange(8, 60))] for _ in range(12)]
    rows = []
    for i in range(260):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randrange(0, 80))]
        for _ in range(rnd.randrange(3)):
            p = rnd.choice(passages)
            a = rnd.randrange(len(p))
            at = rnd.randrange(len(words) + 1)
            words[at:at] = p[a:]
        rows.append((rnd.randrange(200), "".join(w + rnd.choice([" ", "\n", "\t ", "  "]) for w in words)))
    rows += rows[:20]
    rows += [(None, rows[0][1]), (7, None), (8, ""), (None, None), (500, "loop " * 3000), (501, "loop " * 14), (502, "\x0b\x0c"), (-3, "loop " * 13)]
    return rows


def test_against_brute_force(spark):
    rows = corpus(1)
    assert run(spark, rows) == plain(rows)
    assert run(spark, rows, piece_bytes=3000) == plain(rows)


def test_other_windows(spark):
    rows = corpus(2)
    for window in (1, 2, 6):
        assert run(spark, rows, window=window, piece_bytes=9000) == plain(rows, window)


def test_empty(spark):
    assert run(spark, []) == []


def test_runs_are_maximal(spark):
    text = " ".join(f"w{i}" for i in range(100))
    docs = spark.createDataFrame([(1, text), (2, f"x {text} y")], "doc_id long, text string")
    second = substring.remove_repeats(docs).where("doc_id = 2").first()
    assert [tuple(r) for r in second.runs] == [(1, 100)]
    assert second.kept == "x y"


def test_words_that_sum_alike(spark):
    """Long words whose polynomials agree modulo 2**64 are different words."""
    one, two = ("".join(x[bin(i).count("1") % 2] for i in range(2048)) for x in ("ab", "ba"))
    rows = [(1, " ".join([one] * 14)), (2, " ".join([two] * 14)), (3, " ".join([one] * 13))]
    assert run(spark, rows) == plain(rows)
