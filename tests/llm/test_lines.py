import random
import re

from gaugeloom.llm import lines

WORD = re.compile("[^\\x20\\x09-\\x0D]+")


def within_one(x, y):
    if len(x) > len(y):
        x, y = y, x
    if len(y) - len(x) > 1:
        return False
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y, strict=True)) <= 1
    return any(y[:k] + y[k + 1 :] == x for k in range(len(y)))


def plain(spark, rows, min_words):
    keyed = spark.createDataFrame(list(dict.fromkeys(rows)), "doc_id long, text string").selectExpr("doc_id", "coalesce(text, '') text", "xxhash64(coalesce(text, '')) k")
    docs = {(r.doc_id, r.k): r.text for r in keyed.collect()}
    earlier, out = [], []
    for (i, k), text in sorted(docs.items(), key=lambda d: (d[0][0] is not None, d[0])if d[0][0] is not None else (False, (0, d[0][1]))):
        parts = text.split("\n")
        if i is None:
            out.append((i, k, text, len(parts), 0))
            continue
        kept = []
        for line in parts:
            w = WORD.findall(line)
            near = [e for e in earlier if e == w or (min(len(e), len(w)) >= min_words and within_one(e, w))]
            if not w or not near:
                kept.append(line)
            if w:
                earlier.append(w)
        out.append((i, k, "\n".join(kept), len(parts), len(parts) - len(kept)))
    return sorted(out, key=str)


def run(spark, rows, min_words):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS words", "1 AS h1", "2 AS gone", "3 AS rest", "4 AS n_left")
    got = lines.dedupe_lines(docs, min_words).collect()
    for r in got:
        assert r.n_left == sum(bool(WORD.search(x)) for x in r.text.split("\n"))
    assert len(got) == len(rows) and all((r.words, r.h1, r.gone, r.rest) == ("x", 1, 2, 3) for r in got)
    return sorted({(r.doc_id, r.text_key, r.text, r.n_lines, r.n_removed) for r in got}, key=str)


def test_against_brute_force(spark):
    rnd = random.Random(7)
    vocabulary = ["a", "b", "É", "dd", "e,"]
    base = [[rnd.choice(vocabulary) for _ in range(rnd.randrange(1, 12))] for _ in range(40)]
    rows = []
    for i in range(120):
        text = []
        for _ in range(rnd.randrange(6)):
            w = list(rnd.choice(base))
            for _ in range(rnd.randrange(3)):
                at = rnd.randrange(len(w))
                kind = rnd.randrange(3)
                if kind == 0:
                    w[at] = rnd.choice(vocabulary)
                elif kind == 1:
                    w.insert(at, rnd.choice(vocabulary))
                elif len(w) > 1:
                    del w[at]
            text.append(rnd.choice(["", " ", "\t"]) + rnd.choice([" ", "  ", "\u000b"]).join(w) + rnd.choice(["", "\r"]))
        rows.append((rnd.randrange(90), "\n".join(text)))
    rows += rows[:9] + [(None, "a b\na b"), (None, None), (3, None), (4, ""), (5, "\n\n"), (91, "a " * 4000), (92, "b " + "a " * 3999), (93, "a " * 4001)]
    for min_words in (4, 8):
        assert run(spark, rows, min_words) == plain(spark, rows, min_words)


def test_empty(spark):
    assert run(spark, [], 8) == []


def test_one_place_many_lines(spark):
    rows = [(i, f"page {i} of the report of the year nineteen ninety") for i in range(400)]
    got = run(spark, rows, 8)
    assert sum(r[4] for r in got) == 399
    assert next(r for r in got if r[0] == 0)[4] == 0
