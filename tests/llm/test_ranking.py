import math
import random
import re

import duckdb
import numpy as np

from gaugeloom.llm import ranking, registry

TERM = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
CAPS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return TERM.findall((text or "").translate(CAPS))


def plain(docs, items, k):
    held = [(i, terms_of(t)) for i, t in docs]
    held = [(i, t) for i, t in held if t]
    n_docs, length = len(held), sum(len(t) for _, t in held)
    df = {}
    for _, t in held:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in dict.fromkeys(items):
        found = []
        for i, t in held:
            m = 50 + 50 * len(t) * n_docs // length
            score = 0
            for x in set(terms_of(text)) & set(t):
                tf = t.count(x)
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * (10**9 * tf // (1000 * tf + 20 * m))
            if score > 0:
                found.append((-score, i is None, i))
        found.sort(key=lambda f: (f[0], f[1], f[2] or 0))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(found[:k], start=1)]
    return sorted(out, key=str)


def run(spark, docs, items, k, **how):
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS term", "1 AS n", "2 AS id")
    q = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS terms", "1 AS rank")
    got = ranking.ranked(d, q, k, **how)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def corpus(seed, n=300):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Ünïcode", "ÀB", "x1"]
    weight = [1 / (i + 1) for i in range(len(words))]
    text = lambda a, b: rnd.choice([" ", ", ", "-"]).join(rnd.choices(words, weight, k=rnd.randrange(a, b)))
    docs = [(rnd.randrange(10**6), text(0, 80)) for _ in range(n)]
    docs += [(1, None), (2, ""), (None, text(5, 20)), (3, docs[0][1]), (4, docs[0][1]), docs[5], (5, "w1 " * 30_000), (6, "?! .")]
    items = [(i, text(1, 30)) for i in range(12)] + [(90, None), (91, ""), (92, "nowhere"), (0, "w5 w7"), (None, "w3 X1"), (3, "w0"), (3, "w0")]
    return docs, items


def test_against_plain(spark):
    docs, items = corpus(1)
    want = plain(docs, items, 7)
    assert run(spark, docs, items, 7) == want
    assert run(spark, docs, items, 7, shard=200, block=20) == want


def test_index_of_all_terms(spark, monkeypatch):
    docs, items = corpus(2, 80)
    monkeypatch.setattr(ranking, "VOCABULARY_BYTES", 10)
    assert run(spark, docs, items, 5) == plain(docs, items, 5)


def test_more_asked_for_than_there_are_and_ties(spark):
    docs = [(i, "same text") for i in range(20, 0, -1)] + [(i + 100, "filler") for i in range(30)]
    assert run(spark, docs, [(1, "same"), (2, "filler text")], 10) == plain(docs, [(1, "same"), (2, "filler text")], 10)
    assert run(spark, docs, [(1, "same")], 500) == plain(docs, [(1, "same")], 500)


def test_empty_tables(spark):
    docs, items = corpus(3, 10)
    assert run(spark, [], items, 3) == []
    assert run(spark, docs, [], 3) == []
    assert run(spark, [(1, None)], items, 3) == []


def test_stops_early_and_is_exact():
    """A rare term's list settles the best before the long lists have been read."""
    rng = np.random.default_rng(4)
    docs = 20_000
    term = np.concatenate([np.repeat(t, docs // (1 + 400 * (t == 2))) for t in range(3)])
    doc = np.concatenate([rng.permutation(docs)[: int((term == t).sum())] for t in range(3)])
    impact = np.where(term == 2, 5000, rng.zipf(1.6, len(term)).clip(1, 900))
    lists = ranking.Lists(term, doc, impact, 3, docs)
    score = np.bincount(doc, impact, docs).astype(np.int64)
    for k in (1, 10, 40):
        lists.read = 0
        got, value = lists.best(np.array([0, 1, 2]), k, 16)
        want = np.lexsort((np.arange(docs), -score))[:k]
        assert got.tolist() == want.tolist() and value.tolist() == score[want].tolist()
        assert lists.read < len(term) / 2


def test_text_in_slices():
    text = "Aa bb,cc é9 " * 50
    assert [t for s in ranking.slices(text.encode(), 7) for t in s.decode().split()] == terms_of(text)


def test_sql(spark, sf_dir="/root/testdata/sf0.001"):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    want = con.execute(registry.ORACLE["op13_ranking"]).fetchall()
    assert sorted(map(tuple, registry.op13_ranking(spark, sf_dir).collect())) == sorted(want)
