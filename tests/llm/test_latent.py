import random

import numpy as np

from gaugeloom.llm import latent, registry

SF = "/root/testdata/sf0.1"


def lcs(x, y):
    row = [0] * (len(y) + 1)
    for a in x:
        last = 0
        for j, b in enumerate(y):
            last, row[j + 1] = row[j + 1], last + 1 if a == b else max(row[j + 1], row[j])
    return row[-1]


def test_common_length():
    rnd = random.Random(1)
    for _ in range(300):
        x = [rnd.randrange(4) for _ in range(rnd.randrange(1, 90))]
        y = [rnd.randrange(4) for _ in range(rnd.randrange(60))]
        assert latent.common_length(x, y) == lcs(x, y)


def test_directions_match_an_exact_svd(spark):
    rnd = random.Random(2)
    texts = [(i, " ".join(f"w{rnd.randrange(60)}" for _ in range(rnd.randrange(1, 40))), None) for i in range(50)]
    table = spark.createDataFrame(texts, "item_id long, text string, answer string").repartition(3)
    _, h, first = latent._items(table)
    vocabulary = np.unique(h)
    weight = np.linspace(0.5, 2, len(vocabulary))
    rows = []
    for _, a, b in latent._passages(h, first):
        times = np.bincount(np.searchsorted(vocabulary, h[a:b]), minlength=len(vocabulary))
        row = np.where(times > 0, 1 + np.log(np.maximum(times, 1)), 0) * weight
        rows.append(row / np.linalg.norm(row))
    _, value, exact = np.linalg.svd(np.array(rows))
    got = latent.directions(table, vocabulary, weight, rank=len(vocabulary))
    kept = exact[: (value > 1e-4).sum()]
    assert np.allclose(kept.T @ kept, got @ got.T, atol=1e-3)


def test_every_planted_passage_is_found(spark):
    docs = {r.doc_id: " ".join(r.text.split()) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = {r.item_id: " ".join(r.text.split()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    want = {(d, i) for i, x in items.items() for d, t in docs.items() if x in t}
    got = {(r.doc_id, r.item_id): r.share for r in registry.op7_latent(spark, SF).collect()}
    assert len(want) > 50
    assert want <= set(got)
    for (d, i), share in got.items():
        assert share >= latent.WITH_ANSWER
        if (d, i) not in want:  # what else is found really has most of the item in order
            assert lcs(items[i].lower().split(), docs[d].lower().split()) >= 0.5 * len(items[i].split())
    assert len(got) < 1.3 * len(want)


def test_odd_rows_and_paraphrase(spark):
    rnd = random.Random(3)
    vocabulary = [f"word{i}" for i in range(3000)]
    text = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    items = [(i, text(30), None) for i in range(40)] + [(50, None, None), (51, "", None), (52, "...", None), (1, None, "x")]
    words = items[7][1].split()
    loose = [w for k, w in enumerate(words) if k % 4 or k > 20]
    rows = [(i, text(300)) for i in range(200)]
    rows += [(900, f"{text(150)} {items[3][1].upper()}! {text(90)}"), (901, " ".join([text(40), *loose, text(40)])), (902, " ".join([text(40), *words[:12], text(40)]))]
    rows += [(None, items[4][1]), (903, None), (904, ""), (905, f"{text(60000)} {items[5][1]}"), (906, items[6][1]), (906, items[6][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS share", "'x' AS item_id")
    bench = spark.createDataFrame(items, "item_id long, text string, answer string").selectExpr("*", "2 AS doc_id")
    for size in (latent.ITEMS, 15):
        got = sorted((r.doc_id or 0, r.item_id) for r in latent.contaminated(docs, bench, items=size).collect())
        assert got == [(0, 4), (900, 3), (901, 7), (905, 5), (906, 6), (906, 6)]
    assert latent.contaminated(docs.limit(0), bench).count() == 0
    assert latent.contaminated(docs, bench.limit(0)).count() == 0


def planted(spark, count, length, size):
    """Pairs found and expected when every item stands verbatim in a document of its own."""
    rnd = random.Random(count + length)
    text = lambda n: " ".join(f"w{min(rnd.randrange(8000), rnd.randrange(8000))}" for _ in range(n))
    items = [(i, text(rnd.randrange(length // 2, length)), None) for i in range(count)]
    docs = [(i, f"{text(rnd.randrange(100))} {x} {text(rnd.randrange(100))}") for i, x, _ in items]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    found = latent.contaminated(docs, spark.createDataFrame(items, "item_id long, text string, answer string"), items=size).collect()
    return sorted((r.doc_id, r.item_id) for r in found), [(i, i) for i in range(count)]


def test_many_items_are_all_found(spark):
    for count in (500, 1000):  # more passages than directions
        got, want = planted(spark, count, 60, latent.ITEMS)
        assert got == want


def test_long_items_are_all_found(spark):
    for count, length, size in ((20, 800, latent.ITEMS), (2, 15000, latent.ITEMS), (6, 1200, 3)):
        got, want = planted(spark, count, length, size)
        assert got == want


def test_blocks_hold_every_passage_once():
    counts = [1, 16, 17, 32, 33, 48, 49, 700, 5, 0 + 6000]
    first = np.r_[0, np.cumsum(counts)]
    for rank in (1, 3, 10, 384):
        blocks = latent.blocks_of(first, rank)
        got = []
        for block in blocks:
            own = [(k, a + lo, a + hi) for k, a, b in block for _, lo, hi in latent._passages(np.zeros(b - a), np.array([0, b - a]))]
            assert 0 < len(own) <= rank
            got += own
        assert got == [(k, a - first[k], b - first[k]) for k, a, b in latent._passages(np.zeros(first[-1]), first)]
