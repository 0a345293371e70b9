import numpy as np
import pytest

from gaugeloom.llm import language, registry
from gaugeloom.llm import words as wd

SF = "/root/testdata/sf0.1"


def slow(score, change):
    n = len(score)
    a, b = np.zeros_like(score), np.zeros_like(score)
    lse = lambda x, axis: np.log(np.exp(x - x.max()).sum(axis=axis)) + x.max()
    a[0] = score[0]
    for t in range(1, n):
        a[t] = [lse(a[t - 1] + change[:, j], None) + score[t, j] for j in range(score.shape[1])]
    for t in range(n - 2, -1, -1):
        b[t] = [lse(change[i] + score[t + 1] + b[t + 1], None) for i in range(score.shape[1])]
    p = np.exp(a + b - (a + b).max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def test_forward_backward_over_blocks():
    rng = np.random.default_rng(2)
    counts = [1, 0, 5, language.BLOCK, language.BLOCK + 1, 3 * language.BLOCK - 1, 0, 2]
    first = np.r_[0, np.cumsum(counts)]
    score, change = rng.normal(size=(first[-1], 3)) * 3, rng.normal(size=(3, 3))
    got = language.posteriors(score, first, change)
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b > a:
            assert np.allclose(got[a:b], slow(score[a:b], change), atol=1e-9)


def test_lower_case():
    text = "ÀÉÖØÞ×ßé AZ az [@"
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    assert language.lowered(data).tobytes().decode() == "àéöøþ×ßé az az [@"


def test_features_do_not_depend_on_neighbours():
    lexicon = np.sort(wd.hashes(wd.find_words([b"the of"])))
    alone = language.features(wd.find_words([b"the"]), lexicon)
    among = language.features(wd.find_words([b"x the", b"the"]), lexicon)
    for k in (1, 2):
        assert (among.affix[k] == alone.affix[0]).all()
        assert (among.gram[among.first[k] :][:3] == alone.gram).all()
        assert among.entry[k] == alone.entry[0] < 2


@pytest.fixture(scope="module")
def predicted(spark):
    return registry.op2_language(spark, SF).collect()


def test_held_out_accuracy(spark, predicted):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in predicted if r.held_out and r.lang_pred != "und"]
    assert len(held) > 3000
    assert sum(lang[r.doc_id] == r.lang_pred for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in predicted)
    assert len(predicted) == len(lang)


def test_code_switching_and_odd_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.train(docs)
    parts = {r.lang: " ".join(r.text.split()[:60]) for r in docs.where("n_chars > 600 and n_chars < 4000").orderBy("doc_id").limit(300).collect()}
    mixed = f"{parts['en']} {parts['fr']} {parts['de']}"
    texts = [mixed, None, "", " \n", "123 %%% 4.5", "×÷", "日本", "the " * 30000, "the"]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "the", None), (0, mixed, "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = {r.doc_id: r for r in language.identify(frame, model).collect()}
    runs = {}
    for run in got[0].runs:
        runs[run.lang] = runs.get(run.lang, 0) + run.words
    assert sum(runs.values()) == 180 and all(runs[x] >= 50 for x in ("en", "fr", "de"))
    assert [(got[i].lang_pred, got[i].score) for i in (1, 2, 3, 4, 5)] == [("und", 0.0)] * 5
    assert got[6].lang_pred in model.labels and got[7].lang_pred == got[8].lang_pred == got[None].lang_pred == "en"
    assert language.identify(frame.limit(0), model).count() == 0
    assert {r.lang_pred for r in language.identify(frame, None).collect()} == {"und"}
    assert language.train(docs.limit(0)) is None
