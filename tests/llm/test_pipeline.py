"""Every stage of the corpus pipeline against a plain version, on odd rows."""

import random

import corpus_pipeline as pipeline
import pytest

from gaugeloom.llm import language, latent, lines, simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def texts(seed, n):
    rnd = random.Random(seed)
    words = {"en": ["the", "of", "and", "with", "thing", "over", "this"], "de": ["der", "und", "nicht", "über", "werden", "sich", "mit"]}
    for _ in range(n):
        lang = rnd.choice(["en", "de"])
        yield lang, "\n".join(" ".join(rnd.choice(words[lang]) + str(rnd.choice("abcdefgh") * rnd.randrange(4)) for _ in range(rnd.randrange(9, 20))) for _ in range(rnd.randrange(1, 5)))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], SCHEMA)


def rows_of(seed=1, n=60):
    rows = [(i, t, lang) for i, (lang, t) in enumerate(texts(seed, n))]
    return rows + [(None, rows[0][1], "en"), (3, rows[40][1], "en"), (500, rows[5][1], "en"), (501, None, None), (502, "", "en"), (503, "12 34", "de"), rows[7]]


def ids(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_stages_keep_the_columns(spark, sf_dir="/root/testdata/sf0.001"):
    docs = frame(spark, rows_of())
    for _, stage in pipeline.STAGES[:-1]:
        got = stage(spark, docs, sf_dir)
        assert got.columns == docs.columns
        assert stage(spark, docs.limit(0), sf_dir).count() == 0
    assert pipeline.STAGES[-1][1](spark, docs.limit(0), sf_dir).count() == 0


def test_language_id(spark):
    docs = frame(spark, rows_of())
    told = language.identify(docs, language.train(docs.where(~pipeline.registry.held_out())))
    want = sorted(((r.doc_id, r.text) for r in told.collect() if r.lang_pred != "und" and r.score >= pipeline.LEAST_SCORE), key=str)
    got = ids(pipeline.language_id(spark, docs, ""))
    assert got == want and len(got) >= 58 and not {501, 502, 503} & {i for i, _ in got}
    assert pipeline.language_id(spark, docs.where("lang IS NULL"), "").count() == 1  # nothing to learn from


def test_line_dedup(spark):
    docs = frame(spark, rows_of(2))
    got = {(r.doc_id, r.text) for r in pipeline.line_dedup(spark, docs, "").collect()}
    want = {(r.doc_id, r.text) for r in lines.dedupe_lines(docs).collect() if r.doc_id is None or r.n_left > 0 or r.n_removed == 0}
    assert got == want and 500 not in {i for i, _ in got}
    for r in pipeline.line_dedup(spark, docs, "").collect():
        assert r.n_chars == len(r.text or "") or r.text is None


def test_simhash_dedup(spark):
    rows = rows_of(3)
    near = [(f, rows[i]) for i, f in enumerate(simhash.fingerprint((t or "").encode()) for _, t, _ in rows)]
    group = list(range(len(rows)))
    for a, (f, (i, *_)) in enumerate(near):
        for b, (g, (j, *_)) in enumerate(near[:a]):
            if i is not None and j is not None and (f ^ g).bit_count() <= simhash.BITS:
                one, other = sorted((group[a], group[b]))
                group = [one if x == other else x for x in group]
    least = {}
    for g, (i, t, _) in zip(group, rows, strict=True):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    got = pipeline.simhash_dedup(spark, frame(spark, rows), "").collect()
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == sorted(least.values())
    assert [r.text for r in got if r.doc_id is None] == [rows[0][1]]
    assert {r.text for r in got if r.doc_id == 3} == {rows[3][1], rows[40][1]}  # the second stands for row 40
    again = ids(pipeline.simhash_dedup(spark, frame(spark, rows).repartition(7), ""))
    assert again == ids(pipeline.simhash_dedup(spark, frame(spark, rows[::-1]), ""))


def test_rows_of_one_number_are_judged_singly(spark):
    one, two, three = (t for _, t in texts(9, 3))
    got = ids(pipeline.simhash_dedup(spark, frame(spark, [(1, one, "en"), (1, two, "en"), (2, three, "en"), (4, two, "en")]), ""))
    assert got == sorted([(1, one), (1, two), (2, three)], key=str)


def test_decontamination(spark, sf_dir="/root/testdata/sf0.01"):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").limit(3).collect()
    rows = rows_of(4)
    bad = [(700 + k, f"{rows[k][1]} {r.text} {rows[k + 1][1]}", "en") for k, r in enumerate(items)]
    docs = frame(spark, [*rows, *bad, (0, bad[0][1], "en"), (None, bad[1][1], "en")])
    got = ids(pipeline.decontamination(spark, docs, sf_dir))
    assert got == sorted(((i, t) for i, t, _ in rows), key=str)
    assert latent.contaminated(frame(spark, rows), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).count() == 0


def test_packing(spark):
    rows = rows_of(5)
    pieces = pipeline.packing(spark, frame(spark, rows), "").collect()
    assert sum(p.length for p in pieces) == sum(p.doc_tokens for p in pieces if p.start == 0)
    assert sorted(p.doc_id for p in pieces if p.start == 0 and p.doc_id is not None) == sorted(i for i, *_ in rows if i is not None)


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001"])
def test_run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pieces = pipeline.run(spark, sf_dir).collect()
    kept = {p.doc_id for p in pieces}
    assert kept < {r.doc_id for r in docs.select("doc_id").collect()} and len(kept) > 0.5 * docs.count()
    leaks = {r.doc_id for r in latent.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect()}
    assert not kept & leaks
