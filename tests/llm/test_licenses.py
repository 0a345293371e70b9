import random
import re

import pytest

from gaugeloom.llm import licenses, registry

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\W_]+")


def shingles(words):
    return [tuple(words[i : i + 5]) for i in range(len(words) - 4)]


def alike(templates):
    """Groups of templates that share half of the shorter one's shingles, by number."""
    sets = [set(shingles(WORD.findall(t.lower()))) for _, t in templates]
    group = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(len(sets)):
            if len(sets[a] & sets[b]) >= 0.5 * min(len(sets[a]), len(sets[b])):
                one, other = sorted((group[a], group[b]))
                group = [one if g == other else g for g in group]
    return group


def plain(rows, templates=licenses.TEMPLATES, share=licenses.SHARE):
    out, group = set(), alike(templates)
    for i, text in dict.fromkeys(rows):
        words = WORD.findall((text or "").lower())
        found = []
        for k, (name, notice) in enumerate(templates):
            own = WORD.findall(notice.lower())
            sought, n, best = set(shingles(own)), len(own), None
            for w in range(0, len(words), n):
                inside = shingles(words[w : w + 2 * n])
                shared = len(sought & set(inside))
                if shared >= share * len(sought) and (best is None or shared > best[0]):
                    best = shared, w + next(p for p, s in enumerate(inside) if s in sought)
            if best:
                found.append((group[k], best[1], k, n, (i, k, name, best[0], len(sought), best[1])))
        reach, places = {}, {}
        for g, first, k, n, row in sorted(found):
            if first >= reach.get(g, (-1, -1))[0]:
                places[g] = places.get(g, 0) + 1
            reach[g] = (max(reach.get(g, (0, 0))[0], first + n), 0)
            places.setdefault((g, places[g]), []).append((-row[3] / row[4], -row[4], k, row))
        out |= {min(v)[3] for k, v in places.items() if isinstance(k, tuple)}
    return out


def run(spark, rows, *how):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS words", "1 AS row", "2 AS length")
    return [(r.doc_id, r.template, r.license, r.shared, r.of, r.first_word) for r in licenses.scan(docs, *how).collect()]


def test_given_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = [(r.doc_id, r.license, r.shared, r.of, r.first_word) for r in registry.op1_licenses(spark, SF).collect()]
    want = {(i, name, *rest) for i, _, name, *rest in plain(rows)}
    assert len(want) > 30 and set(got) == want


def test_odd_rows_and_damaged_notices(spark):
    rnd = random.Random(1)
    text = lambda n: " ".join(f"w{rnd.randrange(500)}" for _ in range(n))
    notices = [t for _, t in licenses.TEMPLATES]
    rows = [(i, f"{text(rnd.randrange(40))}, {rnd.choice(notices).upper()} {text(rnd.randrange(40))}") for i in range(60)]
    rows += [(100, notices[1].replace("copy", "kopie")), (101, " ".join(notices[1].split()[:12])), (102, f"{text(50000)} {notices[8]}")]
    rows += [(200 + 10 * i + j, f"{notices[i]} {text(3)} {notices[j]}") for i in range(len(notices)) for j in (7, 9)]
    rows += [(103, None), (104, ""), (105, "MIT"), (None, notices[0]), (106, "é\n".join(notices)), (107, f"{notices[0]} " * 4000)]
    got = run(spark, rows)
    assert len(got) == len(set(got)) and set(got) == plain(rows)
    assert sorted(run(spark, rows + rows[:9]), key=str) == sorted(got, key=str)
    assert run(spark, []) == [] and run(spark, rows, ()) == []
    with pytest.raises(ValueError):
        run(spark, rows, [("x", "too short")])


def test_several_passes(spark, monkeypatch):
    rows = [(i, t) for i, (_, t) in enumerate(licenses.TEMPLATES)]
    monkeypatch.setattr(licenses, "PASS_SHINGLES", 10)
    assert set(run(spark, rows)) == plain(rows)


@pytest.mark.parametrize("k", range(len(licenses.TEMPLATES)))
def test_versions_are_told_apart(k):
    """Every template is its own best match, also within a longer one's text."""
    (found,) = {r[2] for r in plain([(1, licenses.TEMPLATES[k][1])])}
    assert found == licenses.TEMPLATES[k][0]


def test_generic_and_versioned_headers(spark):
    named = dict(enumerate(licenses.TEMPLATES))
    rows = [(k, f"some words before it {t} and some behind") for k, (_, t) in named.items()]
    got = {}
    for i, _, name, *_ in run(spark, rows):
        got.setdefault(i, []).append(name)
    assert got == {k: [name] for k, (name, _) in named.items()}
