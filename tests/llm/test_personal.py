import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from gaugeloom.llm import personal, registry

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(digits[::-1]):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def plain(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda: 13 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 9 <= len(digits) <= 15,
            }[kind]()
            if good:
                out.append((k, *m.span()))
    return out


def card(rnd):
    digits = "".join(rnd.choice("0123456789") for _ in range(rnd.randrange(12, 19)))
    return digits + next(d for d in "0123456789" if luhn(digits + d))


def piece(rnd):
    digits = lambda n: "".join(rnd.choice("0123456789") for _ in range(n))
    return rnd.choice([
        lambda: f"a.b{digits(2)}@mail.example.com", lambda: ".".join(str(rnd.randrange(300)) for _ in range(rnd.randrange(3, 7))),
        lambda: card(rnd), lambda: digits(16), lambda: "-".join(re.findall(".{1,4}", card(rnd))), lambda: f"+{digits(1)} ({digits(3)}) {digits(3)}-{digits(4)}",
        lambda: "é日 ", lambda: "word", lambda: "@", lambda: ".", lambda: "x@y", lambda: "+", lambda: "-", lambda: "0" * 5 + "1.2.3.4",
    ])()


def test_base_against_the_patterns():
    rnd = random.Random(1)
    for _ in range(4000):
        text = "".join(piece(rnd) + rnd.choice([" ", "", "", ", "]) for _ in range(rnd.randrange(9)))
        assert personal.base_spans(text) == plain(text), text
    for _ in range(4000):
        text = "".join(rnd.choice("0123456789@.-+( a%") for _ in range(rnd.randrange(40)))
        assert personal.base_spans(text) == plain(text), text


@pytest.mark.parametrize("text", ["a" * 300_000, "1" * 300_000, "@" * 300_000, "a@" * 150_000, "+1" * 150_000, "1." * 150_000, "1 " * 150_000, "a@b." * 75_000])
def test_base_in_linear_time(text):
    personal.base_spans(text)


def tiny(monkeypatch):
    monkeypatch.setattr(personal, "HIDDEN", 3)
    monkeypatch.setattr(personal, "EMBEDDING", 2)
    rng = np.random.default_rng(2)
    model = personal.fresh(rng)
    return rng, personal.Model(*[(p + rng.standard_normal(p.shape) * 0.3).astype(np.float64) for p in model])


def test_gradient_is_the_slope(monkeypatch):
    rng, model = tiny(monkeypatch)
    symbols = rng.integers(40, 60, (3, 7))
    symbols[1, 5:] = personal.PAD
    gold = np.stack([personal.labels_of(s, 7) for s in ([(0, 1, 4)], [(2, 0, 2), (3, 2, 3)], [(1, -2, 3)])])
    # A window that begins within a span has lost its first label, so that the sequence is allowed.
    _, slope = personal.gradient(model, symbols, gold)
    for j, (p, g) in enumerate(zip(model, slope, strict=True)):
        for at in itertools.islice((tuple(rng.integers(0, n) for n in p.shape) for _ in range(200)), 12):
            if j == 0:
                at = (int(symbols[0, at[0] % 7]), at[1])
            if j == 6 and not personal.ALLOWED[at] or j == 7 and not personal.ALLOWED[-1][at[0]]:
                continue
            moved = []
            for sign in (1, -1):
                changed = p.copy()
                changed[at] += sign * 1e-5
                moved.append(personal.gradient(model._replace(**{personal.Model._fields[j]: changed}), symbols, gold)[0])
            assert np.isclose((moved[0] - moved[1]) / 2e-5, g[at], rtol=2e-2, atol=2e-4), (personal.Model._fields[j], at)


def test_best_labels_and_chances_against_all_sequences(monkeypatch):
    rng, model = tiny(monkeypatch)
    steps = 4
    scores = rng.standard_normal((steps, 1, personal.LABELS)) * 2
    value = {}
    for path in itertools.product(range(personal.LABELS), repeat=steps):
        if personal.ALLOWED[-1][path[0]] and all(personal.ALLOWED[a][b] for a, b in itertools.pairwise(path)):
            value[path] = model.first[path[0]] + sum(model.change[a, b] for a, b in itertools.pairwise(path)) + sum(scores[t, 0, y] for t, y in enumerate(path))
    assert tuple(personal.best_labels(model, scores)[0].tolist()) == max(value, key=value.get)
    total = sum(np.exp(v) for v in value.values())
    assert np.isclose(personal._log_total(model, scores)[0], np.log(total))
    chance = personal._chain(model, scores)[0]
    for t in range(steps):
        for y in range(personal.LABELS):
            assert np.isclose(chance[t, 0, y], sum(np.exp(v) for p, v in value.items() if p[t] == y) / total)


def test_reconcile_against_all_subsets():
    rnd = random.Random(3)
    for _ in range(300):
        fixed = [(rnd.randrange(4), a, a + rnd.randrange(1, 8)) for a in rnd.sample(range(30), 2)]
        found = [(rnd.randrange(4), a := rnd.randrange(30), a + rnd.randrange(1, 9), rnd.choice([0.91, 0.95, 0.99])) for _ in range(6)]
        apart = lambda s, t: s[2] <= t[1] or t[2] <= s[1]
        free = [f for f in found if all(apart(f, x) for x in fixed)]
        most = max(
            sum(f[3] for f in some)
            for n in range(len(free) + 1)
            for some in itertools.combinations(free, n)
            if all(apart(a, b) for a, b in itertools.combinations(some, 2))
        )
        got = personal.reconcile(found, fixed)
        assert all(apart(a, b) for a, b in itertools.combinations([*got, *[]], 2)) and all(apart(a, b) for a in got for b in fixed)
        assert np.isclose(sum(max(f[3] for f in free if f[:3] == g) for g in got), most)


def written(rnd, respell):
    words = lambda n: " ".join(rnd.choice(["the", "caller", "wrote", "from", "élan", "to", "version 3.0", "on 2019-04-05", "in 1999,", "no. 12"]) for _ in range(n))
    rng = np.random.default_rng(rnd.randrange(10**6))
    text, spans = words(rnd.randrange(12)) + " ", []
    for _ in range(rnd.randrange(1, 3)):
        kind = rnd.randrange(4)
        own = [
            lambda: f"{rnd.choice(['anna', 'bo.li', 'carl'])}.{rnd.randrange(10, 99)}@mail{rnd.randrange(9)}.example.com",
            lambda: ".".join(str(rnd.randrange(1, 256)) for _ in range(4)),
            lambda: card(rnd),
            lambda: f"+{rnd.randrange(1, 9)} ({rnd.randrange(100, 999)}) 555-{rnd.randrange(1000, 9999)}",
        ][kind]()
        if respell:
            own = personal.respelled(kind, own, rng)
        spans.append((kind, len(text), len(text) + len(own)))
        text += own + " " + words(rnd.randrange(1, 12)) + " "
    return text, spans


@pytest.fixture(scope="module")
def model():
    rnd = random.Random(4)
    plainly = [written(rnd, False) for _ in range(450)]
    clean = [("the caller wrote from élan no. 12 on 2019-04-05, version 3.0 in 1999, to 4111", [])] * 40
    return personal.fit([(t, personal.base_spans(t)) for t, _ in plainly] + clean, epochs=10)


def test_finds_respelled_spans_it_has_not_seen(model):
    rnd = random.Random(5)
    held = [written(rnd, True) for _ in range(150)]
    texts = [t for t, _ in held]
    base = [personal.base_spans(t) for t in texts]
    added = personal.added_spans(model, texts, base)
    sought = [{s for s in spans if s not in b and personal.passes(s[0], t[s[1] : s[2]])} for (t, spans), b in zip(held, base, strict=True)]
    hits = sum(len(s & set(a)) for s, a in zip(sought, added, strict=True))
    assert hits / sum(map(len, sought)) > 0.6
    assert hits / max(sum(map(len, added)), 1) > 0.85
    quiet = ["the caller wrote from élan", "version 3.0 on 2019-04-05 in 1999, no. 12", "", "token b44e15e09fd311c"]
    assert personal.added_spans(model, quiet, [[]] * 4) == [[]] * 4


def test_windows_agree_wherever_a_span_lies(model):
    """A span is found whole at every place relative to the windows' borders, and only once."""
    own = "írma.12@mail3.example.com"
    alone = personal.added_spans(model, [f"the caller wrote {own} to the caller"], [[]])[0]
    assert alone == [(0, 17, 17 + len(own))]
    for shift in range(0, 300, 7):
        text = "the caller wrote from " * (shift // 22) + "x" * (shift % 22) + f" the caller wrote {own} to the caller " + "wrote from " * 30
        assert personal.added_spans(model, [text], [[]])[0] == [(0, text.index(own), text.index(own) + len(own))]


def run(spark, rows, model):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS kind", "1 AS start", "2 AS base")
    return sorted(((r.doc_id, [tuple(s) for s in r.base], [tuple(s) for s in r.added]) for r in personal.find(docs, model).collect()), key=str)


def test_rows(spark, model):
    rnd = random.Random(6)
    rows = [(i, written(rnd, i % 2)[0]) for i in range(40)]
    rows += [(None, rows[0][1]), (3, None), (4, ""), rows[5], (7, "mail a@b.example.com, " * 5000), (8, "é" * 1000 + "1.2.3.4"), (9, "😀 1.2.3.4")]
    got = run(spark, rows, model)
    want = sorted(((i, [(personal.KINDS[k], a, b) for k, a, b in plain(t)]) for i, t in rows), key=str)
    assert sorted(((i, b) for i, b, _ in got), key=str) == want
    assert [g[2] for g in run(spark, rows, None)] == [[]] * len(rows)
    assert run(spark, [], model) == []


def test_train(spark):
    docs = spark.createDataFrame([(1, "nothing here"), (2, None)], "doc_id long, text string")
    assert personal.train(docs) is None
    rnd = random.Random(7)
    docs = spark.createDataFrame([(i, written(rnd, False)[0]) for i in range(30)], "doc_id long, text string")
    assert isinstance(personal.train(docs, windows=20), personal.Model)


def test_query(spark, sf_dir="/root/testdata/sf0.001"):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = registry.op11_personal(spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        base = plain(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == n for k, _, _ in base) for n in range(4)]
        listed = [f"{personal.KINDS[k]}:{a}:{b}" for k, a, b in base]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(filter(None, r.spans.split(","))) and len(listed) + r.n_added == len(list(filter(None, r.spans.split(","))))
