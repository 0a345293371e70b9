import random
import re

import pytest
import xxhash

from gaugeloom.llm import components, simhash

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def plain(text):
    words = WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    votes = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in votes) > len(votes))


def grouped(pairs_of, fps):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs_of:
        root[find(a)] = find(b)
    return {f: find(f) for f in fps}


def expected(rows):
    fps = {plain(t) for _, t in rows}
    near = [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 3]
    root = grouped(near, fps)
    least = {}
    for i, t in rows:
        r = root[plain(t)]
        if i is not None:
            least[r] = min(i, least.get(r, i))
    return sorted(((i, f"{plain(t):016x}", least.get(root[plain(t)])) for i, t in rows), key=str)


def run(spark, rows, **extra):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = simhash.near_duplicates(docs.selectExpr("*", "'x' AS fp", "1 AS key", "2 AS component_id"))
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_against_brute_force(spark):
    rnd = random.Random(3)
    vocabulary = [f"w{i}É" for i in range(40)]
    base = [[rnd.choice(vocabulary) for _ in range(120)] for _ in range(30)]
    rows = []
    for i in range(300):
        words = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 2])):
            words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
        rows.append((1000 - i, "\t ".join(words)))
    rows += [(5, None), (6, ""), (7, " \n"), (8, "One"), (9, "oNE"), (9, "oNE"), (None, "one"), (None, "solo text here now"), (3, "a b c d " * 9000)]
    assert run(spark, rows) == expected(rows)


def test_empty(spark):
    assert run(spark, []) == []


def test_crowded_meeting_place(spark):
    """Fingerprints that share a place but form two clouds, with blocks of few rows."""
    rnd = random.Random(5)
    fps = set()
    for centre in (0x1234_5678_9ABC_DEF0, 0x1234_5678_9ABC_0000):
        for _ in range(120):
            f = centre
            for _ in range(rnd.randrange(6)):
                f ^= 1 << rnd.randrange(32)
            fps.add(f)
    near = [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 3]
    want = grouped(near, fps)
    table = spark.createDataFrame([(f,) for f in fps], "fp long")
    for block in (8, 4096):
        got = [tuple(r) for r in simhash.links(table, block=block).distinct().collect()]
        assert all((a ^ b).bit_count() <= 3 for a, b in got)
        have = grouped(got, fps)
        assert len({(want[f], have[f]) for f in fps}) == len(set(want.values())) == len(set(have.values()))


def test_components_of_a_path_and_a_star(spark):
    rows = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 4)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 160)}


@pytest.mark.parametrize("bits", [-1, 4])
def test_bits_out_of_range(spark, bits):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), bits)
