import numpy as np
import pytest

from gaugeloom.llm import neighbours

SF = "/root/testdata/sf0.1"


def exact(ids, vectors, query_ids, k):
    out = {}
    place = {i: n for n, i in enumerate(ids)}
    for q in query_ids:
        score = vectors @ vectors[place[q]]
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def found(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


@pytest.mark.parametrize("block", [700, neighbours.BLOCK])
def test_recall_and_order(spark, block):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = found(neighbours.nearest(table, table.where("vec_id % 20 = 0"), 20, block).collect())
    rows = table.select("vec_id", "embedding").collect()
    ids = np.array([r.vec_id for r in rows])
    vectors = np.array([r.embedding for r in rows], dtype=np.float64)
    want = exact(ids, vectors, [i for i in ids if i % 20 == 0], 20)
    assert set(got) == set(want)
    right = 0
    for q, best in want.items():
        assert len(got[q]) == 20
        assert got[q] == sorted(got[q], key=lambda x: (-x[1], x[0]))
        right += len({i for i, _ in best} & {i for i, _ in got[q]})
    assert right / (20 * len(want)) >= 0.9


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS rank", "2.0 AS score", "3 AS b")


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, [-1.0, 5.0]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0])]
    rows += [(8, [None, 1.0]), (None, [1.0, 1.0]), (20, None)]
    table = frame(spark, rows)
    got = found(neighbours.nearest(table, table.where("vec_id % 20 = 0"), 20).collect())
    assert got == {0: [(1, 2.0), (2, 2.0), (3, -1.0)]}
    assert neighbours.nearest(frame(spark, []), frame(spark, []), 3).collect() == []
    assert neighbours.nearest(table, frame(spark, []), 3).collect() == []
    with pytest.raises(ValueError):
        neighbours.nearest(frame(spark, [(1, [1.0]), (2, [1.0, 2.0])]), table, 3)


def test_copies_are_all_found(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(300)] + [(1000 + i, [1.0] * 8) for i in range(200)]
    table = frame(spark, rows)
    got = found(neighbours.nearest(table, table.where("vec_id = 1000"), 20, block=100).collect())
    assert [i for i, s in got[1000] if abs(s - 8) < 1e-9] == list(range(1001, 1000 + 1 + sum(abs(s - 8) < 1e-9 for _, s in got[1000])))


@pytest.mark.parametrize("rows", [
    [[1e160, 0.0], [1e160, 1e160], [-3e159, 1.0]],
    [[1e-170, 1e-170], [2e-170, 0.0], [0.0, -1e-170]],
    [[5e-324, 0.0], [0.0, 5e-324], [5e-324, 5e-324]],
    [[1e308, -1e308], [1e308, 1e308], [1e-308, 1.0]],
    [[1e160, 0.0], [1e-170, 1e-170], [1.0, 1.0]],
    [[1.7e308] * 2] * 3,
])
def test_every_finite_vector_ends(spark, rows):
    table = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")
    got = found(neighbours.nearest(table, table, 5).collect())
    with np.errstate(over="ignore", invalid="ignore"):
        for q in range(3):
            score = [-np.inf if np.isnan(s) else float(s) for s in (np.array(rows) @ np.array(rows[q]))]
            assert [i for i, _ in got[q]] == sorted((i for i in range(3) if i != q), key=lambda i: (-score[i], i))


def test_few_are_verified():
    """In a block of many vectors less than a tenth is compared exactly, and nine of ten neighbours are found."""
    rng = np.random.default_rng(5)
    vectors = rng.standard_normal((neighbours.BLOCK, 64))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    whole = rng.standard_normal((100_000 - neighbours.BLOCK, 64))
    whole = np.concatenate([vectors, whole / np.linalg.norm(whole, axis=1, keepdims=True)])
    queries = vectors[:60]
    arrays, order, centres = neighbours.projected(vectors, queries, 1.0, neighbours.PROJECTIONS)
    enough = neighbours.enough_of(len(vectors), 13, 20)
    got = neighbours._candidates(arrays, order, centres, 1.0, enough, neighbours.THRESHOLD)
    assert np.mean([len(g) for g in got]) < 0.1 * len(vectors)
    best = np.argsort(-(queries @ whole.T), axis=1)[:, 1:21]
    right = [(set(b[b < len(vectors)].tolist()), set(g.tolist())) for b, g in zip(best, got, strict=True)]
    assert sum(len(b & g) for b, g in right) / sum(len(b) for b, _ in right) >= 0.9
