import math

import numpy as np
import pytest

from tillwatch.llm import cells, components, vector_dedup, vector_search
from tillwatch.llm.pstable import PStable, collision, units

SCHEMA = "vec_id bigint, embedding array<float>, label int, cell string, grp string"
NEAREST = "vec_id % 10 = 0"


def vectors():
    draw = np.random.default_rng(2)
    base = draw.normal(size=(120, 16)).astype(np.float32)
    rows = [(i, base[i].tolist(), i % 3) for i in range(120)]
    near = base[5] + draw.normal(scale=0.02, size=(40, 16)).astype(np.float32)
    rows += [(200 + i, near[i].tolist(), 2) for i in range(40)]
    rows += [(300 + i, base[7].tolist(), 1) for i in range(30)]
    rows += [(400, (2 * base[7]).tolist(), 1), (401, base[7].tolist(), None), (402, base[7].tolist(), 2)]
    rows += [(310, None, 1), (320, [0.0] * 16, 1), (330, [float("nan")] * 16, 1), (340, [float("inf")] + [1.0] * 15, 1),
             (350, [1.0, 2.0], 1), (None, base[7].tolist(), 1), (360, [1.0] * 15 + [None], 1)]
    return rows


def good(v):
    return v is not None and len(v) == 16 and all(x is not None and math.isfinite(x) for x in v) and any(v)


def cos(a, b):
    a, b = (np.array(x, np.float32).astype(float) for x in (a, b))
    return float((a * b).sum() / (math.sqrt((a * a).sum()) * math.sqrt((b * b).sum())))


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame([(*r, "x", "y") for r in vectors()], SCHEMA)


def test_nearest_like_brute_force(frame, monkeypatch):
    rows = [r for r in vectors() if r[0] is not None and good(r[1])]
    want = {}
    for i, v, _ in rows:
        if i % 10 == 0:
            want[i] = sorted((-cos(v, w), j) for j, w, _ in rows if j != i)[:5]
    for block in (4096, 5):
        monkeypatch.setattr(cells.search_cells, "__defaults__", (block,))
        got = {}
        for r in vector_search.nearest_neighbours(frame, NEAREST, vector_search.Search(recall=1.0)).collect():
            got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
        assert set(got) == set(want)
        hits = 0
        for q, near in want.items():
            assert sorted(got[q]) == [1, 2, 3, 4, 5]
            mine = [got[q][k] for k in (1, 2, 3, 4, 5)]
            assert mine == sorted(mine, key=lambda x: (-x[1], x[0]))
            for v, s in mine:
                assert abs(s - cos(dict((a, b) for a, b, _ in rows)[q], dict((a, b) for a, b, _ in rows)[v])) < 1e-12
            hits += len({v for v, _ in mine} & {v for _, v in near}) if q not in range(300, 330) else 5
        assert hits >= 0.95 * 5 * len(want)


def test_fewer_candidates_and_none(spark, frame):
    small = spark.createDataFrame([(0, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (1, [0.0, 1.0], 1), (50, [-1.0, 0.0], 2)],
                                  "vec_id bigint, embedding array<float>, label int")
    got = vector_search.nearest_neighbours(small, NEAREST).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 0.0), (0, 2, 50, -1.0), (50, 1, 1, 0.0), (50, 2, 0, -1.0)]
    assert vector_search.nearest_neighbours(frame.limit(0), NEAREST).count() == 0
    assert vector_search.nearest_neighbours(frame, "vec_id < 0").count() == 0


def mixed_lengths(spark, kind):
    draw = np.random.default_rng(9)
    rows = [(i, draw.normal(size=8 if i < 60 else 4).tolist(), 1) for i in range(111)]
    rows += [(200 + i, (np.array(rows[i][1]) * 1.7).tolist(), 1) for i in (0, 3, 60, 110)] + [(300, [5.0], 1), (350, [], 1)]
    return rows, spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>, label int")


@pytest.mark.parametrize("kind", ["float", "double"])
def test_each_length_is_a_space_of_its_own(spark, kind):
    """With the registered parameters: every length has results, scores are those of the original numbers."""
    rows, frame = mixed_lengths(spark, kind)
    if kind == "float":
        rows = [(i, np.array(v, np.float32).astype(float).tolist(), x) for i, v, x in rows]
    vec, got = {i: np.array(v) for i, v, _ in rows}, {}
    for r in vector_search.nearest_neighbours(frame, "vec_id % 50 = 0").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {0, 50, 100, 200}
    for q, found in got.items():
        near = sorted((-float(vec[q] @ v) / math.sqrt(float(vec[q] @ vec[q]) * float(v @ v)), i) for i, v in vec.items()
                      if i != q and len(v) == len(vec[q]))[:5]
        assert [k for k, _, _ in sorted(found)] == [1, 2, 3, 4, 5]
        assert all(abs(s + c) < 1e-14 for (_, _, s), (c, _) in zip(sorted(found), near))
        assert all(len(vec[v]) == len(vec[q]) for _, v, _ in found)
    links = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vector_dedup.near_vectors(frame).collect()}
    assert all(links[200 + i] == links[i] and links[i][0] >= 1 for i in (0, 3, 60, 110)) and links[300] == (0, 300) and links[350] == (0, 350)


def test_more_tables_or_a_scan_where_probes_do_not_reach(spark):
    draw = np.random.default_rng(1)
    rows = [(i, draw.normal(size=24).tolist(), 1) for i in range(400)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    vec, hits = np.array([v for _, v, _ in rows]), 0
    unit = vec / np.sqrt((vec * vec).sum(1))[:, None]
    for most in (1, 64):
        spec = vector_search.Search(tables=1, hashes=12, most_probes=3, most_tables=most)
        for r in vector_search.nearest_neighbours(frame, "vec_id % 50 = 0", spec).collect():
            near = np.argsort(-(unit[r["query_id"]] @ unit.T), kind="stable")[1:6]
            hits += r["vec_id"] in near
    assert hits >= 0.9 * 2 * 8 * 5


@pytest.mark.parametrize("kind, labels", [("double", (1.2, 1.2, 1.9)), ("string", ("a", "a", "b")), ("date", ("2024-01-01", "2024-01-01", "2024-01-02"))])
def test_labels_of_any_type(spark, kind, labels):
    rows = [(i, [1.0, 2.0, 3.0 + i / 1000], str(x)) for i, x in enumerate(labels)] + [(9, [1.0, 2.0, 3.0], None)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label string").selectExpr("vec_id", "embedding", f"CAST(label AS {kind}) AS label")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vector_dedup.near_vectors(frame).collect()}
    assert got == {0: (1, 0), 1: (1, 0), 2: (0, 2), 9: (0, 9)}


def test_links_like_brute_force(frame, monkeypatch):
    rows = vectors()
    n = len(rows)
    fit = [good(v) and i is not None and lab is not None for i, v, lab in rows]
    link = [[i != j and fit[i] and fit[j] and rows[i][2] == rows[j][2] and cos(rows[i][1], rows[j][1]) >= 0.93 for j in range(n)] for i in range(n)]
    reach = list(range(n))
    for _ in range(n):
        new = [min([reach[i]] + [reach[j] for j in range(n) if link[i][j]]) for i in range(n)]
        if new == reach:
            break
        reach = new
    least = {}
    for i, r in enumerate(reach):
        if rows[i][0] is not None:
            least[r] = min(least.get(r, rows[i][0]), rows[i][0])
    want = sorted((str(rows[i][0]), sum(link[i]), least.get(reach[i])) for i in range(n))
    for block in (4096, 4):
        monkeypatch.setattr(cells.search_cells, "__defaults__", (block,))
        monkeypatch.setattr(cells.pair_cells, "__defaults__", (block,))
        got = vector_dedup.near_vectors(frame).collect()
        assert sorted((str(r["vec_id"]), r["n_links"], r["component_id"]) for r in got) == want
        assert all(r["kept"] == (r["vec_id"] is not None and r["vec_id"] == r["component_id"]) for r in got)
    assert vector_dedup.near_vectors(frame.limit(0)).count() == 0


def test_collision_probability_matches_draws():
    draw = np.random.default_rng(1)
    a = units(draw.normal(size=(2000, 32)))
    b = units(a + draw.normal(scale=0.06, size=a.shape))
    index = PStable(32, 1, 1, 2.0)
    same = (index.buckets(a) == index.buckets(b)).mean()
    distance = float(np.sqrt(((a - b) ** 2).sum(1)).mean())
    assert abs(same - collision(distance, 2.0)) < 0.15


def test_probes_come_in_order_of_distance_to_walls():
    place = np.array([3.1, -2.4, 7.8])
    seen, last = [], -1.0
    for slot in PStable(3, 1, 3, 1.0).perturbed(place, 27):
        step = slot - np.floor(place)
        part = place - np.floor(place)
        cost = sum((p if s < 0 else 1 - p) ** 2 for s, p in zip(step, part) if s)
        assert cost >= last - 1e-12
        last = cost
        seen.append(tuple(step))
    assert len(set(seen)) == 27


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7), (None, 3), (1, 0), (1, 0)]
    got = {r["node"]: r["component"] for r in components.connected(spark.createDataFrame(chain, "x bigint, y bigint"), "x", "y").collect()}
    assert got == {**{i: 0 for i in range(41)}, 90: 90, 95: 90, 100: 90}
    assert components.connected(spark.createDataFrame([], "x bigint, y bigint"), "x", "y").count() == 0


def test_roots_and_small_pairs():
    assert cells.roots(6, np.array([5, 3, 1]), np.array([3, 1, 4])).tolist() == [0, 1, 2, 1, 1, 1]
    start, size = cells.runs(np.array([1, 1, 1, 2, 3, 3]))
    pairs = {(int(a), int(b)) for x, y in cells.small_pairs(start, size, 8) for a, b in zip(x, y)}
    assert pairs == {(0, 1), (0, 2), (1, 2), (4, 5)}
