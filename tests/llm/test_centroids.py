"""Centroid clustering against a plain version and against SQL."""

import hashlib
import random

import pytest
from conftest import SF
from oracle import compare, connect

from tallycast.llm.centroids import OP11_SQL, clustered, integers, nearest, op11_centroids, with_inertia

ROWS = "vec_id long, embedding array<float>, cluster int, distance string, v int, inertia long, label int"


def plain(rows, k, rounds, size, scale=256, seed=2):
    def fine(v):
        return v is not None and len(v) == size and all(x is not None and x == x and abs(x) != float("inf") for x in v)

    kept = [(i, tuple(int(scale * x // 1) for x in v)) for i, v in rows if fine(v)]
    starts = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    c = [v for _, v in starts]

    def near(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, m)), j) for j, m in enumerate(c))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        c = [tuple(sum(x) // len(groups[j]) for x in zip(*groups[j])) if j in groups else m for j, m in enumerate(c)]
    out = [(i, *reversed(near(v))) for i, v in kept] if c else []
    total = sum(r[2] for r in out)
    per = {j: sum(r[2] for r in out if r[1] == j) for j in range(len(c))}
    return sorted(((i, j, d, per[j], total, hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest()) for i, j, d in out), key=repr)


@pytest.fixture
def vectors(spark):
    return lambda rows: spark.createDataFrame([(i, v, 9, "x", 1, 5, 0) for i, v in rows], ROWS)


def test_against_plain(vectors):
    r = random.Random(4)
    rows = [(i, [r.choice([-0.5, 0.25, 1.0, 0.1]) * (i % 3 - 1) for _ in range(4)]) for i in range(120)]
    rows += [(7, rows[7][1])] * 60  # one vector holds a third of all rows
    rows += [(None, [0.5] * 4), (200, None), (201, [1.0] * 3), (202, [1.0, None, 1.0, 1.0]), (203, [float("nan")] * 4), (204, [float("inf")] * 4), (205, [])]
    got = with_inertia(*clustered(vectors(rows), k=6, rounds=3, size=4))
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows, 6, 3, 4)


def test_few_and_none(vectors):
    assert with_inertia(*clustered(vectors([]), k=3, size=2)).collect() == []
    assert with_inertia(*clustered(vectors([(None, [1.0, 1.0])]), k=3, size=2)).collect() == []
    rows = [(1, [0.5, -0.5]), (1, [0.25, 0.0]), (2, [0.5, -0.5])]
    assert sorted(map(tuple, with_inertia(*clustered(vectors(rows), k=9, rounds=2, size=2)).collect()), key=repr) == plain(rows, 9, 2, 2)


def test_ties_go_to_the_smaller_number(spark):
    df = spark.sql("select array(0L, 0L) v")
    assert tuple(df.select(nearest(df.v, [[3, 4], [5, 0], [4, 3]]).alias("n")).collect()[0].n) == (25, 0)


def test_too_large_a_component_stops_the_job(spark):
    df = spark.sql("select array(1e30F) v")
    with pytest.raises(Exception, match="too large"):
        df.select(integers(df.v)).collect()


def test_against_sql(spark):
    assert compare(op11_centroids(spark, SF), connect(SF), OP11_SQL) == []


def test_no_python_worker(spark):
    plan = op11_centroids(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
