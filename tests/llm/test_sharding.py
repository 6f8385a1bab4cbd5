"""Rendezvous sharding against a plain version and against SQL."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import pytest
from conftest import SF
from fixtures import documents  # noqa: F401
from oracle import compare, connect

from tallycast.llm.sharding import OP12_SQL, op12_sharding, sharded

ODD = [(None, "a"), (None, "b"), (None, None), (1, None), (2, ""), (3, "ümlaut 中"), (3, "other"), (4, "x" * 200_000), (5, "same"), (5, "same"), (5, "same")]


def plain(key, weights):
    bids = []
    for i, w in enumerate(weights):
        digest = hashlib.sha256(f"{'' if key is None else key}:{i // 4}".encode()).hexdigest()
        u = (int(digest[13 * (i % 4) : 13 * (i % 4) + 13], 16) + 0.5) / 16.0**13
        bids.append((-math.log(u) / w if w else math.inf, i))
    return min(bids)[1]


@pytest.mark.parametrize("weights", [[1.0] * 24, [1.0, 2.0, 0.0, 0.5], [3.0]])
def test_against_plain(documents, weights):
    rows = ODD + [(i, f"text {i}") for i in range(10, 400)] + [(6, "hot")] * 200
    got = [tuple(r) for r in sharded(documents(rows), weights).collect()]
    want = Counter()
    for i, t in rows:
        raw = (t or "").encode()
        want[(i, len(raw) + 8, zlib.crc32(raw), "key", plain(i, weights), plain(i, [*weights, 1.0]))] += 1
    assert Counter(r[:5] + r[6:] for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r[4]].append(r[5])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_one_more_shard_takes_rows_only_into_itself(documents):
    rows = [(i, "x") for i in range(3000)]
    got = sharded(documents(rows), [1.0] * 5).collect()
    assert all(r.grown_shard in (r.shard, 5) for r in got)
    assert 400 < sum(r.grown_shard == 5 for r in got) < 600
    heavy = Counter(r.shard for r in sharded(documents(rows), [1.0, 3.0], grown=None).collect())
    assert 2100 < heavy[1] < 2400


def test_places_do_not_depend_on_partitions(documents):
    rows = documents(ODD + [(i, "y") for i in range(300)])
    first, second = (sorted(map(tuple, sharded(df, [1.0] * 3).collect()), key=repr) for df in (rows, rows.repartition(13)))
    assert first == second


def test_empty_and_wrong_weights(documents):
    assert sharded(documents([]), [1.0]).collect() == []
    for weights in ([], [0.0], [1.0, -1.0]):
        with pytest.raises(ValueError):
            sharded(documents([]), weights)


def test_against_sql(spark):
    df = op12_sharding(spark, SF)
    assert compare(df, connect(SF), OP12_SQL) == []
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
