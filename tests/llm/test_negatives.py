"""Hard negatives against plain Python over all pairs, and bounds against scores."""

import math
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from shelfwise.llm import negatives

FOLDER = "/root/testdata/sf0.1"
SCHEMA = "vec_id long, embedding array<float>, label int, number string, values int, rank int"
LIMIT = 2**63 - 1


def brute(rows):
    whole = lambda v: [math.floor(256 * Fraction(x)) for x in v]
    good = [(r["vec_id"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"], whole(r["embedding"]))
            for r in rows if r["vec_id"] is not None and r["label"] is not None and r["embedding"] is not None
            and all(x is not None and math.isfinite(x) for x in r["embedding"])]
    out = []
    for a, label, v in good:
        if a % 50:
            continue
        scored = sorted(((-sum(map(int.__mul__, v, w)), i, l) for i, l, w in good if i != a and len(w) == len(v)))
        for p, pid, _ in [s for s in scored if s[2] == label][:5]:
            inside = [(n, i) for n, i, l in scored if l != label and 50 * -p <= 100 * -n <= 95 * -p][:3]
            out += [(a, pid, rank, i, *[max(min(-s, LIMIT), -LIMIT - 1) for s in (p, n)]) for rank, (n, i) in enumerate(inside, 1)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in negatives.hard_negatives(df).collect())


@pytest.fixture()
def small(monkeypatch):
    for name, value in (("BLOCK", 16), ("BATCH", 4), ("GROUP", 3)):
        monkeypatch.setattr(negatives, name, value)


def test_equals_all_pairs(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    expected = brute(table.collect())
    assert found(table) == expected and expected


def clustered(seed, n, width=6):
    pick = np.random.default_rng(seed)
    centres = pick.standard_normal((4, width))
    return [(int(i), [float(x) for x in (centres[i % 4] + 0.2 * pick.standard_normal(width)).astype("f4")], int(pick.integers(0, 3)))
            for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "n", 1, 2) for r in rows], SCHEMA)


def test_small_blocks_and_a_label_with_most_rows(spark, small):
    rows = [(i, v, 0 if i % 10 else l) for i, v, l in clustered(1, 300)]
    df = frame(spark, rows)
    assert found(df) == brute(df.collect()) != []


def test_odd_rows(spark, small):
    nan, inf = float("nan"), float("inf")
    plain = clustered(2, 120, 3)
    odd = [(None, [1.0, 1.0, 1.0], 1), (200, None, 1), (250, [1.0, 2.0, 3.0], None), (300, [1.0, None, 1.0], 1),
           (350, [1.0, nan, 1.0], 1), (400, [1.0, inf, 1.0], 2), (450, [], 1), (500, [], 2), (550, [0.0, 0.0, 0.0], 1),
           (600, [1.0, 2.0], 1), (601, [1.0, 2.0], 1), (602, [1.0, 1.0], 2), (50, plain[50][1], plain[50][2]), (50, [3.0, 1.0, 2.0], 2),
           (-50, [1.0, 1.0, 1.0], 2), (700, [1.5, 1.0, 1.0], 0), (701, [1.5, 1.0, 1.0], 0), (702, [1.5, 1.0, 1.0], 0)]
    df = frame(spark, plain + odd)
    assert found(df) == brute(df.collect()) != []
    assert found(df.limit(0)) == []
    assert found(df.where("vec_id = 700")) == []


def test_large_components(spark, small):
    rows = [(i, [float(np.float32(x * 10.0 ** (i % 5 * 4))) for x in v], l) for i, v, l in clustered(3, 160, 3)]
    rows += [(1000, [3e38, 1.0, 1.0], 1), (1001, [1e-30, 1.0, 1.0], 1), (1002, [1e-37, 0.7, 0.7], 2)]
    df = frame(spark, rows)
    within = lambda out: [r for r in out if r[0] != 1000]
    assert within(found(df)) == within(brute(df.collect())) != []


def side(values, labels=None):
    values = np.array(values, float).reshape(len(values), -1)
    n = len(values)
    directions = negatives._directions({}, values.shape[1])
    units, norms = negatives._units(negatives.whole(values))
    return negatives.Packed({
        "rows": n, "width": values.shape[1], "numbers": np.arange(n).tobytes(), "ids": np.arange(n).tobytes(),
        "labels": np.zeros(n, np.int64).tobytes(), "values": values.tobytes(), "norms": norms.tobytes(),
        "angles": negatives._angles(units, directions).astype("<f4").tobytes()})


NUMBER = st.floats(-1e6, 1e6, width=32)


@given(st.lists(st.tuples(NUMBER, NUMBER, NUMBER), min_size=1, max_size=12))
@settings(max_examples=200, deadline=None)
def test_scores_lie_within_their_bounds(vectors):
    both = side(vectors + [tuple(-x for x in v) for v in vectors] + [(0.0, 0.0, 0.0)])
    low, high = negatives.bounds(both, both)
    for q in range(len(both.ids)):
        exact = negatives.scores(both, q, both, np.arange(len(both.ids)))
        assert all(a <= s <= b for a, s, b in zip(low[q], exact, high[q]))


def test_few_rows_of_clusters_are_scored(monkeypatch):
    """Beside a reference, the interval is narrow: rows of other clusters are never scored."""
    pick = np.random.default_rng(5)
    centres = np.eye(8)[:4]
    values = np.concatenate([c + 0.01 * pick.standard_normal((50, 8)) for c in centres])
    monkeypatch.setattr(negatives, "_directions", lambda refs, width: centres)
    both, seen = side(values), []
    scored = negatives.scores
    monkeypatch.setattr(negatives, "scores", lambda a, q, b, at: seen.append(len(at)) or scored(a, q, b, at))
    list(negatives.positives_of(both, both, 5))
    assert sum(seen) < 0.3 * len(values) ** 2


def test_a_batch_is_scored_by_one_product(monkeypatch):
    """Rows are not scored again for every positive; the result is that of scoring them one by one."""
    pick = np.random.default_rng(6)
    both = side(pick.integers(-3, 4, (90, 4)) / 4)
    both.ids, both.labels = pick.permutation(90) // 2, pick.integers(0, 3, 90)  # ids that repeat, scores that tie
    asked = [[int(v) for v in pick.integers(-40000, 120000, pick.integers(0, 6))] for _ in range(90)]
    plain = lambda found: sorted((int(q), int(j), int(both.ids[i]), int(s)) for f in found for q, j, i, s in zip(*f))
    expected = plain(negatives._row_by_row(both, asked, both, 3))
    assert len(expected) > 100
    monkeypatch.setattr(negatives, "scores", None)
    assert plain(negatives.negatives_of(both, asked, both, 3)) == expected
    assert plain(negatives.negatives_of(both, [[] for _ in asked], both, 3)) == []
