"""Mixing against plain Python: targets of many sources, draws down a tree, and which words every slot takes."""

import functools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import mixing


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Sources at their cap drop out one round after the other; the rest shares what is left."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        factor = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if factor * weight[s] >= most * sizes[s]}
        if not full:
            return {**out, **{s: factor * weight[s] for s in open_}}
        out.update({s: float(most * sizes[s]) for s in full})
        left -= sum(most * sizes[s] for s in full)
        open_ -= full
    return out


@pytest.fixture
def small_ranges(monkeypatch):
    monkeypatch.setattr(mixing, "running", functools.partial(mixing.running, size=40))


def test_targets_of_many_sources(spark, small_ranges):
    rng = np.random.default_rng(3)
    sizes = {f"site{i:04}": int(n) for i, n in enumerate(rng.pareto(0.7, 500) * 100)}
    sizes[None] = 70
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    found = mixing.source_targets(rows).collect()
    expected = plain_targets(sizes)
    assert sorted(r["rank"] for r in found) == list(range(501))
    assert [r["source"] for r in sorted(found, key=lambda r: r["rank"])] == [*sorted(s for s in sizes if s), None]
    assert all(math.isclose(r["target"], expected[r["source"]], rel_tol=1e-9, abs_tol=1e-6) for r in found)


def test_running_sums_across_ranges(spark):
    rows = spark.range(500).select((F.col("id") * 7919 % 1009).alias("at"), (F.col("id") % 13).alias("n"), F.lit(1).alias("one"))
    found = sorted(map(tuple, mixing.running(rows, ["at"], "sums", size=30, before="n", place="one").collect()))
    held = 0
    for i, (_, n, _, before, place) in enumerate(found):
        assert (before, place) == (held, i)
        held += n


def test_draws_down_a_tree(spark):
    rng = np.random.default_rng(5)
    slots = {i * 3: int(n) for i, n in enumerate(rng.integers(1, 400, 300))}
    sources = spark.createDataFrame(list(slots.items()), "rank long, slots long")
    draws = mixing._draws(sources, 1000, 1, bits=3).toPandas()
    total = sum(slots.values())
    by_shard = draws.groupby("shard").n.sum()
    assert by_shard.tolist() == [1000] * (total // 1000) + [total % 1000]
    assert set(draws["rank"]) <= set(slots) and not draws.duplicated(["rank", "shard"]).any()
    drawn = draws.groupby("rank").n.sum().reindex(list(slots), fill_value=0).to_numpy()
    quota = np.array(list(slots.values()))
    # The draws' chi-square lies within six deviations of its mean.
    assert abs(((drawn - quota) ** 2 / quota).sum() - len(quota)) < 6 * math.sqrt(2 * len(quota))
    assert sorted(map(tuple, mixing._draws(sources, 1000, 1, bits=3).collect())) == sorted(draws.itertuples(index=False, name=None))


def test_every_slot_takes_its_block(spark, small_ranges):
    """One hot source, 60 small ones and sources without words: slots, blocks and pieces from the line of words."""
    rows = [(i, "w " * (1 + i * 37 % 190), "hot" if i % 3 == 0 else f"s{i % 61:02}") for i in range(400)]
    rows += [(1000, None, "empty"), (1001, "a b c", None), (1002, " ", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    block = 16
    placed, sources, pieces = mixing.mix(frame, block=block, shard=100)
    lines: dict[int, list] = {}
    for r in sorted(placed.where("size > 0").collect(), key=lambda r: (r["rank"], r["first"])):
        line = lines.setdefault(r["rank"], [])
        assert r["first"] == len(line)
        line += [(r["first"], i) for i in range(r["size"])]
    expected = []
    for r in sources.collect():
        line, goal = lines.get(r["rank"], []), math.floor(r["target"] + 0.5)
        assert len(line) == r["source_size"]
        if not line:
            continue
        blocks, (passes, rest) = -(-len(line) // block), divmod(goal, len(line))
        slots = passes * blocks + -(-rest // block)
        for k in range(slots):
            one = lambda x: np.array([x])
            b = int(mixing.permuted(one(k % blocks), one(blocks), one(r["rank"] * 16 + k // blocks))[0])
            words = rest % block if k == slots - 1 and rest % block else block
            expected += [(r["rank"], k, *w) for w in line[b * block:][:words]]
    found = pieces.collect()
    got = [(r["rank"], r["k"], r["first"], r["start"] + i) for r in found for i in range(r["length"])]
    assert sorted(got) == sorted(expected)
    # Every shard but the last is full.
    filled = {}
    for r in found:
        filled.setdefault(r["shard"], set()).add((r["rank"], r["k"]))
    assert all(len(filled[s]) == 100 for s in range(max(filled)))
