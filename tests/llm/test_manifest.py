"""The Merkle manifest against plain Python over the same rows."""

import hashlib
import zlib

import pytest
from hypothesis import given, settings, strategies as st

from shelfwise.llm import manifest

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, part int, idx int, key string, hash string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(r, text):
    return H(*[field(x) for x in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)])


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i:i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def path(tree, i):
    proof = []
    for level in tree[:-1]:
        run = range(i // 3 * 3, min(i // 3 * 3 + 3, len(level)))
        proof.append((i % 3, [level[j] for j in run if j != i]))
        i //= 3
    return proof


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels_of([leaf(r, r["text"]) for r in sorted(
        by[s], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))]) for s in sources}
    top = levels_of([trees[s][-1][0] for s in sources])
    out = []
    for s in sources:
        for i, r in enumerate(sorted(by[s], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))):
            steps = path(trees[s], i) + path(top, sources.index(s))
            even = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0
            text = r["text"].replace("\n", "") if even and r["text"] is not None else r["text"]
            folded = leaf(r, text)
            for at, others in steps:
                folded = H(*others[:at], folded, *others[at:])
            out.append((r["doc_id"], trees[s][0][i], trees[s][-1][0], top[-1][0],
                        [x for _, others in steps for x in others], folded, folded == top[-1][0]))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in manifest.proven(df).collect()), key=repr)


@pytest.fixture()
def small_parts(monkeypatch):
    """Trees over several rounds, partitions that cut runs."""
    monkeypatch.setattr(manifest, "DEPTH", 2)
    monkeypatch.setattr(manifest, "WIDTH", 9)
    monkeypatch.setattr(manifest, "LEAVES", 23)


def test_equals_plain_python(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert found(documents) == brute(documents.collect())


def test_a_source_over_many_partitions_and_rounds(spark, small_parts):
    rows = [(i, f"text {i}\nmore" if i % 3 else None, "en", ("hot", None, "ä", "z")[min(i % 7, 3)], i, 0, 0, "k", "h") for i in range(230)]
    df = spark.createDataFrame(rows, SCHEMA)
    expected = brute(df.collect())
    assert found(df) == expected
    assert {row[-1] for row in expected} == {True, False}


def test_odd_rows(spark, small_parts):
    same = (2, "a\nb", "en", "s", 3, 1, 2, "x", "y")
    rows = [same, same, (None, None, None, None, None, 0, 0, None, None), (None, "", "", "", 0, 0, 0, "", ""),
            (-9 * 10**18, "line\n" * 40_000, "en", "s", 1, 1, 1, "", ""), (9 * 10**18, "日本\n語", None, "s", None, 1, 1, "", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(df) == brute(df.collect())
    assert found(df.limit(0)) == []
    one = spark.createDataFrame(rows[3:4], SCHEMA)
    assert found(one) == brute(one.collect())
    assert found(one)[0][4] == []


def test_proofs_of_some_leaves_fetch_each_node_once(spark, small_parts):
    rows = [(i, str(i), "en", "s", 1, 0, 0, "", "") for i in range(100)]
    made = manifest.manifest(spark.createDataFrame(rows, SCHEMA))
    some = {r["doc_id"]: r for r in manifest.proofs(made, made.leaves.where("doc_id % 10 = 0")).collect()}
    every = {r["doc_id"]: r for r in manifest.proofs(made).collect()}
    assert some == {i: every[i] for i in range(0, 100, 10)}


@given(st.integers(1, 200), st.data())
@settings(max_examples=60, deadline=None)
def test_missing_nodes_are_enough_and_none_too_many(n, data):
    on = data.draw(st.sets(st.integers(0, n - 1), min_size=1))
    tree = levels_of([H(str(i)) for i in range(n)])
    asked = list(manifest.missing(on, n))
    assert len(asked) == len(set(asked))
    needed = {(level, j) for i in on for level, nodes in enumerate(tree[:-1])
              for j in range(i // 3 ** (level + 1) * 3, min(i // 3 ** (level + 1) * 3 + 3, len(nodes)))}
    derived = {(level, i // 3 ** level) for i in on for level in range(len(tree))}
    assert set(asked) == needed - derived
