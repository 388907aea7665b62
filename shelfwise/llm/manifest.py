"""A Merkle manifest of documents, and proofs for many leaves at once.

Every row is a leaf: the SHA-256 of its five fields, each with its length. The leaves of a source, in the
order of ``doc_id``, make a tree of fan-out 3; the subroots, in the order of the sources, make the
tree above. Digests are hexadecimal text, and a node is the digest of its children's texts in a row.

Proofs are made as an octopus: a partition of leaves works out which nodes of all its paths neither it holds nor
can derive, each coordinate once, fetches those from the node table in one join, derives the interiors
that its paths share, and writes each leaf's own proof from them.

Order among rows is found without gathering a source: rows are dealt by ranges, sorted where they are,
and numbered from the sizes of the ranges before them. Trees are built in subtrees of ``3 ** DEPTH`` nodes,
one task for each, so a source with a third of all rows is many tasks.

Null fields count as ``-``. Repeated ids are leaves of their own, in the order of their digests; null ids come
first. A null source is a source, before all others. An empty table has no leaves, no nodes and no proofs. Other
columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.llm.common import stored

FANOUT = 3
DEPTH = 7         # levels that one task builds
LEAVES = 20_000   # of a partition, about
TOP = ""          # key of the tree over the subroots; sources' own keys are never empty
NODE = "key string, level int, idx long, n long, hash string"
WIDTH = FANOUT ** DEPTH
COORDINATE = ["key", "level", "idx"]


@dataclass(frozen=True)
class Manifest:
    """``leaves``: ``doc_id, part, key, idx, n, place, sources, leaf, tampered``; ``nodes``: all nodes of all trees."""

    leaves: DataFrame
    nodes: DataFrame


def digest(children: Iterable[str]) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def _field(value: Column) -> Column:
    """``-`` for a null, else the length in bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def hashed(documents: DataFrame) -> DataFrame:
    """``doc_id, key, leaf, tampered``: the leaf, and that of the text without newlines where its id is dealt so.

    ``tampered`` is null where nothing is tampered with. ``key`` sorts as the sources do, null first.
    """
    doc_id, text = F.col("doc_id").cast("bigint"), F.col("text")
    head = F.concat(*[_field(c) for c in (doc_id, F.col("source"), F.col("lang"), F.col("n_chars"))])
    leaf = lambda body: F.sha2(F.concat(head, _field(body)), 256)
    dealt = (F.crc32(doc_id.cast("string")) % 2 == 0) & text.contains("\n")
    return documents.select(
        doc_id.alias("doc_id"), F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("-")).alias("key"),
        leaf(text).alias("leaf"), F.when(dealt, leaf(F.replace(text, F.lit("\n"), F.lit("")))).alias("tampered"))


def ranked(rows: DataFrame, group: str, order: list[str], purpose: str) -> DataFrame:
    """``rows`` with ``part``, their partition, ``idx``, their place within ``group`` from 0, and ``n``, its size.

    ``rows`` are stored ones. Only the sizes of (group, partition) runs meet in a window: for a group as many
    rows as there are partitions.
    """
    parts = max(1, -(-rows.count() // LEAVES))
    keys = [group, *order, "_tie"]
    at = F.monotonically_increasing_id()  # the partition's number, and the row's within it
    placed = stored(
        rows.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("_tie")
        .select("*", F.shiftright(at, 33).alias("part"), at.bitwiseAND(F.lit(2**33 - 1)).alias("_pos")), purpose)
    runs = placed.groupBy(group, "part").agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_size"))
    by = Window.partitionBy(group)
    before = F.coalesce(F.sum("_size").over(by.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = stored(runs.select(group, "part", (before - F.col("_first")).alias("_shift"), F.sum("_size").over(by).alias("n")),
                  f"{purpose}-runs")
    return (placed.join(runs, [group, "part"])
            .select(*rows.columns, "part", (F.col("_pos") + F.col("_shift")).alias("idx"), "n"))


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, list[str]]]:
    """Key, number of the first node, number of the tree's nodes, and digests, by stretches of ``WIDTH`` nodes."""
    key, first, n, held = None, -1, 0, []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("key", "idx", "n", "hash"))):
            if held and row[0] == key and row[1] // WIDTH == first // WIDTH:
                held.append(row[3])
                continue
            if held:
                yield key, first, n, held
            key, first, n, held = row[0], row[1], row[2], [row[3]]
    if held:
        yield key, first, n, held


def _build(base: int):
    """The task that builds up to ``DEPTH`` levels above the nodes of level ``base``, sorted by key and place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for key, first, n, nodes in _subtrees(batches):
            level = base
            while n > 1 and level < base + DEPTH:
                nodes = [digest(nodes[i:i + FANOUT]) for i in range(0, len(nodes), FANOUT)]
                first, n, level = first // FANOUT, -(-n // FANOUT), level + 1
                out += [(key, level, first + i, n, node) for i, node in enumerate(nodes)]
            if len(out) >= LEAVES:
                yield _nodes(out)
                out = []
        if out:
            yield _nodes(out)

    return run


def _nodes(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["key", "level", "idx", "n", "hash"])


def trees(nodes: DataFrame, purpose: str) -> DataFrame:
    """All nodes over the level-0 ``nodes`` (``key, idx, n, hash``), those included; ``n`` counts the nodes of a level.

    As many rounds as the largest tree has levels, divided by ``DEPTH``.
    """
    current = nodes.select("key", F.lit(0).alias("level"), "idx", "n", "hash")
    out, base = current, 0
    while not (current := current.where((F.col("level") == base) & (F.col("n") > 1))).isEmpty():
        dealt = current.repartition("key", F.floor(F.col("idx") / WIDTH)).sortWithinPartitions("key", "idx")
        current = stored(dealt.mapInArrow(_build(base), NODE), f"{purpose}-{base}")
        out, base = out.unionByName(current), base + DEPTH
    return out


def manifest(documents: DataFrame) -> Manifest:
    leaves = stored(ranked(stored(hashed(documents), "hashed"), "key", ["doc_id", "leaf"], "leaves"), "numbered")
    nodes = trees(leaves.select("key", "idx", "n", F.col("leaf").alias("hash")), "nodes")
    subroots = stored(nodes.where("n = 1").select(F.lit(TOP).alias("top"), F.col("key").alias("source_key"), "hash"), "subroots")
    sources = stored(ranked(subroots, "top", ["source_key"], "sources"), "sources-numbered")
    nodes = nodes.unionByName(trees(sources.select(F.col("top").alias("key"), "idx", "n", "hash"), "top"))
    places = sources.select(F.col("source_key").alias("key"), F.col("idx").alias("place"), F.col("n").alias("sources"))
    return Manifest(leaves.join(places, "key").select(
        "doc_id", "part", "key", "idx", "n", "place", "sources", "leaf", "tampered"), nodes)


def levels(on: set[int], n: int) -> Iterator[tuple[int, int, set[int]]]:
    """Level, number of its nodes, and those of it that lie on a path, from the leaves to below the root."""
    level = 0
    while n > 1:
        yield level, n, on
        on, n, level = {i // FANOUT for i in on}, -(-n // FANOUT), level + 1


def missing(on: set[int], n: int) -> Iterator[tuple[int, int]]:
    """Level and place of the nodes that the paths of the leaves ``on`` need and cannot derive, each once."""
    for level, count, here in levels(on, n):
        for parent in {i // FANOUT for i in here}:
            yield from ((level, i) for i in _run(parent, count) if i not in here)


def _run(parent: int, count: int) -> range:
    return range(FANOUT * parent, min(FANOUT * parent + FANOUT, count))


def _wanted(rows: list[dict]) -> dict[str, tuple[set[int], int]]:
    """The leaves of each tree that a partition's rows touch, with the tree's size; the top tree last."""
    out: dict[str, tuple[set[int], int]] = {}
    for row in rows:
        out.setdefault(row["key"], (set(), row["n"]))[0].add(row["idx"])
    if rows:
        out[TOP] = ({row["place"] for row in rows}, rows[0]["sources"])
    return out


def _coordinates(table: pa.Table) -> pa.Table:
    rows = table.to_pylist()
    found = [(rows[0]["part"], key, level, i) for key, (on, n) in _wanted(rows).items() for level, i in missing(on, n)]
    columns = zip(*found) if found else ((), (), (), ())
    return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.int32(), pa.int64()))],
                    names=["part", *COORDINATE])


def _climb(known: dict, key: str, idx: int, n: int, own: str, proof: list[str]) -> str:
    """The digest that ``own`` at place ``idx`` gives at the root; siblings on the way are added to ``proof``."""
    level = 0
    while n > 1:
        run = [own if i == idx else known[key, level, i] for i in _run(idx // FANOUT, n)]
        at = idx % FANOUT
        proof += run[:at] + run[at + 1:]
        own, idx, n, level = digest(run), idx // FANOUT, -(-n // FANOUT), level + 1
    return own


def _expand(leaves: pa.Table, fetched: pa.Table) -> pa.Table:
    """The proofs of one partition's leaves."""
    rows = leaves.to_pylist()
    known = {(r["key"], r["level"], r["idx"]): r["hash"] for r in fetched.to_pylist()}
    known |= {(r["key"], 0, r["idx"]): r["leaf"] for r in rows}
    subroots: dict[str, str] = {}
    for key, (on, n) in _wanted(rows).items():
        if key == TOP:
            known |= {(TOP, 0, r["place"]): subroots[r["key"]] for r in rows}
        for level, count, here in levels(on, n):
            for parent in {i // FANOUT for i in here}:
                known[key, level + 1, parent] = digest(known[key, level, i] for i in _run(parent, count))
        height = sum(1 for _ in levels(on, n))
        subroots[key] = known[key, height, 0]
    out = []
    for r in rows:
        proof: list[str] = []
        folded = _climb(known, r["key"], r["idx"], r["n"], r["tampered"] or r["leaf"], proof)
        folded = _climb(known, TOP, r["place"], r["sources"], folded, proof)
        out.append((r["doc_id"], r["leaf"], subroots[r["key"]], subroots[TOP], proof, folded))
    kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), pa.string())
    columns = zip(*out) if out else ((),) * len(kinds)
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)],
                    names=["doc_id", "leaf", "subroot", "root", "proof", "folded_root"])


def proofs(found: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof, folded_root`` of the leaves ``wanted``, by default all.

    ``proof`` holds the siblings' digests from the leaf up to the root, in each level left to right. ``folded_root``
    is what the tampered leaf, else the leaf itself, gives with them. ``wanted`` are rows of ``found.leaves``.
    """
    rows = stored(found.leaves if wanted is None else wanted, "wanted")
    needed = stored(rows.select("part", "key", "idx", "n", "place", "sources").groupBy("part").applyInArrow(
        _coordinates, "part long, key string, level int, idx long"), "missing")
    fetched = needed.join(found.nodes.select(*COORDINATE, "hash"), COORDINATE)
    return rows.groupBy("part").cogroup(fetched.groupBy("part")).applyInArrow(
        _expand, "doc_id long, leaf string, subroot string, root string, proof array<string>, folded_root string")


def proven(documents: DataFrame) -> DataFrame:
    """The proofs of all rows, and whether the folded root is the root: ``verified``."""
    return proofs(manifest(documents)).withColumn("verified", F.col("folded_root") == F.col("root"))
