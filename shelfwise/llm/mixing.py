"""Mix sources to target weights in blocks of fixed length.

Sizes count words. The words of a source, one document after the other,
form a line that is cut into blocks of ``BLOCK`` words. The mix is a row of
output shards of ``SHARD`` slots, one block each:

* every shard draws from a seeded multinomial how many of its slots each source
  fills; with many sources first among groups of sources, then inside each group that
  drew any, which gives the same distribution. Over all shards the draws miss a source's
  quota by about the square root of it, so slots that a source drew beyond its quota go, in
  order, to the sources that drew too few;
* slot k of a source holds the block at index k of a pseudorandom permutation of
  the source's blocks, another permutation for each pass over them. No list of
  blocks is ever shuffled, and a slot knows its block by itself;
* slots and blocks join on source and block index.

Positions on the line come from sums over hashed buckets of a source, so no
task sees a whole source, however large; and sums over all sources come from sums of
ranges of them, so there may be as many sources as documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.llm.common import stored, word_count

# Weights by rank of the source, in turn, and the size of the mix.
WEIGHTS, SHARE, MOST_REPEATS = (3, 1, 2), 1.5, 2
BLOCK = 128         # words
SHARD = 65_536      # slots
BUCKET = 2_000      # documents of a source in one bucket, about
RANGE = 200_000     # sources of one range, about
BITS = 8            # a draw is among 2 ** BITS sources or groups of them
SEED = 20240501


def running(rows: DataFrame, order: list[Column | str], purpose: str, size: int = RANGE, **sums: str) -> DataFrame:
    """``rows`` with, under each name of ``sums``, the sum of its column over all rows before, by ``order``.

    ``order`` must tell all rows apart. They are dealt to ranges of about ``size`` rows; only the ranges' sums, a
    row for each, meet in one window. No rows give none.
    """
    parts = max(1, -(-rows.count() // size))
    placed = stored(rows.repartitionByRange(parts, *order).select("*", F.spark_partition_id().alias("_part")), purpose)
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda column: F.coalesce(column, F.lit(0))
    held = placed.groupBy("_part").agg(*[F.sum(c).alias(f"_{name}") for name, c in sums.items()])
    held = held.select("_part", *[zero(F.sum(f"_{name}").over(ahead)).alias(f"_{name}") for name in sums])
    inside = placed.select("*", *[zero(F.sum(c).over(within)).alias(name) for name, c in sums.items()])
    return inside.join(held, "_part").select(*rows.columns, *[(F.col(name) + F.col(f"_{name}")).alias(name) for name in sums])


def source_targets(
    sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST_REPEATS
) -> DataFrame:
    """``rank, source, source_size, target``: one row per source, null last.

    The mix holds ``share`` times all words. Sources share it by weight; those whose
    part exceeds ``most`` times their size stop there and the others share the rest
    by weight. With the sources in the order of ``cap / weight`` this has a closed form:
    a prefix of them stops, and the rest has one common factor.
    """
    sources = stored(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes")
    ranked = running(sources.withColumn("one", F.lit(1)), [F.col("source").asc_nulls_last()], "ranked", rank="one")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = ranked.select("rank", "source", "source_size", weight.alias("w"), (F.col("source_size") * float(most)).alias("cap"))
    words, all_w = ranked.agg(F.sum("source_size"), F.sum("w")).first()
    levels = running(ranked, [F.col("cap") / F.col("w"), F.col("rank")], "levels", cap_before="cap", w_before="w")
    level = (F.lit((words or 0) * float(share)) - F.col("cap_before")) / (F.lit(all_w or 0.0) - F.col("w_before"))
    # The common factor: it falls beyond the first source that does not stop.
    factor = levels.agg(F.max(F.when(F.col("cap") / F.col("w") > level, level))).first()[0]
    target = F.least(F.col("cap"), F.lit(factor) * F.col("w")) if factor is not None else F.col("cap")
    return ranked.select("rank", "source", "source_size", target.alias("target"))


def _on_line(sizes: DataFrame, sources: DataFrame, n: int) -> DataFrame:
    """Adds ``rank`` and ``first``, the place of a document's first word on its source's line."""
    buckets = max(1, n // BUCKET)
    rows = (sizes.join(sources.select("rank", "source"), sizes["source"].eqNullSafe(sources["source"]))
            .drop(sources["source"])
            .withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(buckets))))
    sums = rows.groupBy("rank", "bucket").agg(F.sum("size").alias("held"))
    earlier = Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("rank", "bucket", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("start"))
    inside = (Window.partitionBy("rank", "bucket").orderBy("doc_id", "text_hash")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = rows.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return (placed.join(sums, ["rank", "bucket"])
            .select("doc_id", "text_hash", "size", "rank", (F.col("start") + F.col("before")).alias("first")))


def _quotas(sources: DataFrame, block: int) -> DataFrame:
    """``rank, blocks, slots, last_words``: a source's slots and the words of the last, partial one."""
    size, goal = F.col("source_size"), F.round("target").cast("bigint")
    blocks = F.ceil(size / block)
    passes = F.when(size > 0, F.floor(goal / size)).otherwise(0)
    rest = goal - passes * size
    whole = passes * blocks + F.floor(rest / block)
    return sources.select(
        "rank", blocks.alias("blocks"), (rest % block).cast("int").alias("last_words"),
        (whole + F.when(rest % block > 0, 1).otherwise(0)).cast("bigint").alias("slots"))


def _drawn_inside(level: int, seed: int):
    """Deals each row's ``n`` slots among its node's children, by a multinomial with their slots as weights."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shards, nodes, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "node", "n"))
            ends = np.cumsum(batch.column("slots").value_lengths().to_numpy(zero_copy_only=False))
            children, slots = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("children", "slots"))
            out: list[tuple] = []
            for i, end in enumerate(ends):
                start = ends[i - 1] if i else 0
                weights = slots[start:end].astype(np.float64)
                draw = np.random.default_rng([seed, int(shards[i]), level, int(nodes[i])])
                counts = draw.multinomial(int(n[i]), weights / weights.sum())
                some = np.flatnonzero(counts)
                out.append((np.full(len(some), shards[i]), children[start:end][some], counts[some]))
            columns = [np.concatenate(c).astype(np.int64) for c in zip(*out)] or [np.empty(0, np.int64)] * 3
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["shard", "node", "n"])

    return run


def _draws(sources: DataFrame, shard: int, seed: int, bits: int = BITS) -> DataFrame:
    """``rank, shard, n``: the multinomial counts of every shard, drawn down a tree over the ranks.

    A node of the tree has at most ``2 ** bits`` children, whatever the number of sources.
    """
    total, last = sources.agg(F.coalesce(F.sum("slots"), F.lit(0)), F.coalesce(F.max("rank"), F.lit(0))).first()
    first = F.col("id") * shard
    # The root is node 0. As a constant it would turn the join by key into a product.
    drawn = sources.sparkSession.range(-(-total // shard)).select(
        F.col("id").alias("shard"), F.shiftright("id", 63).alias("node"), F.least(F.lit(shard), F.lit(total) - first).cast("bigint").alias("n"))
    for level in reversed(range(max(1, -(-last.bit_length() // bits)))):
        child = F.shiftright("rank", bits * level)
        below = sources.groupBy(child.alias("child")).agg(F.sum("slots").alias("slots"))
        family = F.sort_array(F.collect_list(F.struct("child", "slots")))
        below = (below.groupBy(F.shiftright("child", bits).alias("node")).agg(family.alias("f"))
                 .select("node", F.col("f.child").alias("children"), F.col("f.slots").alias("slots")))
        drawn = (drawn.join(below, "node").select("shard", "node", "n", "children", "slots")
                 .mapInArrow(_drawn_inside(level, seed), "shard bigint, node bigint, n bigint"))
    return drawn.select(F.col("node").alias("rank"), "shard", "n")


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray, seed: int = SEED) -> np.ndarray:
    """Where a keyed pseudorandom permutation of ``0 .. size - 1`` takes ``index``.

    A four-round Feistel network over the next power of four; values that
    land outside go round again until they are inside.
    """
    size, out = size.astype(np.uint64), index.astype(np.uint64).copy()
    half = np.uint64(1)
    bits = np.ones(len(out), np.uint64)
    need = np.maximum(size, 2) - np.uint64(1)
    while True:
        low = (need >> (bits + bits)) > 0
        if not low.any():
            break
        bits[low] += half
    mask = (np.uint64(1) << bits) - np.uint64(1)
    keys = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)
    todo = np.arange(len(out))
    while len(todo):
        b, m, k = bits[todo], mask[todo], keys[todo]
        left, right = out[todo] >> b, out[todo] & m
        for turn in range(4):
            mixed = (right + k + np.uint64(turn * 0x632BE5AB)) * np.uint64(0xBF58476D1CE4E5B9)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((mixed >> np.uint64(32)) & m)
        out[todo] = (left << b) | right
        todo = todo[out[todo] >= size[todo]]
    return out.astype(np.int64)


def _slots(sources: DataFrame, block: int, shard: int, seed: int) -> DataFrame:
    """``shard, rank, k, block, words``: every slot of the mix and the block that it takes."""
    draws = stored(_draws(sources, shard, seed), "draws")
    earlier = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = draws.withColumn("k0", F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("bigint")))
    k = F.explode(F.sequence(F.col("k0"), F.col("k0") + F.col("n") - 1))
    slots = starts.select("shard", "rank", k.alias("k")).join(sources.select("rank", "slots"), "rank")

    drawn = draws.groupBy("rank").agg(F.sum("n").alias("drawn"))
    both = sources.join(drawn, "rank", "left").select("rank", "slots", F.coalesce("drawn", F.lit(0)).alias("drawn"))
    over, under = F.greatest(F.col("drawn") - F.col("slots"), F.lit(0)), F.greatest(F.col("slots") - F.col("drawn"), F.lit(0))
    both = running(both.withColumn("over", over).withColumn("under", under), ["rank"], "surplus", over0="over", under0="under")
    lacking = (both.where("slots > drawn")
               .select("rank", F.explode(F.sequence("drawn", F.col("slots") - 1)).alias("k"), "drawn", "under0")
               .select((F.col("under0") + F.col("k") - F.col("drawn")).alias("turn"), F.col("rank").alias("to"), F.col("k").alias("to_k")))
    beyond = (slots.where("k >= slots").join(both.select("rank", "over0"), "rank")
              .select("shard", (F.col("over0") + F.col("k") - F.col("slots")).alias("turn")))
    moved = beyond.join(lacking, "turn").select("shard", F.col("to").alias("rank"), F.col("to_k").alias("k"))
    settled = slots.where("k < slots").select("shard", "rank", "k").unionByName(moved)

    @F.pandas_udf("bigint")
    def block_of(index: pd.Series, size: pd.Series, key: pd.Series) -> pd.Series:
        return pd.Series(permuted(index.to_numpy(), size.to_numpy(), key.to_numpy(), seed))

    full = settled.join(sources, "rank")
    turn = F.floor(F.col("k") / F.col("blocks"))
    last = (F.col("k") == F.col("slots") - 1) & (F.col("last_words") > 0)
    return full.select(
        "shard", "rank", "k", turn.cast("int").alias("turn"),
        block_of((F.col("k") % F.col("blocks")).cast("bigint"), F.col("blocks").cast("bigint"),
                 (F.col("rank") * 16 + turn).cast("bigint")).alias("block"),
        F.when(last, F.col("last_words")).otherwise(block).alias("words"))


def mix(
    documents: DataFrame, block: int = BLOCK, shard: int = SHARD, seed: int = SEED, **shares
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The mix as ``(documents, sources, pieces)``.

    ``documents``: ``doc_id, text_hash, size, rank, first``, a row for each given one.
    ``sources``: see :func:`source_targets`. ``pieces``: what each slot takes of each
    document, ``shard, k, turn, rank, first, start, length`` (``start`` counts words from
    the document's first; ``rank, first`` name the document if it has words).

    A null text has size 0 and takes no part; a null source is a source of its own.
    Repeated rows are documents of their own. An empty table gives empty ones.
    """
    sizes = stored(documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"),
        F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size")), "sizes")
    sources = stored(source_targets(sizes, **shares), "sources")
    placed = stored(_on_line(sizes, sources, sizes.count()), "line")
    quotas = _quotas(sources, block)
    slots = _slots(quotas.where("slots > 0"), block, shard, seed)
    within = F.explode(F.sequence(F.floor(F.col("first") / block), F.floor((F.col("first") + F.col("size") - 1) / block)))
    parts = placed.where("size > 0").select("rank", "first", "size", within.alias("block"))
    low = F.greatest(F.col("first"), F.col("block") * block)
    high = F.least(F.col("first") + F.col("size"), F.col("block") * block + F.col("words"))
    pieces = (parts.join(slots, ["rank", "block"]).where(high > low)
              .select("shard", "k", "turn", "rank", "first", (low - F.col("first")).alias("start"), (high - low).alias("length")))
    return placed, sources, pieces


def taken(placed: DataFrame, sources: DataFrame, pieces: DataFrame) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every document."""
    used = pieces.groupBy("rank", "first").agg(F.sum("length").alias("taken"))
    some = placed.where("size > 0").join(used, ["rank", "first"], "left")
    none = placed.where("size = 0").withColumn("taken", F.lit(None).cast("bigint"))
    return (some.unionByName(none.select(*some.columns)).join(sources, "rank")
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")))


def mixed_documents(documents: DataFrame, **options) -> DataFrame:
    """The mix as documents, columns as given: for each pass over a source the words taken.

    A document that a pass takes whole keeps its text; otherwise the words taken stand
    in their order, joined by spaces, and ``n_chars`` follows. Documents without words stay
    as they are.
    """
    placed, _, pieces = mix(documents, **options)
    runs = pieces.groupBy("rank", "first", "turn").agg(
        F.sort_array(F.collect_list(F.struct("start", "length"))).alias("runs"))
    chosen = (placed.where("size > 0").join(runs, ["rank", "first"])
              .select("doc_id", "text_hash", "size", "runs"))
    chosen = chosen.unionByName(placed.where("size = 0").select(
        "doc_id", "text_hash", "size",
        F.lit(None).cast(runs.schema["runs"].dataType).alias("runs")))
    # Repeated rows share id and hash: one of them meets all their places on the line.
    # The given columns travel as one, so that none can clash with those of the join.
    rows = documents.select(F.struct(*documents.columns).alias("row"), F.col("doc_id").cast("bigint").alias("own_id"),
                            F.xxhash64("text").alias("own_hash")).dropDuplicates(["own_id", "own_hash"])
    used = rows.join(chosen, F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_hash") == F.col("text_hash")))
    given = F.col("row.text")
    words = F.split(F.regexp_replace(F.trim(F.regexp_replace(given, r"[\x20\x09-\x0D]+", " ")), "^ | $", ""), " ")
    whole = F.col("runs").isNull() | (F.aggregate("runs", F.lit(0).cast("bigint"), lambda a, r: a + r["length"]) == F.col("size"))
    cut = F.array_join(F.flatten(F.transform("runs", lambda r: F.slice(words, (r["start"] + 1).cast("int"), r["length"].cast("int")))), " ")
    out = used.select("row", F.when(whole, given).otherwise(cut).alias("taken"))
    new = {"text": F.col("taken")}
    if "n_chars" in documents.columns:
        new["n_chars"] = F.length("taken").cast(documents.schema["n_chars"].dataType)
    return out.select(*[new.get(c, F.col("row")[c]).alias(c) for c in documents.columns])
