"""Near-duplicate documents by a chosen-path similarity join on minwise tokens.

1. One pass over the texts turns every document into its set of hashed word
   shingles and keeps a digest of the set and ``POSITIONS`` minwise tokens.
   Documents with equal sets form one class from here on.
2. Each of ``trees`` trees starts with all classes in one node. A node selects
   one or two token positions (on average 1/0.8, so that a pair at the
   threshold shares one child on average) and every class moves to the child
   of its own token there. Nodes with one class end, small ones are leaves,
   and large ones branch again, ``DEPTH`` times at most; what is still
   large then is compared block by block.
3. Within a leaf the sketches of all classes are compared. First every class
   is held against one partner with a smaller id only; the links confirmed on the full sets
   form a forest, whose trees are components. Then a finer sketch tells which classes of a leaf may be similar
   to one of another component; their full sets meet in the leaf, all their pairs
   are compared exactly there, and one link for each two components that join comes out. So a
   group of n copies gives about n rows, not n squared, and no component is lost,
   as pairs inside one can add nothing to it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.llm.common import LOWER, WordHashes, mix, small_batches, stored
from shelfwise.llm.components import components, roots

WORDS, THRESHOLD = 5, 0.8
POSITIONS = 128          # minwise tokens of a set
BINS = 512               # of the finer sketch: the least hash of each equal part of the hash range
TREES, DEPTH = 8, 5
LEAF, BLOCK = 128, 512   # classes in a leaf; classes in a block of a leaf that stays large
COLUMNS = 8192           # shingles of a leaf that are compared at a time
DEVIATIONS = 4           # of the sketch estimate below the threshold that still count as similar
CHUNK = 200_000          # shingles hashed at a time

_FACTORS = np.random.default_rng(20240501).integers(1, 2**63, POSITIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: str | None, words: int, hashes: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a whole text.

    A-Z is lower-cased. With fewer words than a shingle takes, the whole
    sequence is the one shingle; without words, or for a null, the set is empty.
    """
    if text is None:
        return np.empty(0, np.uint64)
    tokens = text.encode("utf-8", "surrogatepass").translate(LOWER).split()
    n = len(tokens)
    if not n:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, tokens), np.uint64, n)
    width = min(words, n)
    h = mix(w[: n - width + 1] + np.uint64(width))
    for j in range(1, width):
        h = mix(h ^ w[j: n - width + 1 + j])
    h.sort()
    return h[np.concatenate(([True], h[1:] != h[:-1]))]


def minwise(sets: list[np.ndarray]) -> np.ndarray:
    """One row of ``POSITIONS`` 32-bit minwise tokens for each set, none empty."""
    out = np.empty((len(sets), POSITIONS), np.uint32)
    at = 0
    while at < len(sets):
        end, held = at, 0
        while end < len(sets) and (end == at or held + len(sets[end]) <= CHUNK):
            held += len(sets[end])
            end += 1
        values = np.concatenate(sets[at:end])
        starts = np.cumsum([0] + [len(s) for s in sets[at:end - 1]])
        for i in range(POSITIONS):
            out[at:end, i] = np.minimum.reduceat(values * _FACTORS[i], starts) >> np.uint64(32)
        at = end
    return out


def binned(hashes: np.ndarray) -> bytes:
    """A byte of the least hash in each of ``BINS`` parts of the hash range, 0 where there is none.

    Of a small set nearly all members are in it, of a large one ``BINS`` of them.
    """
    out = np.zeros(BINS, np.uint8)
    part = (hashes >> np.uint64(65 - BINS.bit_length())).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
    out[part[first]] = np.maximum(hashes[first] & np.uint64(255), np.uint64(1))
    return out.tobytes()


def signatures(documents: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id, text_hash, n_shingles, set_id, tokens, bins``; the last three are null for an empty set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in small_batches(batches):
            sets = [shingle_set(t, words, hashes) for t in batch.column("text").to_pylist()]
            full = [s for s in sets if len(s)]
            tokens = iter(minwise(full)) if full else iter(())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("text_hash"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets], pa.binary()),
                pa.array([next(tokens).tobytes() if len(s) else None for s in sets], pa.binary()),
                pa.array([binned(s) if len(s) else None for s in sets], pa.binary()),
            ], names=["doc_id", "text_hash", "n_shingles", "set_id", "tokens", "bins"])

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text",
                            F.xxhash64("text").alias("text_hash"))
    return rows.mapInArrow(
        run, "doc_id bigint, text_hash bigint, n_shingles bigint, set_id binary, tokens binary, bins binary")


def _token(position: Column) -> Column:
    return F.substring(F.col("tokens"), position * 4 + 1, F.lit(4))


def _branch(rows: DataFrame) -> DataFrame:
    """One child for each class and position that its node selects."""
    first = F.pmod(F.xxhash64("node", F.lit(1)), F.lit(POSITIONS)).cast("int")
    second = F.pmod(first + 1 + F.pmod(F.xxhash64("node", F.lit(2)), F.lit(POSITIONS - 1)), F.lit(POSITIONS)).cast("int")
    both = F.pmod(F.xxhash64("node", F.lit(3)), F.lit(4)) == 0
    chosen = F.when(both, F.array(first, second)).otherwise(F.array(first))
    return (rows.withColumn("_position", F.explode(chosen))
            .select(F.xxhash64("node", "_position", _token(F.col("_position"))).alias("node"), "set_id"))


def leaves(classes: DataFrame, trees: int = TREES) -> DataFrame:
    """``leaf, side, set_id``: where classes are compared.

    ``side`` is null where all pairs of a leaf count. Of a node that stays large, the
    classes are dealt to blocks, ``leaf`` stands for two blocks, and only
    pairs of side 0 with side 1 count.
    """
    roots = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(trees - 1).cast("bigint")))
    level = _branch(classes.select(F.col("set_id"), "tokens", roots.alias("node")))
    found = []
    for depth in range(1, DEPTH + 1):
        level = stored(level, "paths")
        sizes = level.groupBy("node").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        sized = stored(level.join(sizes, "node"), "nodes")
        found.append(sized.where(F.col("size") <= LEAF)
                     .select(F.col("node").alias("leaf"), F.lit(None).cast("int").alias("side"), "set_id"))
        large = sized.where(F.col("size") > LEAF)
        if large.isEmpty():
            break
        if depth == DEPTH:
            found.append(_blocks(large))
        else:
            level = _branch(large.join(classes.select("set_id", "tokens"), "set_id"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _blocks(large: DataFrame) -> DataFrame:
    n = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("set_id", F.lit(7)), n).cast("int")
    rows = large.select("node", "set_id", n.alias("n"), own.alias("own"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    return rows.select(
        F.xxhash64("node", low, high, F.lit(9)).alias("leaf"),
        F.when(F.col("own") == F.col("other"), F.lit(None)).otherwise((F.col("own") > F.col("other")).cast("int")).alias("side"),
        "set_id")


def _likeness(sketch: np.ndarray, part: slice) -> np.ndarray:
    """Estimated Jaccard similarity of the rows of ``part`` to all; one byte agrees by chance 1 time in 256."""
    out = np.empty((part.stop - part.start, len(sketch)), np.float32)
    for i in range(part.start, part.stop):
        out[i - part.start] = (sketch == sketch[i]).mean(axis=1, dtype=np.float32)
    return (out - 1 / 256) * (256 / 255)


def _by_leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The rows of one leaf after the other, from batches that are sorted by leaf."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        leaf = batch.column("leaf").to_numpy()
        cuts = np.concatenate(([0], np.flatnonzero(leaf[1:] != leaf[:-1]) + 1, [len(leaf)]))
        for a, b in zip(cuts[:-1], cuts[1:]):
            if held and held[-1].column("leaf")[0].as_py() != leaf[a]:
                yield _columns(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield _columns(held)


def _columns(parts: list[pa.RecordBatch]) -> dict:
    return pa.Table.from_batches(parts).to_pydict()


def _pairs(rows: dict, least: float, threshold: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each row its similar earlier ones (by id, or on the other side): index, indices, estimates."""
    order = sorted(range(len(rows["set_id"])), key=lambda i: rows["set_id"][i])
    for name in rows:
        rows[name] = [rows[name][i] for i in order]
    sketch = np.frombuffer(b"".join(rows["sketch"]), np.uint8).reshape(len(order), -1)
    sizes = np.array(rows["n"], np.float64)
    side = np.array([-1 if s is None else s for s in rows["side"]])
    for i in range(1, len(order)):
        like = _likeness(sketch[: i + 1], slice(i, i + 1))[0][:i]
        small = np.minimum(sizes[:i], sizes[i]) >= threshold * np.maximum(sizes[:i], sizes[i])
        j = np.flatnonzero((like >= least) & small & ((side[:i] < 0) | (side[:i] != side[i])))
        if len(j):
            yield i, j, like[j]


def _spread(threshold: float) -> float:
    return (threshold * (1 - threshold) / POSITIONS) ** 0.5


def _first_partners(threshold: float):
    """``leaf, side, set_id, partner, sure``: the classes that have a partner, and one for each but the first."""
    least, sure = threshold - DEVIATIONS * _spread(threshold), threshold + 2 * _spread(threshold)

    def run(batches):
        for rows in _by_leaf(batches):
            partner, members = {}, set()
            for i, j, like in _pairs(rows, least, threshold):
                good = j[like >= sure]
                partner[i] = (int(good[0]), True) if len(good) else (int(j[np.argmax(like)]), False)
                members.add(i)
                members.update(j.tolist())
            if members:
                at = sorted(members)
                ids = rows["set_id"]
                yield pa.RecordBatch.from_arrays([
                    pa.array([rows["leaf"][i] for i in at], pa.int64()),
                    pa.array([rows["side"][i] for i in at], pa.int32()),
                    pa.array([ids[i] for i in at], pa.binary()),
                    pa.array([ids[partner[i][0]] if i in partner else None for i in at], pa.binary()),
                    pa.array([partner[i][1] if i in partner else None for i in at], pa.bool_()),
                ], names=["leaf", "side", "set_id", "partner", "sure"])
    return run


def _open_members(threshold: float):
    """``leaf, side, set_id, label``: classes that may be similar to one of another component, by the finer sketch.

    The estimate rests on m of about N members of the union, so its variance shrinks
    by ``1 - m / N`` besides; nothing is lost down to ``DEVIATIONS`` of it below the threshold.
    """
    def run(batches):
        for rows in _by_leaf(batches):
            if len(set(rows["label"])) < 2:
                continue
            number: dict = {}
            label = np.array([number.setdefault(x, len(number)) for x in rows["label"]])
            bins = np.frombuffer(b"".join(rows["bins"]), np.uint8).reshape(len(label), BINS)
            sizes = np.array(rows["n"], np.float64)
            side = np.array([-1 if x is None else x for x in rows["side"]])
            found = np.zeros(len(label), bool)
            for i in range(1, len(label)):
                j = np.flatnonzero(
                    (label[:i] != label[i]) & ((side[:i] < 0) | (side[:i] != side[i]))
                    & (np.minimum(sizes[:i], sizes[i]) >= threshold * np.maximum(sizes[:i], sizes[i])))
                if not len(j):
                    continue
                filled = (bins[j] | bins[i]) != 0
                m = filled.sum(axis=1)
                like = (((bins[j] == bins[i]) & filled).sum(axis=1) / m - 1 / 256) * (256 / 255)
                union = (sizes[j] + sizes[i]) / (1 + threshold)
                spread = np.sqrt(threshold * (1 - threshold) / m * np.clip(1 - m / union, 0.02, 1))
                near = j[like >= threshold - DEVIATIONS * spread - 0.005]
                found[near] = True
                found[i] |= len(near) > 0
            at = np.flatnonzero(found).tolist()
            if at:
                yield pa.RecordBatch.from_arrays([
                    pa.array([rows[name][i] for i in at], kind) for name, kind in
                    (("leaf", pa.int64()), ("side", pa.int32()), ("set_id", pa.binary()), ("label", pa.binary()))
                ], names=["leaf", "side", "set_id", "label"])
    return run


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles any two sets share, from products of membership matrices, some columns at a time."""
    counts = np.zeros((len(sets), len(sets)), np.float64)
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    by = np.argsort(values, kind="stable")
    values, owner = values[by], owner[by]
    new = np.concatenate(([True], values[1:] != values[:-1]))
    column = np.cumsum(new) - 1
    often = np.bincount(column) > 1
    place = np.cumsum(often) - 1
    shared = often[column]
    owner, column = owner[shared], place[column[shared]]
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, [start, start + COLUMNS])
        matrix = np.zeros((len(sets), COLUMNS), np.float32)
        matrix[owner[a:b], column[a:b] - start] = 1
        counts += matrix @ matrix.T
    np.fill_diagonal(counts, [len(s) for s in sets])
    return counts


def _exact_links(threshold: float):
    """``u, v``: labels of two components of a leaf that a link confirmed on the full sets joins, a row for each that it joins."""
    percent = round(threshold * 100)

    def run(batches):
        for rows in _by_leaf(batches):
            sets = [np.frombuffer(x, np.uint64) for x in rows["shingles"]]
            sizes = np.array([len(x) for x in sets], np.float64)
            common = common_counts(sets)
            similar = common * 100 >= percent * (sizes[:, None] + sizes[None, :] - common)
            side = np.array([-1 if x is None else x for x in rows["side"]])
            similar &= (side[:, None] < 0) | (side[:, None] != side[None, :])
            number: dict = {}
            label = np.array([number.setdefault(x, len(number)) for x in rows["label"]])
            u, v = [], []
            for i in range(len(sets)):
                others = np.flatnonzero(similar[i] & (label != label[i]))
                while len(others):
                    u.append(rows["label"][i])
                    v.append(rows["label"][others[0]])
                    label[label == label[others[0]]] = label[i]
                    others = others[label[others] != label[i]]
            if u:
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.binary()), pa.array(v, pa.binary())], names=["u", "v"])
    return run


def _gathered(rows: DataFrame, classes: DataFrame, sketch: str) -> DataFrame:
    """Rows of a leaf next to each other, with size and sketch."""
    full = rows.join(classes.select("set_id", F.col("n_shingles").alias("n"), sketch), "set_id")
    return full.repartition("leaf").sortWithinPartitions("leaf")


def _confirm(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose full sets are similar enough, compared in whole numbers."""
    percent = round(threshold * 100)

    def run(batches):
        for batch in batches:
            a, b = ([np.frombuffer(x, np.uint64) for x in batch.column(n).to_pylist()] for n in ("_a", "_b"))
            common = [len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(a, b)]
            right = [c * 100 >= percent * (len(x) + len(y) - c) for c, x, y in zip(common, a, b)]
            yield batch.select(["u", "v"]).filter(pa.array(right, pa.bool_()))

    a = sets.select(F.col("set_id").alias("u"), F.col("shingles").alias("_a"))
    b = sets.select(F.col("set_id").alias("v"), F.col("shingles").alias("_b"))
    return pairs.join(a, "u").join(b, "v").select("u", "v", "_a", "_b").mapInArrow(run, "u binary, v binary")


def _full_sets(documents: DataFrame, base: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``set_id, shingles`` of the wanted classes, from the text of one of their documents."""
    def run(batches):
        hashes = WordHashes()
        for batch in small_batches(batches):
            sets = [shingle_set(t, words, hashes).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("set_id"), pa.array(sets, pa.binary())], names=["set_id", "shingles"])

    one = (base.join(wanted, "set_id", "left_semi").groupBy("set_id")
           .agg(F.min(F.struct("doc_id", "text_hash")).alias("one"))
           .select("set_id", F.col("one.doc_id").alias("_doc"), F.col("one.text_hash").alias("_hash")))
    texts = documents.select(F.col("doc_id").cast("bigint").alias("_id"), "text")
    # Repeated rows of one document would give the set twice.
    found = texts.join(one, F.col("_id").eqNullSafe(F.col("_doc")) & (F.xxhash64("text") == F.col("_hash")))
    return (found.select("set_id", "text").mapInArrow(run, "set_id binary, shingles binary")
            .dropDuplicates(["set_id"]))


def near_duplicates(
    documents: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, trees: int = TREES
) -> DataFrame:
    """``doc_id, text_hash, n_shingles, component_id, kept`` for every row of ``documents``.

    Needs the columns ``doc_id`` and ``text``; others are ignored. Null and blank
    texts have the empty set and are linked with nothing. ``component_id`` is the
    smallest ``doc_id`` that links reach (null only if all of them are null)
    and ``kept`` says that a row has it; repeated rows of a kept document
    are all kept. An empty table gives an empty one.
    """
    base = stored(signatures(documents, words), "signatures")
    classes = stored(
        base.where("set_id IS NOT NULL").select("set_id", "n_shingles", "tokens", "bins").dropDuplicates(["set_id"])
        # The sketch is the lowest byte of each token.
        .withColumn("sketch", F.unhex(F.regexp_replace(F.hex("tokens"), "(..)......", "$1"))), "classes")
    members = stored(
        _gathered(leaves(classes, trees), classes, "sketch").select("leaf", "side", "set_id", "n", "sketch")
        .mapInArrow(_first_partners(threshold), "leaf bigint, side int, set_id binary, partner binary, sure boolean"),
        "members")
    sets = stored(_full_sets(documents, base, members.select("set_id").distinct(), words), "sets")
    choice = F.struct(~F.col("sure"), F.col("partner"))
    first = (members.where("partner IS NOT NULL").groupBy(F.col("set_id").alias("u"))
             .agg(F.min(choice).getField("partner").alias("v")))
    # A partner is smaller than its class, so these links are a forest.
    labels = roots(_confirm(first, sets, threshold))

    comparing = members.select("leaf", "side", "set_id").distinct()
    labelled = (comparing.join(labels, comparing["set_id"] == labels["node"], "left")
                .select("leaf", "side", "set_id", F.coalesce("label", "set_id").alias("label")))
    still = (_gathered(labelled, classes, "bins").select("leaf", "side", "set_id", "n", "bins", "label")
             .mapInArrow(_open_members(threshold), "leaf bigint, side int, set_id binary, label binary"))
    more = (still.join(sets, "set_id").repartition("leaf").sortWithinPartitions("leaf")
            .mapInArrow(_exact_links(threshold), "u binary, v binary"))
    merged = components(more).select(F.col("node").alias("_label"), F.col("label").alias("_merged"))

    ids = base.where("set_id IS NOT NULL").groupBy("set_id").agg(F.min("doc_id").alias("least"))
    ids = (ids.join(labels, ids["set_id"] == labels["node"], "left")
           .select("set_id", "least", F.coalesce("label", "set_id").alias("label")))
    ids = (ids.join(merged, ids["label"] == merged["_label"], "left")
           .select("set_id", "least", F.coalesce("_merged", "label").alias("label")))
    smallest = ids.groupBy("label").agg(F.min("least").alias("component_id"))
    classes_out = ids.join(smallest, "label").select(F.col("set_id").alias("_set"), "component_id")
    full = base.where("set_id IS NOT NULL").select("doc_id", "text_hash", "n_shingles", "set_id")
    linked = full.join(classes_out, full["set_id"] == classes_out["_set"]).drop("_set", "set_id")
    alone = base.where("set_id IS NULL").select(
        "doc_id", "text_hash", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicated(documents: DataFrame, words: int = WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``documents`` with one of each group of near duplicates, columns as given, whatever their names."""
    kept = (near_duplicates(documents, words, threshold).where("kept")
            .select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")).distinct())
    # The given columns travel as one, so that none can clash with those of the join.
    rows = documents.select(F.struct(*documents.columns).alias("row"), F.col("doc_id").cast("bigint").alias("own_id"),
                            F.xxhash64("text").alias("own_hash"))
    found = rows.join(kept, F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_hash") == F.col("hash")), "left_semi")
    return found.dropDuplicates(["own_id", "own_hash"]).select("row.*")
