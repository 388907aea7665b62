"""The training-data operators against brute force, and on odd input."""

import base64
import hashlib
import itertools
import math
import re
import zlib
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from helpers import plan_of
from shelfwise.llm import chat, fingerprints, language, mixing, near_dedup, packing, privacy, topk, warc
from shelfwise.llm.common import stored
from shelfwise.llm.components import components as by_stars, roots

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, bucket int, rank string, label string"
LONG = "word " * 30_000


def odd_documents(spark):
    """Nulls, empty, blank, very long and repeated texts, null ids, and columns with clashing names."""
    same = "the quick brown fox jumps over the lazy dog again and again today"
    rows = [
        (1, same, "en", "a"), (2, same, "en", "a"), (2, same, "en", "a"), (3, same.upper(), None, None),
        (4, None, "en", "b"), (5, "", "en", "b"), (6, " \n\t", None, "b"), (7, LONG, "en", None),
        (None, "one", None, "c"), (8, "1234 !!", "en", "c"), (9, "mail bob@example.org now", "en", "d"),
    ]
    return spark.createDataFrame([(*r, 0, 1, "x", "y") for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def words(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def shingles(text, k):
    w = words(text)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute_components(texts, k):
    sets, parent = {i: shingles(t, k) for i, t in texts.items()}, {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * common >= 80 * len(sets[a] | sets[b]):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {i: root(i) for i in texts}, {i: len(s) for i, s in sets.items()}


def test_near_duplicates_equal_brute_force(spark, documents):
    found = near_dedup.near_duplicates(documents, 2).collect()
    components, sizes = brute_components({r["doc_id"]: r["text"] for r in documents.collect()}, 2)
    assert {r["doc_id"]: r["component_id"] for r in found} == components
    assert {r["doc_id"]: r["n_shingles"] for r in found} == sizes


def test_near_duplicates_of_odd_rows(spark):
    rows = odd_documents(spark)
    found = near_dedup.near_duplicates(rows, 2).collect()
    assert len(found) == rows.count()
    by = {r["doc_id"]: r["component_id"] for r in found}
    assert [by[i] for i in (1, 2, 3)] == [1, 1, 1]
    assert [by[i] for i in (4, 5, 6)] == [4, 5, 6]
    kept = near_dedup.deduplicated(rows)
    assert kept.columns == rows.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 4, 5, 6, 7, 8, 9]
    assert near_dedup.near_duplicates(rows.limit(0)).count() == 0


def test_roots_equal_components(spark):
    """Forests with a deep path, a hub and random trees: doubling gives what the star steps give."""
    rng = np.random.default_rng(11)
    path = [(i + 1, i) for i in range(70)]
    hub = [(i, 100) for i in range(101, 300)]
    trees = [(i, int(rng.integers(300, i))) for i in range(301, 500) if i % 9]
    for edges in (path, hub, path + hub + trees, []):
        frame = spark.createDataFrame(edges, "u long, v long")
        found = {r["node"]: r["label"] for r in roots(frame).collect()}
        assert found == {r["node"]: r["label"] for r in by_stars(frame).collect()}
        assert len(found) == len({n for e in edges for n in e})


def test_near_duplicates_take_few_jobs(spark):
    """A path of near copies: every shuffle keeps a thread of the driver for a minute, so rounds may not multiply them."""
    words = [f"w{i}" for i in range(90)]
    texts = {i: " ".join(words[i:i + 60]) for i in range(30)}
    texts |= {100 + i: f"text {i} stands alone " + " ".join(f"x{i}y{j}" for j in range(20)) for i in range(30)}
    rows = stored(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), "copies")
    spark.sparkContext.setJobGroup("few-jobs", "near duplicates")
    try:
        found = near_dedup.near_duplicates(rows, 2).collect()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {r["doc_id"]: r["component_id"] for r in found} == brute_components(texts, 2)[0]
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("few-jobs")) <= 84  # 104 with star steps for all links


def test_mix_meets_its_targets(spark, documents):
    found = mixing.taken(*mixing.mix(documents)).join(documents.select("doc_id", "source"), "doc_id").toPandas()
    by = found.groupby("source").agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum"))
    assert abs(by.target.sum() - 1.5 * by["size"].sum()) < 1e-6
    assert (by.target <= 2 * by["size"] + 1e-6).all()
    assert (abs(by.taken - by.target) <= mixing.BLOCK + 1).all()
    assert (found.taken <= 2 * found["size"]).all()
    open_ = by[by.target < 2 * by["size"] - 1e-6].reset_index()
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(by.index))}
    assert np.ptp([t / weight[s] for s, t in zip(open_.source, open_.target)]) < 1e-6


def test_mix_of_odd_rows(spark):
    rows = odd_documents(spark)
    found = mixing.taken(*mixing.mix(rows)).collect()
    assert len(found) == rows.count()
    assert all(r["taken"] <= 2 * r["size"] for r in found)
    assert mixing.mixed_documents(rows).columns == rows.columns
    assert mixing.taken(*mixing.mix(rows.limit(0))).count() == 0


@given(st.integers(1, 3000), st.integers(0, 2**40))
@settings(max_examples=30, deadline=None)
def test_permutation_takes_every_index_once(size, key):
    out = mixing.permuted(np.arange(size), np.full(size, size), np.full(size, key))
    assert sorted(out) == list(range(size))


def test_fingerprints_of_edited_and_next(spark, documents):
    found = {r["doc_id"]: r for r in fingerprints.against_next(documents).collect()}
    rows = sorted(documents.select("doc_id", "text").collect(), key=lambda r: -r["doc_id"])
    for i, row in enumerate(rows):
        text, following = row["text"], rows[(i + 1) % len(rows)]["text"]
        edited = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        assert found[row["doc_id"]]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    assert np.mean([r["near_edited"] for r in found.values()]) > 0.05 > np.mean([r["near_next"] for r in found.values()])
    own = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprints(documents).collect()}
    assert own == {i: r["fingerprint"] for i, r in found.items()}


def test_fingerprints_of_odd_rows(spark):
    rows = odd_documents(spark)
    found = fingerprints.against_next(rows).collect()
    assert len(found) == rows.count()
    assert len({r["fingerprint"] for r in found if r["doc_id"] in (1, 2)}) == 1
    assert fingerprints.against_next(rows.limit(0)).count() == 0
    assert fingerprints.against_next(rows.where("doc_id = 9")).first()["near_next"] == 1.0


def test_fingerprint_follows_order():
    a, b = "abcdefgh" * 3 + "0123456789" * 9, "0123456789" * 9 + "abcdefgh" * 3
    sign = lambda t: fingerprints.signature(fingerprints.code_points(t))
    assert fingerprints.likeness(sign(a), sign(a)) == 1
    assert fingerprints.likeness(sign(a), sign(b)) < 1


@pytest.mark.parametrize("n", [512, 1024, 2048, 4096, 8192])
def test_fingerprints_of_near_copies_across_a_power_of_two(n):
    text = "".join(map(chr, np.random.default_rng(n).integers(97, 123, n + 10)))
    sign = lambda t: fingerprints.signature(fingerprints.code_points(t))
    assert fingerprints.likeness(sign(text[: n - 1]), sign(text)) > 0.8


def test_ids_are_those_of_tokenizers(documents):
    import public_tokenizers
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    exact.encode_special_tokens = True
    encode = packing.encoder()
    texts = [r["text"] for r in documents.collect()] + ["", " ", "\n\n  x", "<|endoftext|>", "a b  c", "日本語 ñ é", "0" * 5000]
    assert [encode(t) for t in texts] == [e.ids for e in exact.encode_batch(texts, add_special_tokens=False)]


def test_packing_is_a_gapless_partition(spark, documents):
    found = packing.packed(documents).toPandas()
    encode = packing.encoder()
    for doc_id, rows in found.groupby("doc_id"):
        text = documents.where(F.col("doc_id") == int(doc_id)).first()["text"] if doc_id < 5 else None
        rows = rows.sort_values("piece")
        assert (rows.start.tolist() == np.cumsum([0, *rows.length[:-1]]).tolist()) and (rows.length[1:] == 2048).all()
        if text is not None:
            ids = np.array([*encode(text), 0], "<u4")
            assert rows.length.sum() == len(ids)
            assert rows.ids_crc32.iloc[0] == zlib.crc32(ids[: rows.length.iloc[0]].tobytes())
    for _, rows in found.groupby("sequence_id"):
        rows = rows.sort_values("offset")
        assert rows.offset.tolist() == np.cumsum([0, *rows.length[:-1]]).tolist() and rows.length.sum() <= 2048
    full = packing.sequences(documents, spark.createDataFrame(found)).toPandas()
    assert sum(map(len, full.ids)) == found.length.sum()


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=20))
@settings(max_examples=60, deadline=None)
def test_plan_places_every_piece_once(counts):
    sequences, seen = {}, {}
    for length, a, b, first, offset in packing.plan(counts, 64):
        seen.setdefault(length, []).extend(range(a, b))
        for i in range(b - a):
            sequences.setdefault(first + i, []).append((offset, length))
    assert {k: sorted(v) for k, v in seen.items()} == {k: list(range(n)) for k, n in counts.items()}
    for parts in sequences.values():
        ends = [0] + [o + n for o, n in sorted(parts)]
        assert [o for o, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 64


def test_packing_of_odd_rows(spark):
    rows = odd_documents(spark)
    found = packing.packed(rows)
    assert found.where("doc_id in (4, 5)").select("length").collect() == [(1,), (1,)]
    assert found.where("doc_id = 7").count() > 1
    assert packing.packed(rows.limit(0)).count() == 0


def test_language_of_held_out_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.identify(rows).where("held_out").join(rows.select("doc_id", "lang"), "doc_id").toPandas()
    assert (found.lang == found.lang_pred).mean() >= 0.98
    assert not found.rejected.any()


def test_language_of_odd_rows(spark, documents):
    model = language.fit(documents)
    rows = odd_documents(spark)
    found = language.identify(rows, model).collect()
    assert len(found) == rows.count()
    unknown = {r["doc_id"] for r in found if r["lang_pred"] == "und"}
    assert unknown == {4, 5, 6, 8}
    assert all(0 <= r["score"] <= 1 and (r["rejected"] or r["doc_id"] not in unknown) for r in found)
    assert language.fit(rows.limit(0)) is None
    assert language.identify(rows.limit(0)).count() == 0


def test_language_of_long_documents_only(spark):
    long = "ñandú queso mañana años pequeño señor " * 2_000
    rows = [(i, long, "es") for i in range(12)] + [(100 + i, "the quick brown fox and the lazy dog " * 5, "en") for i in range(12)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["en", "es"]
    assert model.predictor()([long[:200]])[0] == ["es"]


def test_models_from_numbered_grams_equal_those_from_places():
    places = language.windows(np.random.default_rng(3).integers(0, 5, 3000).astype(np.uint32))
    rows, numbers = np.unique(places, axis=0, return_counts=True)
    whole, counted = language.Model.of(places, 6), language.Model.of(rows, 6, numbers.astype(float))
    assert np.array_equal(whole.log_probability(places), counted.log_probability(places))


def test_kneser_ney_sums_to_one():
    codes = np.array([0, 1, 2, 1, 3, 0, 1, 2, 2, 0], np.uint32)
    model = language.Model.of(language.windows(codes), 4)
    contexts = language.windows(codes)[:, :-1]
    rows = np.array([[*c, last] for c in contexts for last in range(4)])
    total = np.exp(model.log_probability(rows)).reshape(-1, 4).sum(axis=1)
    assert np.allclose(total, 1)


def test_archives_and_index(spark):
    rows = [(1, "http://b.org/x", "<p>\r\n\r\n</p>"), (2, "http://a.org/", "same"), (3, "http://a.org/", "same"),
            (4, None, None), (5, "http://c.org/a\r\nb", ""), (6, "http://a.org/", "é" * 50_000), (None, "x", "same")]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int")
    found = warc.capture_index(pages).orderBy("range", "place").collect()
    assert len(found) == len(rows)
    by = {r["page_id"]: r for r in found}
    for page, _, html in rows:
        data = (html or "").encode()
        assert by[page]["payload_bytes"] == len(data)
        assert by[page]["payload_digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()
    assert {p: r["refers_to"] for p, r in by.items() if r["record_type"] == "revisit"} == {3: 2, 5: 4, None: 2}
    keys = [(r["urlkey"], r["time"]) for r in found]
    assert keys == sorted(keys)
    assert warc.capture_index(pages.limit(0)).count() == 0


@given(st.lists(st.lists(st.integers(0, 30), max_size=12), max_size=9))
@settings(max_examples=60, deadline=None)
def test_loser_tree_merges(lists):
    entry = lambda n: (f"{n:03}", "", n, "", 0, "", None, "", 0, 0)
    merged = list(warc.LoserTree([[entry(n) for n in sorted(x)] for x in lists]))
    assert [e[2] for e in merged] == sorted(itertools.chain(*lists))


def brute_top(ids, values, query, own, k):
    scores = values @ query
    order = [i for i in np.lexsort((ids, -scores)) if ids[i] != own][:k]
    return [(int(ids[i]), int(scores[i])) for i in order]


def test_top_k_is_exact_with_ties(spark):
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.normal(size=(300, 6)), np.repeat(rng.normal(size=(1, 6)), 40, axis=0)])
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(values)]
    rows += [(400, None, 0), (401, [1.0, None, 1.0, 1.0, 1.0, 1.0], 0), (402, [float("nan")] * 6, 0), (403, [float("inf")] * 6, 0), (500, [], 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    vectors = topk.whole_vectors(frame)
    found = topk.top(vectors, vectors.where("vec_id % 50 = 0")).toPandas()
    whole, ids = np.floor(values * 1024).astype(np.int64), np.arange(len(values))
    assert sorted(found.query_id.unique()) == list(range(0, 340, 50))
    for q, part in found.groupby("query_id"):
        part = part.sort_values("rank")
        assert list(zip(part.vec_id, part.score)) == brute_top(ids, whole, whole[q], q, 10)
    assert topk.top(vectors.limit(0), vectors.limit(0)).count() == 0


def test_top_k_of_large_components(spark):
    """Components of any finite size beside small ones; scores beyond 64 bits keep their exact order."""
    rng = np.random.default_rng(7)
    sizes = np.repeat([1.0, 9000.0, 1e7, 1e15, 1e30, 1e200], 40)
    values = rng.normal(size=(240, 5)) * sizes[:, None]
    values[::7, 0] = rng.normal(size=len(values[::7]))  # a small component in a large vector
    values[100], values[200] = [9000.0, 0.0, 0.0, 0.0, 0.0], values[199]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(values)] + [(900, [1e306, 1.0, 1.0, 1.0, 1.0])]
    vectors = topk.whole_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    found = topk.top(vectors, vectors.where("vec_id % 20 = 0 and vec_id < 900"), 12).toPandas()
    whole = [[math.floor(Fraction(x) * 1024) for x in v] for v in values]
    for q in range(0, 240, 20):
        scores = {i: sum(a * b for a, b in zip(v, whole[q])) for i, v in enumerate(whole) if i != q}
        best = sorted(scores, key=lambda i: (-scores[i], i))[:12]
        part = found[found.query_id == q].sort_values("rank")
        assert list(part.vec_id) == best
        assert list(part.score) == [min(max(scores[i], -2**63), 2**63 - 1) for i in best]


def test_top_k_meets_every_block(spark):
    """Many blocks, several batches and repeated ids: the result does not depend on how rows are dealt."""
    rng = np.random.default_rng(8)
    values = rng.normal(size=(1500, 4)).round(1)
    rows = [(i % 1200, [float(x) for x in v]) for i, v in enumerate(values)]
    vectors = topk.whole_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(6))
    blocks = topk.index(vectors, block=64)
    found = topk.top(vectors, vectors.where("vec_id % 3 = 0"), 5, topk.stored(blocks, "blocks")).toPandas()
    whole, ids = np.floor(values * 1024).astype(np.int64), np.arange(1500) % 1200
    expected = sorted((int(ids[q]), n + 1, *hit) for q in range(1500) if ids[q] % 3 == 0
                      for n, hit in enumerate(brute_top(ids, whole, whole[q], ids[q], 5)))
    assert sorted(map(tuple, found[["query_id", "rank", "vec_id", "score"]].astype(int).values.tolist())) == expected


def test_top_k_broadcasts_no_copies(spark):
    """Copies of queries and blocks, up to 512 of each, are shuffled: none goes through the driver, however small one copy is."""
    rng = np.random.default_rng(9)
    values = rng.normal(size=(400, 4))
    vectors = topk.whole_vectors(spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(values)], "vec_id long, embedding array<double>").repartition(4))
    found = topk.top(vectors, vectors.where("vec_id % 2 = 0"), 3, topk.stored(topk.index(vectors, block=32), "blocks"))
    assert "Broadcast" not in plan_of(found)
    rows = found.collect()
    assert "Broadcast" not in plan_of(found)  # nor where Spark has measured them
    whole, ids = np.floor(values * 1024).astype(np.int64), np.arange(400)
    expected = [(q, n + 1, *hit) for q in range(0, 400, 2) for n, hit in enumerate(brute_top(ids, whole, whole[q], q, 3))]
    assert sorted(map(tuple, rows)) == expected


@pytest.mark.parametrize("most, size", [(0, 2), (2**15 - 1, 2), (2**15, 4), (2**31 - 1, 4), (2**31, 8), (1e200, 8)])
def test_whole_numbers_packed(most, size):
    values = np.array([[most, -most, 1.0], [0.0, -1.0, 7.0]])
    data = topk.packed(values)
    assert len(data) == 6 * size
    assert np.array_equal(topk.unpacked(data, 2, 3).astype(np.float64), values)


MARKS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<<ROLE ", "<</ROLE>>", "\\", "<", "[", ">>", "\n", " ", "x"]


@given(st.lists(st.tuples(
    st.one_of(st.sampled_from(["user", "assistant", "system", ""]), st.lists(st.sampled_from(MARKS), max_size=4).map("".join)),
    st.lists(st.sampled_from(MARKS), max_size=8).map("".join)), max_size=5))
@settings(max_examples=300, deadline=None)
def test_chat_reads_back(turns):
    text, loss = chat.format_turns(turns)
    assert chat.read_turns(text) == turns
    assert [chat.unescape(text[a:b]) for a, b in loss] == [t for r, t in turns if r == "assistant"]


def test_reply_trees(spark):
    rows = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "bad", 0.1), (1, 3, 1, "assistant", "good", 0.9),
            (1, 4, 3, "user", "more", 0.9), (1, 5, 4, "assistant", None, None), (None, 1, None, None, "x", None)]
    trees = spark.createDataFrame(rows, "tree long, message long, parent long, role string, text string, score double")
    best = chat.conversations(trees).collect()
    assert {(r["tree"], r["leaf"]) for r in best} == {(1, 5), (None, 1)}
    assert chat.conversations(trees, None).count() == 3
    assert chat.read_back(chat.conversations(trees.limit(0))).count() == 0
    cycle = spark.createDataFrame([(1, 1, 2, "a", "b", 0.0), (1, 2, 1, "a", "b", 0.0)], trees.schema)
    with pytest.raises(ValueError):
        chat.conversations(cycle)


def test_chat_of_all_turns(spark):
    table = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    found = {r["conv_id"]: r for r in chat.read_back(chat.conversations(chat.as_messages(table))).collect()}
    for conv, rows in table.toPandas().sort_values("turn").groupby("conv_id"):
        said = "".join(f"{r}\n{t}\n" for r, t in zip(rows.role, rows.text))
        assert found[conv]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        learnt = "".join(rows.text[rows.role == "assistant"])
        assert (found[conv]["loss_chars"], found[conv]["loss_sha256"]) == (len(learnt), hashlib.sha256(learnt.encode()).hexdigest())


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {"email": True, "ip": all(int(p) <= 255 for p in value.split(".")) if kind == "ip" else True,
            "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]


def test_base_spans_equal_plain_patterns(spark):
    texts = ["a@b.c%d@e.f x@y", "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.4", "4111 1111 1111 1111 4111-1111-1111-1112", "+1 (743) 555-3824 +12 3",
             "é@x.y ñandú a.b@c-d.e-f.", "@@a@b.c@d.e", "9" * 20_000, "a." * 20_000, "x@" + "a." * 20_000 + "b", None, "", "😀 joe@x.org 😀 1.1.1.1"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = {r["doc_id"]: r for r in privacy.findings(rows).collect()}
    for i, text in enumerate(texts):
        for kind, pattern in PLAIN.items():
            expected = [(m.start(), m.end()) for m in re.finditer(pattern, text or "") if valid(kind, m[0])]
            assert [tuple(s) for s in found[i][kind]] == expected, (text or "")[:50]


def test_disclosing_terms_go_and_common_ones_stay(spark):
    rows = [(i, f"alpha beta {'zorbian' if i < 5 else 'plain'} call bob@x.org and gamma delta {i}", 0) for i in range(5)]
    rows += [(10 + i, f"alpha beta plain call gamma delta number {i}", 0) for i in range(200)] + [(999, None, 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, text_hash int")
    clean = {r["doc_id"]: r["text"] for r in privacy.sanitised(frame).collect()}
    assert clean[0] == "alpha beta <TERM> call <EMAIL> <TERM> gamma delta 0"  # short words count as well
    assert clean[10] == rows[5][1] and clean[999] is None
    assert privacy.findings(frame.limit(0)).count() == 0


def test_terms_disclose_from_afar_in_rare_texts_and_everywhere(spark):
    far = "plain words follow here " * 20
    rows = [(1, f"Kowalczyk {far} mail ann@x.org"), (2, f"{far} once more"), (3, f"Kim {far} mail eve@x.org"), (4, f"田中 {far} mail kay@x.org")]
    rows += [(i, f"zorbian {far} call bob@x.org {i}") for i in range(10, 18)] + [(18, f"the zorbian {far}")]
    # mail, call, once and more are common
    rows += [(100 + i, f"{far} mail call once more number {i}") for i in range(2000)]
    clean = {r["doc_id"]: r["text"] for r in privacy.sanitised(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert clean[1] == clean[3] == clean[4] == f"<TERM> {far} mail <EMAIL>" and clean[2] == rows[1][1]
    assert clean[10] == f"<TERM> {far} call <EMAIL> 10" and clean[18] == f"the <TERM> {far}"
    assert clean[100] == rows[13][1]


def brute_told(texts, disclosure=privacy.DISCLOSURE):
    """The terms of each distinct text that disclose an entity, straight from the definition."""
    entities = {t: {m.lower() for m in re.findall(r"[a-z]+@x\.org", t)} for t in texts}
    terms = {t: {w for w in re.split(r"[\W\d_]+", t.lower()) if w} for t in texts}
    n, told = len(texts), set()
    holds = lambda sets, x: {t for t in texts if x in sets[t]}
    for e in set().union(*entities.values()):
        with_e = holds(entities, e)
        for w in set().union(*(terms[t] for t in with_e)):
            with_w = holds(terms, w)
            joint, n_t, n_e = len(with_e & with_w), len(with_w), len(with_e)
            least = joint - privacy.DEVIATIONS * (joint * (1 - joint / n_t)) ** 0.5
            if n_e < n and least > 0 and np.log2(n * least / (n_e * n_t)) >= disclosure * np.log2(n / n_e) - 1e-9:
                told.add(w)
    return {(t, w) for t in texts for w in terms[t] & told}


@pytest.mark.parametrize("quiet", [200_000, 3])
def test_terms_equal_the_definition(spark, monkeypatch, quiet):
    """Random texts over a small vocabulary; with few quiet terms most words take the other way."""
    monkeypatch.setattr(privacy, "QUIET", quiet)
    pick = np.random.default_rng(7)
    letters = "abcdefghijklmnop"
    texts = []
    for i in range(120):
        words = [letters[int(x)] * 2 for x in pick.zipf(1.4, 8) if x < 16] + [f"w{letters[i % 16]}{letters[i // 16]}"] * (i % 3 == 0)
        who = [f"{letters[j]}{letters[j + 1]}@x.org" for j in range(5) if pick.random() < 0.08 * (j + 1)]
        pair = [f"name{letters[j]}" for j in range(5) if f"{letters[j]}{letters[j + 1]}@x.org" in who and pick.random() < 0.9]
        texts.append(" ".join([*words, *who, *pair]) + f" {i}")
    rows = [(i, t) for i, t in enumerate(texts + texts[:30])] + [(900, None), (901, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = privacy._found(df)
    keys = {r["k"]: r["text"] for r in df.where("text is not null").select(privacy.text_key().alias("k"), "text").collect()}
    got = {(keys[r["key"]], r["term"]) for r in privacy.disclosing_terms(df, found).collect()}
    expected = brute_told(sorted(set(texts) | {""}))
    assert got == expected and len(expected) > 30


def test_words_are_not_shipped_by_term(spark):
    """Without automatic broadcasts only words past the quiet ones reach the last join's shuffle."""
    rows = [(i, f"alpha beta gamma delta epsilon zeta rare{chr(97 + i % 26)}{chr(97 + i // 26)}{' call bob@x.org zorbian' if i < 9 else ''}") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = privacy._found(df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        told = privacy.disclosing_terms(df, found)
        plan = told._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "Python" not in plan
        got = {(r["term"]) for r in told.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {"zorbian", "call", "bob", "org", "x"} <= got and not {"alpha", "zeta", "rareza"} & got


def test_clashing_names_are_carried_along(spark):
    names = ["key", "row", "spans", "clean", "of", "near", "term", "terms", "_hash", "_spans", "a", "b"]
    schema = "doc_id long, text string, " + ", ".join(f"{c} string" for c in names)
    rows = [(1, "mail bob@x.org", *names), (2, None, *names), (2, "mail bob@x.org", *names)]
    frame = spark.createDataFrame(rows, schema)
    clean = privacy.sanitised(frame)
    assert clean.columns == frame.columns
    assert [tuple(r)[2:] for r in clean.collect()] == [tuple(names)] * 3


CLASHES = ["key", "row", "own_id", "own_hash", "id", "hash", "_id", "_hash", "_key", "_size", "_spans", "runs", "text_hash", "size", "taken", "rank"]


def test_stages_carry_clashing_names_along(spark):
    schema = "doc_id long, text string, source string, n_chars int, " + ", ".join(f"{c} string" for c in CLASHES)
    rows = [(i, f"some words of document {i} " * 40, "ab"[i % 2], 1, *CLASHES) for i in (-9 * 10**18, 5, 9 * 10**18)]
    frame = spark.createDataFrame([*rows, rows[0], (7, None, None, None, *CLASHES)], schema)
    for out in (near_dedup.deduplicated(frame), mixing.mixed_documents(frame), privacy.sanitised(frame)):
        assert out.columns == frame.columns
        found = out.collect()
        assert found and all(list(r)[4:] == CLASHES for r in found)


def test_fingerprints_of_extreme_ids(spark):
    rows = [(-9 * 10**18, "first text " * 20), (5, "second text " * 20), (9 * 10**18, "third text " * 20), (None, "fourth")]
    found = {r["doc_id"]: r for r in fingerprints.against_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    after = dict(zip((9 * 10**18, 5, -9 * 10**18), (rows[1][1], rows[0][1], rows[3][1])))
    for i, text in rows[:3]:
        edited = text[: len(text) - len(text) // 2] + after[i][: len(text) // 2]
        assert found[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()


def test_pipeline_stages(spark):
    import corpus_pipeline

    more = spark.read.parquet(f"{FOLDER}/documents.parquet").withColumn("doc_id", F.col("doc_id") + 1000)
    docs = odd_documents(spark).unionByName(more, allowMissingColumns=True)
    columns = docs.columns
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        if name != "packing":
            assert docs.columns == columns
        kept = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert kept <= ids
        if name == "language_id":
            assert not {4, 5, 6, 8} & kept
        if name == "near_dedup":
            texts = {i: r["text"] for i, r in enumerate(docs.where("doc_id != 7").collect())}
            components, _ = brute_components(texts, 5)
            assert len(set(components.values())) == len(texts)
        ids = kept
    used = docs.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert used.where("n != end OR n > 2048").count() == 0
    assert isinstance(docs.limit(1).toPandas(), pd.DataFrame)


def test_fingerprints_of_unevenly_spread_ids(spark):
    """One far outlier, an id and null that hold many rows: buckets stay small, successors are those of plain Python."""
    rows = [(10**18, "far away")] + [(i, f"text number {i} of its own") for i in range(600)]
    rows += [(77_777, f"copy {i} of one id") for i in range(700)] + [(None, f"row {i} without an id") for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    buckets = fingerprints._in_order(frame).where("not guest").groupBy("bucket").count().collect()
    assert max(r["count"] for r in buckets) <= 3 * fingerprints.BUCKET
    hashed = {r["text"]: r["h"] for r in frame.select("text", F.xxhash64("text").alias("h")).collect()}
    ordered = sorted(rows, key=lambda r: (*fingerprints.place(r[0]), hashed[r[1]] if r[0] in (77_777, None) else 0))
    found = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["edited_sha256"]) for r in fingerprints.against_next(frame).collect())
    expected = []
    for (doc_id, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1]):
        edited = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        expected.append((doc_id is None, doc_id or 0, hashlib.sha256(edited.encode()).hexdigest()))
    assert found == sorted(expected)


def test_bucket_bounds():
    assert fingerprints.bucket_bounds([], 5) == ([], [])
    bounds, hot = fingerprints.bucket_bounds([1, 2, 3, 4], 2)
    assert bounds == [(False, -2, fingerprints.LEAST)] and hot == []
    bounds, hot = fingerprints.bucket_bounds([None] * 8 + [5] * 8, 4)
    assert hot == [] or set(hot) <= {None, 5}
    assert bounds == sorted(bounds)


def test_archives_are_bounded_by_bytes(spark, tmp_path, monkeypatch):
    """Pages of several size classes, one beyond 100 kB, repeated ids and copies in every class."""
    monkeypatch.setattr(warc, "SMALL", 1_000)
    monkeypatch.setattr(warc, "RECORDS", 8)
    sizes = [0, 1, 999, 1_000, 1_001, 2_000, 2_001, 7_999, 8_001, 150_000]
    rows = [(n, f"http://host{n % 3}.example/{n}", chr(97 + n % 2) * sizes[n % 10]) for n in range(60)]
    rows += [(5, "http://again.example/", "z" * 1_001), (None, "http://none.example/", "b" * 150_000), (60, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    folder = str(tmp_path / "archives")
    warc.write_archives(pages, folder)
    found = warc.runs(spark, folder).collect()
    held = {}
    for r in found:
        held.setdefault(r["archive"], []).append(r["payload_bytes"])
    assert all(len(x) <= 8 and (sum(x) <= 8_000 or len(x) == 1) for x in held.values())
    assert any(len(x) > 1 for x in held.values())
    first = {}
    for page, _, html in rows:
        first[html or ""] = min(first.get(html or "", 10**9), 10**9 if page is None else page)
    assert len(found) == len(rows)
    expected = sorted((str(page), len(html or ""), "response" if page == first[html or ""] else "revisit") for page, _, html in rows)
    assert sorted((str(r["page_id"]), r["payload_bytes"], r["record_type"]) for r in found) == expected
    assert {r["refers_to"] for r in found if r["record_type"] == "revisit"} <= set(first.values())
