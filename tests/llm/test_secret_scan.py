"""Secrets against a plain reading of the patterns, and guess costs against all segmentations."""

import hashlib
import math
import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from shelfwise.llm import queries, secret_scan as scan

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, row int, word string, n int, value string, number string, base string"


def brute(text):
    """Match by match from the left, as the contract is worded."""
    patterns = {
        "assign": (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 8),
        "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16), "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 32)}
    out = []
    for order, (kind, (pattern, fine)) in enumerate(patterns.items()):
        at = 0
        find = re.compile(pattern, re.ASCII | (re.IGNORECASE if kind == "assign" else 0))
        while m := find.search(text, at):
            if fine(m):
                out.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}", kind))
            at = m.end()
    return sorted(out)


def test_base_of_whole_texts(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = {r["doc_id"]: r for r in queries.op12_secret_scan(spark, FOLDER).collect()}
    rows = documents.collect()
    assert len(found) == len(rows)
    for r in rows:
        expected = brute(r["text"] or "")
        got = found[r["doc_id"]]
        assert got["base_sha256"] == hashlib.sha256(",".join(s for _, _, s, _ in expected).encode()).hexdigest()
        assert [got[f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(e[3] == k for e in expected) for k in ("assign", "access", "hex")]
        assert [s for s in got["spans"].split(",") if s and not s.startswith("guess")] == [s for _, _, s, _ in expected]
    assert sum(r["n_assign"] for r in found.values()) > 0
    # Nothing in the texts but the planted assignments is a credential.
    assert sum(r["n_guess"] for r in found.values()) == 0


PIECES = st.sampled_from(["password", "PassWD", "token", "secret", "api_key", "APIKEY", "=", ":", " ", "  ", '"', "'", "abcdef12", "x" * 9, "==",
                          "AKIA", "AKIA1234567890ABCD", "deadbeef" * 4, "0f" * 15, "é", "日本", "ſecret", "\n", "a.b-c_d/e+f", "pass", "key", "://u:pw@h"])


@given(st.lists(PIECES, max_size=25).map("".join))
@settings(max_examples=500, deadline=None)
def test_base_of_odd_texts(text):
    base = scan.base_spans(text)
    assert [f"{scan.KINDS[k]}:{a}:{b}" for k, a, b in base] == [s for _, _, s, _ in brute(text)]
    for kind, start, end, value in scan.places(text, base):
        assert text[start:end] == value and value
        assert kind == 0 or not any(a < end and start < b for _, a, b in base)


def all_cuts(value, parts):
    """The least price over all ways to cut a value, one after another."""
    if not value:
        return 0.0
    best, n = math.inf, len(value)

    def go(i, cost):
        nonlocal best
        if i == n:
            best = min(best, cost)
            return
        go(i + 1, cost + scan._character(value[i]))
        for a, b, c in parts:
            if a == i:
                go(b, cost + c)

    go(0, 0.0)
    return best


WORDS = {"pass": 2.0, "word": 2.5, "password": 3.0, "love": 2.2, "dragon": 4.0, "asd": 5.0}


@given(st.lists(st.sampled_from(["pass", "Word", "p4ss", "dragon", "2019", "20190131", "aa", "qwe", "x", "7", "!", "abc", "abab"]), max_size=4).map("".join))
@settings(max_examples=200, deadline=None)
def test_price_is_the_least_of_all_segmentations(value):
    value = value[:12]
    assert scan.price(value, WORDS) == pytest.approx(all_cuts(value, list(scan.segments(value, WORDS))))


def test_prices_of_known_kinds():
    cost = lambda v: scan.price(v, WORDS)
    assert cost("password") == 3.0
    assert cost("P4ssword") == pytest.approx(3.0 + 2 * scan.TWO)
    assert cost("31.01.2019") == scan.DAYS and cost("2019") == scan.YEARS
    assert cost("qwertyuiop") < 3 and cost("1qaz2wsx") < 8 and cost("abcdefghij") < 3
    assert cost("z" * 40) == pytest.approx(scan._character("z") + math.log10(40))
    assert cost("x7#Qz9!kW2") > scan.STRONG
    assert cost("passwordpassword") < 3.5
    assert scan.price("", WORDS) == 0
    assert scan.price("k" * 200_000, {}) < 10


def test_values_in_credential_places(spark):
    rows = [
        (1, 'set pwd: "x7#Qz9!kW2$p" now'), (2, "postgres://bob:v9!Kd82#qLmz@db/x"), (3, "Authorization: Bearer q8Zr.7Tn2-kP0vLs"),
        (4, "password: dragonlove and so on"), (5, "passphrase = aaaaaaaaaaaaaaaaaaaa"), (6, "secret: https://example.org/a/b/c?d=1234567"),
        (7, "token = get_token(17, 4711, 0x77)"), (8, "the dragon was in love with the dragon " * 30), (9, "passcode: 20190131"),
        (10, "credentials: Unforgettablewordless"), (11, None), (11, ""), (None, "pwd=Zk3!vv0#Wq8x"), (12, "secret " + " " * 100_000 + ":" + "x9" * 50_000),
        (13, "pwd: x7#Qz9!kW2$p"), (13, "pwd: x7#Qz9!kW2$p"),
    ]
    df = spark.createDataFrame([(i, t, 0, "w", 1, "v", "n", "b") for i, t in rows], SCHEMA)
    found = scan.findings(df).select("doc_id", scan.span_text(F.col("guessed")).alias("g"), F.size("base").alias("b")).collect()
    assert len(found) == len(rows)
    got = sorted((r["doc_id"] or 0, r["g"]) for r in found if r["g"])
    assert got == [(0, "guess:4:16"), (1, "guess:10:22"), (2, "guess:15:27"), (3, "guess:22:38"), (13, "guess:5:17"), (13, "guess:5:17")]
    assert scan.findings(df.limit(0)).count() == 0


def test_prices_of_assignments_and_words_of_the_corpus(spark):
    """A word that the corpus holds is cheap, one that it lacks is not; values do not count as words of the corpus."""
    rows = [(i, "zanzibar is far away") for i in range(40)] + [(100, "secret = zanzibar"), (101, "secret = qjxkvwzq")]
    rows += [(i, "password: qjxkvwzq") for i in range(200, 260)]
    df = spark.createDataFrame([(i, t, 0, "w", 1, "v", "n", "b") for i, t in rows], SCHEMA)
    cost = {r["doc_id"]: r["costs"] for r in scan.findings(df).collect()}
    assert cost[100][0] == pytest.approx(math.log10(sum(3 for _ in range(40)) / 40 + 0), abs=0.3)
    assert cost[101][0] == cost[200][0] > 10
    assert cost[0] == []
