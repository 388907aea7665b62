"""Secrets by pattern, and by what it costs to guess a value in a credential's place.

The base patterns find assignments, access keys and long hexadecimal runs. Values in a credential's place, those of the
assignments and of a wider set of contexts (other key words, any characters, passwords inside of
addresses), are then priced like passwords: the cheapest way to cut a value into

* words, at the inverse of their share of the corpus, with a price for capitals and for digits that stand for letters;
* dates and years;
* repeats of a unit, at the unit's own price and the number of repeats;
* walks on a keyboard or along the alphabet, by start, length and turns;
* single characters tried by brute force, at the size of their class.

Prices are decimal logarithms of guesses. A value outside every base span that costs ``STRONG`` or more
is added as ``guess``; letters alone, in one case or with a capital in front, are not, since they may be a word that the corpus lacks.

The words are those of all documents, outside the values themselves. They are counted while the texts are scanned,
in bounded partial counts, and joined to the substrings of the distinct values; so neither the vocabulary nor the
values are held in one place. A null text counts as empty, repeated rows and ids each have their own result, an empty
table gives an empty one, and other columns are not looked at.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.llm.common import small_batches, stored

KINDS = ("assign", "access", "hex", "guess")
# The base patterns; letters of the key words in either case.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # the runs of 32 and more are the same as of all runs
LEAST = {"assign": 8, "access": 16}
# Wider places of a credential; the value is the last group.
PLACES = (
    re.compile(r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|(?:api|access|private)[_-]?key|credentials?)"""
               r"""["'\]]?\s{0,3}(?::=|=>|[:=])\s{0,3}["'`]?([^\s"'`<>,;]+)""", re.ASCII | re.IGNORECASE),
    re.compile(r"bearer\s{1,3}([^\s\"'`<>,;]+)", re.ASCII | re.IGNORECASE),
    re.compile(r"://[^\s/:@]*:([^\s/@]+)@"),
)
HINT = re.compile(r"pass|pwd|secret|token|key|credential|bearer", re.ASCII | re.IGNORECASE)
NO_VALUE = re.compile(r"[({$%*]|.*(?:://|\()", re.DOTALL)  # calls, variables, addresses
STRONG = 10.0
SHORTEST, LONGEST = 3, 24      # letters of a word
PERIOD = 16                    # characters of a repeated unit, at most
HELD = 200_000                 # words that a task counts before it hands them on
LEET = str.maketrans("013457@$!", "oleastasi")
WORD = re.compile(r"[^\W\d_]+")
DATE = re.compile(r"(?=((?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\2(?:0[1-9]|[12]\d|3[01])"
                  r"|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\3(?:19|20)\d\d))", re.ASCII)
YEAR = re.compile(r"(?=((?:19|20)\d\d))", re.ASCII)
YEARS, DAYS = math.log10(200), math.log10(200 * 366)
# Rows of a keyboard, each half a key further right than the one above.
ROWS = ("`1234567890-=", " qwertyuiop[]\\", " asdfghjkl;'", " zxcvbnm,./")
KEYS = {c: (r, x) for r, row in enumerate(ROWS) for x, c in enumerate(row) if c != " "}
STEPS = {(0, 1), (0, -1), (-1, 0), (-1, 1), (1, 0), (1, -1)}
START, TURN = math.log10(len(KEYS)), math.log10(len(STEPS) - 1)
TWO = math.log10(2)

SPAN = "struct<kind:int,start:int,end:int>"
SCANNED = f"row long, doc_id long, base array<{SPAN}>, places array<struct<kind:int,start:int,end:int,value:string>>, word string, n long"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Kind, start and end of the valid matches, in the order of their start, then kind."""
    found = [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    found += [(1, m.start(), m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    found += [(2, m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], s[0]))


def places(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, str]]:
    """Kind, start, end and value in a credential's place: those of assignments, and others that meet no base span.

    A place inside of an earlier one is left out.
    """
    found = [(0, *ASSIGN.match(text, start).span(2)) for kind, start, _ in base if kind == 0]
    wide = sorted(m.span(m.lastindex) for p in PLACES for m in p.finditer(text))
    at, reach = 0, 0  # of the base spans that start before a place's end, the furthest end; and that of earlier places
    for start, end in wide:
        while at < len(base) and base[at][1] < end:
            reach, at = max(reach, base[at][2]), at + 1
        if start >= reach and not NO_VALUE.match(text, start, end):
            found.append((3, start, end))
            reach = end
    return [(*s, text[s[1]:s[2]]) for s in found]


def plain(value: str) -> str:
    """Lower case, digits and signs that stand for letters turned into them; as many characters as before."""
    return "".join(c.lower() if len(c.lower()) == 1 else c for c in value).translate(LEET)


def substrings(value: str) -> Iterator[str]:
    """What of a value may be a word."""
    for run in WORD.finditer(plain(value)):
        letters = run[0]
        for i in range(len(letters) - SHORTEST + 1):
            for j in range(i + SHORTEST, min(i + LONGEST, len(letters)) + 1):
                yield letters[i:j]


def _character(c: str) -> float:
    if c.isdigit():
        return 1.0
    return math.log10(26 if c.isascii() and c.isalpha() else 33 if c.isascii() else 100)


def _word(part: str, price: float) -> float:
    """A word's price with its capitals and stand-ins."""
    low = part.lower()
    stand_ins = sum(a != b for a, b in zip(low, low.translate(LEET)))
    capitals = sum(c.isupper() for c in part)
    usual = capitals == len(part) or (capitals == 1 and part[0].isupper())
    return price + TWO * stand_ins + TWO * (1 if usual else capitals)


def _repeats(value: str, words: dict[str, float]) -> Iterator[tuple[int, int, float]]:
    prices: dict[str, float] = {}
    for period in range(1, min(PERIOD, len(value) // 2) + 1):
        start = 0
        for i in range(period, len(value) + 1):
            if i < len(value) and value[i] == value[i - period]:
                continue
            for first in range(start, min(start + period, i - 2 * period + 1)):
                unit, times = value[first:first + period], (i - first) // period
                if unit not in prices:
                    prices[unit] = price(unit, words, repeats=False)
                yield first, first + times * period, prices[unit] + math.log10(times)
            start = i - period + 1


def _walks(value: str) -> Iterator[tuple[int, int, float]]:
    """The longest walks on the keyboard and along the alphabet, of three keys and more."""
    low = plain_case(value)
    for kind in ("keys", "letters"):
        start, turns, last = 0, 0, None
        for i in range(1, len(low) + 1):
            step = _step(kind, low[i - 1], low[i]) if i < len(low) else None
            if step is not None and (kind == "keys" or last in (None, step)):
                turns += last is not None and step != last
                last = step
                continue
            if i - start >= 3:
                yield start, i, START + turns * TURN + math.log10(i - start)
            # A letter that ends one run may begin another in another direction.
            start, turns, last = (i - 1, 0, step) if step is not None else (i, 0, None)


def plain_case(value: str) -> str:
    return "".join(c.lower() if len(c.lower()) == 1 else c for c in value)


def _step(kind: str, a: str, b: str):
    if kind == "letters":
        d = ord(b) - ord(a)
        return d if abs(d) == 1 and a.isalnum() and b.isalnum() else None
    if a not in KEYS or b not in KEYS:
        return None
    step = (KEYS[b][0] - KEYS[a][0], KEYS[b][1] - KEYS[a][1])
    return step if step in STEPS else None


def segments(value: str, words: dict[str, float], repeats: bool = True) -> Iterator[tuple[int, int, float]]:
    """Start, end and price of every part that a value may be cut into, but single characters."""
    low = plain(value)
    for run in WORD.finditer(low):
        for i in range(run.start(), run.end() - SHORTEST + 1):
            for j in range(i + SHORTEST, min(i + LONGEST, run.end()) + 1):
                if (found := words.get(low[i:j])) is not None:
                    yield i, j, _word(value[i:j], found)
    yield from ((*m.span(1), DAYS) for m in DATE.finditer(value))
    yield from ((*m.span(1), YEARS) for m in YEAR.finditer(value))
    yield from _walks(value)
    if repeats:
        yield from _repeats(value, words)


def price(value: str, words: dict[str, float], repeats: bool = True) -> float:
    """The decimal logarithm of the guesses that the cheapest segmentation takes; ``words`` has the words' prices."""
    by_start: dict[int, list[tuple[int, float]]] = {}
    for start, end, cost in segments(value, words, repeats):
        by_start.setdefault(start, []).append((end, cost))
    best = [0.0] + [math.inf] * len(value)
    for i, c in enumerate(value):
        best[i + 1] = min(best[i + 1], best[i] + _character(c))
        for end, cost in by_start.get(i, ()):
            best[end] = min(best[end], best[i] + cost)
    return best[-1]


def reported(value: str, cost: float) -> bool:
    """Whether a value outside the base spans counts as a secret."""
    word = value.isalpha() and (value[1:] == value[1:].lower() or value == value.upper())
    return cost >= STRONG and not word


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for every document, and rows of words with their partial counts."""
    row, held = TaskContext.get().partitionId() << 33, Counter()
    for batch in small_batches(batches):
        out = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            text = text or ""
            base = base_spans(text)
            where = places(text, base) if base or HINT.search(text) or "://" in text else []
            out.append((row, doc_id, base, where, None, None))
            row += 1
            at, pieces = 0, []
            for _, start, end, _ in sorted(where, key=lambda s: s[1]):
                pieces.append(text[at:start])
                at = end
            held.update(WORD.findall(" ".join([*pieces, text[at:]]).lower()))
            if len(held) > HELD:
                yield _counted(held)
                held = Counter()
        yield _rows(out)
    if held:
        yield _counted(held)


def _counted(held: Counter) -> pa.RecordBatch:
    return _rows([(None, None, None, None, w, n) for w, n in held.items() if SHORTEST <= len(w) <= LONGEST])


_STRUCT = [("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.list_(pa.struct(_STRUCT)), pa.list_(pa.struct([*_STRUCT, ("value", pa.string())])),
             pa.string(), pa.int64())
    names = ["row", "doc_id", "base", "places", "word", "n"]
    columns = list(zip(*rows)) if rows else [()] * len(kinds)
    for at, fields in ((2, ("kind", "start", "end")), (3, ("kind", "start", "end", "value"))):
        columns[at] = [None if v is None else [dict(zip(fields, s)) for s in v] for v in columns[at]]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``number, word``: the distinct substrings of the values, handed on in bounded pieces."""
    for batch in batches:
        numbers, words = [], []
        for number, value in zip(batch.column("number").to_pylist(), batch.column("value").to_pylist()):
            seen: set[str] = set()
            for part in substrings(value):
                if part in seen:
                    continue
                seen.add(part)
                numbers.append(number)
                words.append(part)
                if len(words) >= 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(words, pa.string())], names=["number", "word"])
                    numbers, words, seen = [], [], set()
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(words, pa.string())], names=["number", "word"])


def _priced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.to_pylist()
        costs = [price(r["value"], {w["word"]: w["price"] for w in r["words"] or ()}) for r in rows]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r["value"] for r in rows], pa.string()), pa.array(costs, pa.float64()),
             pa.array([reported(r["value"], c) for r, c in zip(rows, costs)], pa.bool_())], names=["value", "cost", "strong"])


def priced(values: DataFrame, words: DataFrame) -> DataFrame:
    """``value, cost, strong`` of the distinct ``values``; ``words`` has ``word, n``, how often each occurs."""
    values = stored(values.select("value").distinct().select(F.monotonically_increasing_id().alias("number"), "value"), "values")
    total = words.agg(F.sum("n")).first()[0] or 1
    parts = values.mapInArrow(_split, "number long, word string").distinct()
    known = (parts.join(words, "word").select("number", F.struct(
        "word", F.greatest(F.log10(F.lit(float(total)) / F.col("n")), F.lit(TWO)).alias("price")).alias("w"))
             .groupBy("number").agg(F.collect_list("w").alias("words")))
    return stored(values.join(known, "number", "left").select("value", "words").mapInArrow(
        _priced, "value string, cost double, strong boolean"), "priced")


def findings(documents: DataFrame) -> DataFrame:
    """``doc_id, base, guessed, costs`` of every row of ``documents``.

    ``base`` and ``guessed`` are spans ``(kind, start, end)`` in code points, kind by its place in ``KINDS``; ``costs`` are the prices
    of the values of ``base``'s assignments, in their order.
    """
    scanned = stored(documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(_scan, SCANNED), "scanned")
    rows = scanned.where(F.col("row").isNotNull())
    words = stored(scanned.where(F.col("word").isNotNull()).groupBy("word").agg(F.sum("n").alias("n")), "words")
    each = rows.where(F.size("places") > 0).select("row", F.explode("places").alias("p"))
    costs = priced(each.select(F.col("p.value").alias("value")), words)
    span = lambda p: F.struct(p["kind"].alias("kind"), p["start"].alias("start"), p["end"].alias("end"))
    told = (each.withColumn("value", F.col("p.value")).join(costs, "value")
            .groupBy("row").agg(F.sort_array(F.collect_list(F.struct(F.col("p.start").alias("start"), span(F.col("p")).alias("p"), "cost", "strong"))).alias("found")))
    told = stored(told, "told")
    pick = lambda test, get, kind: F.coalesce(F.transform(F.filter("found", test), get), F.array().cast(kind))
    return rows.join(told, "row", "left").select(
        "doc_id", "base",
        pick(lambda f: (f["p"]["kind"] == 3) & f["strong"], lambda f: f["p"], f"array<{SPAN}>").alias("guessed"),
        pick(lambda f: f["p"]["kind"] == 0, lambda f: f["cost"], "array<double>").alias("costs"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind, joined by commas."""
    name = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("bigint")
