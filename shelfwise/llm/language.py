"""Language identification with interpolated Kneser-Ney character models.

Each language has one model of ``ORDER`` characters. Texts are lower-cased, and runs of
anything but letters become one blank. The highest order counts occurrences, the lower
ones count distinct predecessors; each is discounted by its own ``n1 / (n1 + 2 n2)`` and
interpolated with the next lower one, down to a uniform one over the alphabet. Counts lie in
sorted arrays of n-gram hashes, found by binary search.

A text goes to the language with the lowest cross-entropy per character. Documents that the
models were not counted from calibrate them: a scale turns differences of
cross-entropy into the score, and a limit on the excess over a language's own
mean rejects what reads like none of the languages.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from shelfwise.llm.common import small_batches, stored

ORDER = 5
SAMPLE = 600            # documents per language that models are counted and calibrated from, about
SAMPLE_CHARS = 50_000   # longer documents are sampled only where a language has too few others
CALIBRATION = 4         # one of so many documents of the sample calibrates
FOLDS, HELD_OUT = 5, 0
UNKNOWN = "und"
MEMO = 400_000          # n-grams whose scores a worker remembers
ENOUGH = 400            # characters beyond which a longer text is not judged more strictly
LOOSE = 1.5             # the limit, as a multiple of the worst calibration document's excess

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def letter_table() -> np.ndarray:
    """By code point: the lower-case letter, or 0 for anything that is no letter."""
    out = np.zeros(0x110000, np.uint32)
    for code in range(0x110000):
        c = chr(code)
        if c.isalpha():
            low = c.lower()
            out[code] = ord(low) if len(low) == 1 else code
    return out


def letters(text: str, known: np.ndarray) -> np.ndarray:
    """The text as letters and single blanks (0), a blank before and after; empty without letters."""
    codes = known[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    if not codes.any():
        return np.empty(0, np.uint32)
    codes = np.concatenate((np.zeros(1, np.uint32), codes, np.zeros(1, np.uint32)))
    return codes[np.concatenate(([True], (codes[1:] != 0) | (codes[:-1] != 0)))]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _M2
    return h ^ (h >> np.uint64(29))


def _found(table: np.ndarray, values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(keys))
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, values[at], 0.0)


@dataclass
class Model:
    """Kneser-Ney counts of one language: for each order, grams, contexts and their sums."""

    grams: list
    contexts: list
    discounts: list
    alphabet: int

    @classmethod
    def of(cls, windows: np.ndarray, alphabet: int, numbers: np.ndarray | None = None) -> "Model":
        """``windows``: one row for each place, the ``ORDER`` codes that end there; or distinct rows and their ``numbers``."""
        grams, contexts, discounts = [], [], []
        rows = windows
        for order in range(ORDER, 0, -1):
            # Below the highest order the rows are distinct grams without their first code: predecessors count.
            keys = _row_hashes(rows)
            order_keys, starts, counts = _runs(keys)
            if order == ORDER and numbers is not None:
                counts = np.bincount(np.searchsorted(order_keys, keys), numbers, len(order_keys))
            kept = rows[starts]
            n1, n2 = (counts == 1).sum(), (counts == 2).sum()
            discount = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
            context = _row_hashes(kept[:, :-1]) if order > 1 else np.zeros(len(kept), np.uint64)
            by = np.argsort(context, kind="stable")
            ctx = context[by]
            at = np.flatnonzero(np.concatenate(([True], ctx[1:] != ctx[:-1])))
            totals = np.add.reduceat(counts[by], at)
            kinds = np.diff(np.append(at, len(ctx))).astype(np.float64)
            grams.append((order_keys, counts))
            contexts.append((ctx[at], totals, kinds))
            discounts.append(float(discount))
            rows = kept[:, 1:]
        return cls(grams, contexts, discounts, alphabet)

    def log_probability(self, windows: np.ndarray) -> np.ndarray:
        """Natural logarithm of the probability of each row's last code after the others."""
        p = np.full(len(windows), 1.0 / self.alphabet)
        for level in range(ORDER - 1, -1, -1):
            order = ORDER - level
            tail = windows[:, ORDER - order:]
            count = _found(*self.grams[level], _row_hashes(tail))
            key = _row_hashes(tail[:, :-1]) if order > 1 else np.zeros(len(tail), np.uint64)
            ctx, totals, kinds = self.contexts[level]
            total, kind, d = _found(ctx, totals, key), _found(ctx, kinds, key), self.discounts[level]
            seen = total > 0
            safe = np.where(seen, total, 1.0)
            p = np.where(seen, np.maximum(count - d, 0) / safe + d * kind / safe * p, p)
        return np.log(p)


def _row_hashes(rows: np.ndarray) -> np.ndarray:
    h = np.full(len(rows), rows.shape[1], np.uint64)
    for j in range(rows.shape[1]):
        h = (h ^ rows[:, j].astype(np.uint64)) * _M1
        h ^= h >> np.uint64(32)
    return _mixed(h)


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, one index of each, and their numbers."""
    by = np.argsort(keys, kind="stable")
    ordered = keys[by]
    starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    return ordered[starts], by[starts], np.diff(np.append(starts, len(keys))).astype(np.float64)


def windows(codes: np.ndarray) -> np.ndarray:
    padded = np.concatenate((np.zeros(ORDER - 1, np.uint32), codes))
    return np.lib.stride_tricks.sliding_window_view(padded, ORDER)


class Scorer:
    """Mean log-probability of texts under all models at once.

    Remembers the scores of n-grams in a sorted hash array, at most ``MEMO`` of them.
    """

    def __init__(self, models: list[Model], known: np.ndarray):
        self.models, self.known = models, known
        self.keys = np.empty(0, np.uint64)
        self.values = np.empty((0, len(models)), np.float32)

    def _look_up(self, keys: np.ndarray, codes: np.ndarray, places: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        hit = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        if not hit.all():
            new, first, _ = _runs(keys[~hit])
            rows = codes[places[np.flatnonzero(~hit)[first]][:, None] + np.arange(ORDER)[None, :]]
            scores = np.column_stack([m.log_probability(rows) for m in self.models]).astype(np.float32)
            if len(self.keys) + len(new) > MEMO:
                base = (np.empty(0, np.uint64), np.empty((0, len(self.models)), np.float32))
            else:
                base = (self.keys, self.values)
            merged = np.concatenate((self.keys, new))
            order = np.argsort(merged, kind="stable")
            values = np.concatenate((self.values, scores))[order]
            merged = merged[order]
            out = values[np.searchsorted(merged, keys)]
            self.keys, self.values = (merged, values) if len(base[0]) == len(self.keys) else base
            return out
        return self.values[at]

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Letters and blanks of each text, and its mean log-probability by language."""
        parts = [letters(t, self.known) if t else np.empty(0, np.uint32) for t in texts]
        sizes = np.array([len(p) for p in parts])
        out = np.zeros((len(texts), len(self.models)))
        some = np.flatnonzero(sizes)
        if not len(some):
            return sizes, out
        pad = np.zeros(ORDER - 1, np.uint32)
        codes = np.concatenate([x for i in some for x in (pad, parts[i])])
        ends = np.cumsum(sizes[some] + ORDER - 1)
        starts = ends - sizes[some]
        places = np.concatenate([np.arange(a, b) for a, b in zip(starts, ends)]) - (ORDER - 1)
        wide = codes.astype(np.uint64)
        n = len(codes) - ORDER + 1
        h = np.full(n, ORDER, np.uint64)
        for j in range(ORDER):
            h = (h ^ wide[j: j + n]) * _M1
            h ^= h >> np.uint64(32)
        keys = _mixed(h)[places]
        found = self._look_up(keys, codes, places)
        first = np.concatenate(([0], np.cumsum(sizes[some])[:-1]))
        out[some] = np.add.reduceat(found.astype(np.float64), first) / sizes[some][:, None]
        return sizes, out


@dataclass
class Identifier:
    """Models by language and what the calibration found."""

    languages: list[str]
    models: list[Model]
    scale: float
    means: list[float]
    limits: list[float]

    def plain(self) -> tuple:
        """As arrays and numbers only, which travel without this module."""
        return (self.languages, [(m.grams, m.contexts, m.discounts, m.alphabet) for m in self.models],
                self.scale, self.means, self.limits)

    @classmethod
    def from_plain(cls, state: tuple) -> "Identifier":
        languages, models, *rest = state
        return cls(languages, [Model(*m) for m in models], *rest)

    def predictor(self):
        """A function from texts to ``(language, score, rejected)`` of each."""
        scorer = Scorer(self.models, letter_table())
        means, limits = np.array(self.means), np.array(self.limits)

        def predict(texts: list[str | None]) -> tuple[list, np.ndarray, np.ndarray]:
            sizes, logs = scorer.score(texts)
            best = logs.argmax(axis=1)
            weights = np.exp(self.scale * (logs - logs.max(axis=1, keepdims=True)))
            score = np.where(sizes > 0, 1 / weights.sum(axis=1), 0.0)
            excess = (-logs.max(axis=1) - means[best]) * np.sqrt(np.minimum(sizes, ENOUGH))
            rejected = (sizes == 0) | (excess > limits[best])
            names = [self.languages[b] if n else UNKNOWN for b, n in zip(best, sizes)]
            return names, score, rejected

        return predict


def fold(doc_id) -> "F.Column":
    """``crc32`` of the id as text, modulo ``FOLDS``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def sample(documents: DataFrame, most: int = SAMPLE, longest: int = SAMPLE_CHARS) -> DataFrame:
    """``lang, doc_id, text``: about ``most`` labelled documents of each language outside the held-out fold.

    Chosen by a hash of the id among those of at most ``longest`` characters; longer ones
    make up for what a language lacks.
    """
    rows = documents.where((fold(F.col("doc_id")) != HELD_OUT) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), "doc_id", "text", (F.length("text") > longest).alias("long"))
    sizes = rows.groupBy("lang").agg(F.count_if(~F.col("long")).alias("short_n"), F.count_if("long").alias("long_n"))
    share = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1_000_000)) / 1_000_000
    chosen = F.when(F.col("long"), share * F.col("long_n") < most - F.col("short_n")).otherwise(share * F.col("short_n") < most)
    return rows.join(F.broadcast(sizes), "lang").where(chosen).select("lang", "doc_id", "text")


def _numbered(rows: DataFrame) -> DataFrame:
    """``lang, text, nth, counts``: the sampled texts with letters; whether the models count the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = letter_table()
        for batch in batches:
            yield batch.filter(pa.array([len(letters(t, known)) > 0 for t in batch.column("text").to_pylist()], pa.bool_()))

    by = Window.partitionBy("lang")
    rows = rows.mapInArrow(run, rows.schema).withColumn("nth", F.row_number().over(by.orderBy("doc_id", "text")) - 1)
    counts = (F.col("nth") % CALIBRATION != 0) | (F.count(F.lit(1)).over(by) < 2 * CALIBRATION)
    return stored(rows.select("lang", "text", "nth", counts.alias("counts")), "sample")


def _grams(numbered: DataFrame) -> DataFrame:
    """``lang``, the codes ``g0 ..`` and number ``n`` of the distinct n-grams; 0 for those of uncounted texts only."""
    codes = [f"g{j}" for j in range(ORDER)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = letter_table()
        for batch in batches:
            for part in small_batches([batch]):
                for lang, text, counts in zip(*(part.column(c).to_pylist() for c in ("lang", "text", "counts"))):
                    rows = windows(letters(text, known))
                    _, starts, n = _runs(_row_hashes(rows))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(starts), pa.string()), *(pa.array(rows[starts, j].astype(np.int32)) for j in range(ORDER)),
                         pa.array((n * counts).astype(np.int64))], names=["lang", *codes, "n"])

    schema = f"lang string, {', '.join(c + ' int' for c in codes)}, n bigint"
    return numbered.mapInArrow(run, schema).groupBy("lang", *codes).agg(F.sum("n").alias("n"))


def _calibration(numbered: DataFrame, models: list[Model]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Sizes, mean log-probabilities and languages of the documents that calibrate."""
    state = [(m.grams, m.contexts, m.discounts, m.alphabet) for m in models]
    shared = numbered.sparkSession.sparkContext.broadcast(state)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer([Model(*m) for m in shared.value], letter_table())
        for batch in small_batches(batches, most=1_000_000):
            sizes, logs = scorer.score(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("nth"), pa.array(sizes, pa.int64()), pa.array(list(logs), pa.list_(pa.float64()))],
                names=["lang", "nth", "size", "logs"])

    held = numbered.where(F.col("nth") % CALIBRATION == 0).mapInArrow(run, "lang string, nth int, size bigint, logs array<double>")
    rows = sorted(held.collect(), key=lambda r: (r["lang"], r["nth"]))
    return np.array([r["size"] for r in rows]), np.array([r["logs"] for r in rows]), [r["lang"] for r in rows]


def fit(documents: DataFrame, most: int = SAMPLE, longest: int = SAMPLE_CHARS) -> Identifier | None:
    """Models from a bounded sample of labelled rows; None if no row has a language and letters.

    The bound: about ``most`` documents a language. N-grams are counted, and the calibrating documents
    scored, on the executors; the driver gets the distinct n-grams only.
    """
    numbered = _numbered(sample(documents, most, longest))
    grams = _grams(numbered).toArrow()
    names = grams.column("lang").to_numpy()
    languages = sorted(set(names))
    if not languages:
        return None
    rows = np.column_stack([grams.column(f"g{j}").to_numpy().astype(np.uint32) for j in range(ORDER)])
    numbers = grams.column("n").to_numpy().astype(np.float64)
    del grams
    alphabet = len(np.unique(rows[:, -1])) + 1
    models = []
    for lang in languages:
        own = (names == lang) & (numbers > 0)
        models.append(Model.of(rows[own], alphabet, numbers[own]))
    del rows, numbers, names
    sizes, logs, held = _calibration(numbered, models)
    truth = np.array([languages.index(lang) for lang in held])
    right = logs.argmax(axis=1) == truth
    means, limits = [], []
    for k in range(len(languages)):
        own = (truth == k) & right
        if not own.any():
            own = truth == k
        means.append(float(-logs[own, k].mean()))
        excess = (-logs[own, k] - means[k]) * np.sqrt(np.minimum(sizes[own], ENOUGH))
        # With few documents the worst one says little, so one bit per character is always allowed.
        limits.append(max(LOOSE * float(excess.max()), 20.0 * 0.7))
    return Identifier(languages, models, _scale(logs, truth), means, limits)


def _scale(logs: np.ndarray, truth: np.ndarray) -> float:
    """The factor on mean log-probabilities under which the right language gets most probability."""
    best, least = 1.0, np.inf
    for scale in (1, 2, 3, 5, 8, 12, 20, 30, 50, 80):
        z = scale * (logs - logs.max(axis=1, keepdims=True))
        loss = (np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(truth)), truth]).mean()
        if loss < least - 1e-9:
            best, least = float(scale), loss
    return best


def identify(documents: DataFrame, identifier: Identifier | None = None, *keep: str) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` for every row of ``documents``.

    Only the text decides. Null texts and texts without a letter get ``und``, score 0 and are
    rejected; without a model, so does every text. Repeated rows are judged alike.
    """
    if identifier is None:
        identifier = fit(documents)
    shared = documents.sparkSession.sparkContext.broadcast(identifier.plain() if identifier else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = Identifier.from_plain(shared.value).predictor() if shared.value else (
            lambda texts: ([UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)))
        for batch in small_batches(batches, most=1_000_000):
            names, score, rejected = predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in ("doc_id", "text_hash", "held_out")]
                + [pa.array(names, pa.string()), pa.array(score), pa.array(rejected)],
                names=["doc_id", "text_hash", "held_out", "lang_pred", "score", "rejected"])

    rows = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"),
        (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), "text")
    return rows.mapInArrow(
        run, "doc_id bigint, text_hash bigint, held_out boolean, lang_pred string, score double, rejected boolean")


def accepted(documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` that some language accepts, columns as given."""
    identifier = fit(documents)
    shared = documents.sparkSession.sparkContext.broadcast(identifier.plain() if identifier else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not shared.value:
            return
        predict = Identifier.from_plain(shared.value).predictor()
        for batch in small_batches(batches, most=1_000_000):
            _, _, rejected = predict(batch.column("text").to_pylist())
            yield batch.filter(pa.array(~rejected))

    return documents.mapInArrow(run, documents.schema)
