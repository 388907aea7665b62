"""Stupid-backoff scores against a plain count."""

import math
import re
from collections import Counter

import pytest

from shelfwise.llm import scoring


@pytest.mark.parametrize("order, least", [(1, 2), (2, 2), (3, 2), (4, 1), (5, 3)])
def test_scores_equal_plain_counts(spark, order, least):
    rows = [(r["doc_id"], r["text"], 0) for r in
            spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    rows += [(9000, None, 1), (9001, " \n", 1), (None, "one", 1), (9002, rows[0][1], 1), (9002, rows[0][1], 1), (9003, "two words", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, key int")
    low = {c: c + 32 for c in range(65, 91)}
    texts = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low)) for _, t, _ in rows]
    counts = Counter(tuple(t[i:i + k]) for k in range(1, order + 1) for t in texts for i in range(len(t) - k + 1))
    total = sum(map(len, texts))

    def word(gram):
        if len(gram) == 1:
            return math.log(counts[gram] / total)
        return math.log(counts[gram] / counts[gram[:-1]]) if counts[gram] >= least else math.log(0.4) + word(gram[1:])

    def score(t):
        return sum(word(tuple(t[max(0, i - order + 1):i + 1])) for i in range(len(t))) / len(t) if t else None

    key = lambda r: (r[0] is None, r[0] or 0)
    found = sorted(map(tuple, scoring.scores(frame, least=least, order=order).collect()), key=key)
    expected = sorted(((i, len(t), score(t)) for (i, _, _), t in zip(rows, texts)), key=key)
    for a, b in zip(found, expected, strict=True):
        assert a[:2] == b[:2] and (a[2] is None) == (b[2] is None)
        assert a[2] is None or math.isclose(a[2], b[2], rel_tol=1e-9)
    assert scoring.scores(frame.limit(0), least=least, order=order).count() == 0


def test_orders_start_at_one(spark):
    with pytest.raises(ValueError):
        scoring.scores(spark.createDataFrame([], "doc_id long, text string"), order=0)
