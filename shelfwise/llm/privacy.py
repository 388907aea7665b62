"""Personal data and the terms that give it away, with built-in functions only.

Emails, addresses, card and phone numbers are found by pattern and checked. Every value found is
a protected entity. A term, any word, discloses an entity as far as the corpus says so: with n(e), n(t)
and n(e, t) the distinct texts that hold the entity, the term, and both, the pointwise mutual
information ``log(N n(e,t) / (n(e) n(t)))`` is compared with the information ``log(N / n(e))`` of the
entity itself. The joint count is weighed as evidence: what enters is its lower bound, ``DEVIATIONS`` standard
deviations of a share observed in n(t) texts below it. So a term of one text alone discloses what that text holds, five
joint texts of six say much, and one of two says nothing. A term that carries at least
``DISCLOSURE`` of the information is generalised like the entity, in every text that holds the term.

Two cases follow from that bound and keep the work small. A term of a single text discloses every entity of it, and
is found from the term counts alone. Any other term needs an entity of two texts or more, and has itself no more
texts than that entity allows; such terms are few, and their texts are looked up past the
``QUIET`` most frequent terms, which every task leaves out before a word is sent anywhere.

Texts are known by two hashes of 64 bits each. Positions come from the pieces between matches, so no function outside
Spark's own is needed. The patterns are those of the contract in a form that neither backtracks over
long runs nor recurses: possessive, and starting at the beginning of a run or where the last match ended.

Null texts hold nothing and stay null; repeated rows and texts get the same spans; empty tables give empty results;
other columns, whatever their names, are carried along untouched by :func:`sanitised`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.llm.common import stored

KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
DISCLOSURE = 0.9    # share of an entity's information
DEVIATIONS = 1.64   # below the observed joint count: a lower bound that holds in 95 of 100 cases
QUIET = 200_000     # frequent terms that every task knows: the bound of what is broadcast
SPAN = "array<struct<start:int,end:int,value:string>>"
NOT_LETTERS = r"[^\p{L}]+"


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = lambda p: F.ltrim(p, F.lit("0"))
        return F.forall(F.split(value, r"\."), lambda p: (F.length(part(p)) <= 3)
                        & (F.coalesce(part(p).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        digits = F.translate(value, " -", "")
        return F.length(digits).between(16, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(F.regexp_replace(value, "[^0-9]", "")).between(8, 15)
    return F.lit(True)


def _spans(text: Column, pattern: Column) -> Column:
    """Start, end and value of the leftmost non-overlapping matches, in code points."""
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    pieces = F.split(text, pattern, -1)
    pairs = F.zip_with(found, F.slice(pieces, 1, F.size(found)), lambda m, p: F.struct(
        F.length(p).alias("before"), F.length(m).alias("size"), m.alias("value")))
    none = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def step(acc: Column, p: Column) -> Column:
        start = acc["at"] + p["before"]
        end = start + p["size"]
        span = F.struct(start.alias("start"), end.alias("end"), p["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    return F.aggregate(pairs, none, step, lambda acc: acc["out"])


def base_spans(text: Column, kind: str) -> Column:
    """The valid matches of a kind; none for a null text."""
    sign = {"email": "@", "ip": ".", "card": None, "phone": "+"}[kind]
    quick = text.contains(sign) if sign else text.rlike("[0-9]")
    spans = F.when(quick, _spans(text, F.lit(PATTERNS[kind]))).otherwise(F.array().cast(SPAN))
    return F.filter(F.coalesce(spans, F.array().cast(SPAN)), lambda s: _valid(kind, s["value"]))


def text_key() -> Column:
    """Two hashes of the text, null for a null text."""
    return F.when(F.col("text").isNotNull(), F.struct(
        F.xxhash64("text").alias("a"), F.xxhash64(F.lit("second"), "text").alias("b")))


def _terms(text: Column) -> Column:
    """The distinct words of a whole text, in lower case."""
    return F.filter(F.array_distinct(F.split(F.lower(text), NOT_LETTERS)), lambda w: w != "")


def _each(kind: str, make) -> Column:
    """``make(kind, span)`` for every span in the column of a kind."""
    return F.transform(kind, lambda s: make(kind, s))


def _found(documents: DataFrame) -> DataFrame:
    """``doc_id, key, email, ip, card, phone, entities`` of every row, without the text."""
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", text_key().alias("key"))
    rows = rows.select("*", *[base_spans(F.col("text"), kind).alias(kind) for kind in KINDS])
    entities = F.array_distinct(F.concat(*[
        _each(kind, lambda kind, s: F.concat(F.lit(f"{kind}:"), F.lower(s["value"]))) for kind in KINDS]))
    plain = lambda kind: F.transform(kind, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    return rows.select("doc_id", "key", *[plain(kind).alias(kind) for kind in KINDS], entities.alias("entities"))


def _once(documents: DataFrame, copies: DataFrame) -> DataFrame:
    """``key, text`` of every distinct text. Only texts with copies move, once for each task; all others are distinct where they lie."""
    texts = documents.where(F.col("text").isNotNull()).select(text_key().alias("key"), "text")
    repeated = texts.join(copies, "key", "left_semi").groupBy("key").agg(F.first("text").alias("text"))
    return texts.join(copies, "key", "left_anti").unionByName(repeated)


def _words(texts: DataFrame) -> DataFrame:
    return texts.select("key", F.explode(_terms(F.col("text"))).alias("term"))


def _quiet(terms: DataFrame, condition: Column) -> DataFrame:
    """The most frequent of the terms that the condition holds for: ``QUIET`` at most, so they may be broadcast."""
    return F.broadcast(terms.where(condition).orderBy(F.desc("n_t"), "term").limit(QUIET).select("term"))


def disclosing_terms(documents: DataFrame, found: DataFrame, disclosure: float = DISCLOSURE) -> DataFrame:
    """``key, term``: the terms that give away some entity, in every text that holds them."""
    copies = found.where(F.col("key").isNotNull()).groupBy("key").agg(F.count(F.lit(1)).alias("c"))
    n = copies.count()
    once = _once(documents, stored(copies.where("c > 1").select("key"), "copies"))
    terms = stored(_words(once).groupBy("term").agg(F.count(F.lit(1)).alias("n_t"), F.min("key").alias("key")), "terms-counted")

    mentions = found.select("key", F.explode("entities").alias("entity")).distinct()
    counts = mentions.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e")).where(F.col("n_e") < n)
    mentions = stored(mentions.join(counts, "entity"), "mentions")
    alone = terms.where("n_t = 1").select("key", "term").join(mentions.select("key").distinct(), "key", "left_semi")

    def bound(n_e: Column) -> Column:
        """The texts that a disclosing term may have when all of the entity's are among them; a little more, for rounding."""
        return F.pow(F.lit(float(n)), F.lit(1 - disclosure)) * F.pow(n_e.cast("double"), F.lit(disclosure)) * (1 + 1e-6)

    held = stored(mentions.where("n_e > 1").groupBy("key").agg(
        F.collect_list(F.struct("entity", "n_e")).alias("entities"), F.max("n_e").alias("most")), "entities")
    most = held.agg(F.max("most")).first()[0] or 0
    common = _quiet(terms, F.col("n_t") > bound(F.lit(most)))
    near = (_words(once.join(held.select("key"), "key", "left_semi")).join(common, "term", "left_anti")
            .join(terms.where("n_t > 1").select("term", "n_t"), "term").join(held, "key"))
    pairs = (near.select("term", "n_t", F.explode(F.filter("entities", lambda e: F.col("n_t") <= bound(e["n_e"]))).alias("e"))
             .groupBy("e.entity", "e.n_e", "term", "n_t").agg(F.count(F.lit(1)).alias("n_et")))
    share = F.col("n_et") / F.col("n_t")
    least = F.col("n_et") - DEVIATIONS * F.sqrt(F.col("n_et") * (1 - share))
    mutual = F.log2(F.lit(float(n)) * least / (F.col("n_e") * F.col("n_t")))  # null where the bound is not above 0
    told = stored(pairs.where(mutual >= disclosure * F.log2(F.lit(float(n)) / F.col("n_e")) - 1e-9).select("term").distinct(), "told")
    quiet = _quiet(terms.join(told, "term", "left_anti"), F.col("n_t") > 1)
    several = _words(once).join(quiet, "term", "left_anti").join(told, "term", "left_semi")
    return alone.unionByName(several)


def findings(documents: DataFrame, disclosure: float = DISCLOSURE) -> DataFrame:
    """``doc_id, key``, the spans ``email, ip, card, phone`` and ``term`` of every row of ``documents``.

    Spans are ``(start, end)`` in code points, end exclusive. Null texts have none; repeated rows
    have the same. An empty table gives an empty one.
    """
    found = stored(_found(documents), "found")
    told = disclosing_terms(documents, found, disclosure)
    told = stored(told.groupBy("key").agg(F.sort_array(F.collect_set("term")).alias("terms")), "terms")
    texts = (documents.select(text_key().alias("key"), "text").join(told, "key")
             .groupBy("key").agg(F.first("text").alias("text"), F.first("terms").alias("terms")))
    pattern = F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.array_join("terms", "|"), F.lit(r")(?!\p{L})"))
    spans = F.transform(_spans(F.col("text"), pattern), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    extra = stored(texts.select(F.col("key").alias("of"), spans.alias("near")), "term-spans")
    base = F.concat(*KINDS)
    outside = F.filter(F.col("near"), lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    none = F.array().cast("array<struct<start:int,end:int>>")
    return (found.join(extra, F.col("key") == F.col("of"), "left")
            .select("doc_id", "key", *KINDS, F.coalesce(outside, none).alias("term")))


def span_text(kinds: tuple[str, ...]) -> Column:
    """``kind:start:end`` of all spans, by kind as listed, then start, joined by commas."""
    return F.array_join(F.concat(*[
        _each(kind, lambda kind, s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))
        for kind in kinds]), ",")


def sanitised(documents: DataFrame, disclosure: float = DISCLOSURE) -> DataFrame:
    """The rows of ``documents`` with every span generalised to its kind (``<EMAIL>``), columns as given.

    Of spans that overlap, the first names the kind. ``n_chars``, if there, follows the text.
    """
    spans = F.array_sort(F.concat(*[
        _each(kind, lambda kind, s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(f"<{kind.upper()}>").alias("tag")))
        for kind in (*KINDS, "term")]))
    found = (findings(documents, disclosure).where(F.size(F.concat(*KINDS, "term")) > 0)
             .where(F.col("key").isNotNull()).select("key", spans.alias("spans")).dropDuplicates(["key"]))
    # The given columns travel as one, so that none of them can clash with the two of this join.
    rows = documents.select(text_key().alias("key"), F.struct(*documents.columns).alias("row")).join(stored(found, "spans"), "key", "left")
    text = F.col("row.text")

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        out = F.when(s["start"] >= acc["at"], F.concat(acc["out"], gap, s["tag"])).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))
    clean = F.when(F.col("spans").isNull(), text).otherwise(F.aggregate("spans", start, step, rest))
    rows = rows.withColumn("clean", clean)
    new = {"text": F.col("clean")}
    if "n_chars" in documents.columns:
        new["n_chars"] = F.length("clean").cast(documents.schema["n_chars"].dataType)
    return rows.select(*[new.get(c, F.col("row")[c]).alias(c) for c in documents.columns])
