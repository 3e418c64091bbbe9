"""Personal data: base patterns, and information-theoretic sanitisation of their context.

Base spans (e-mail, IP address, card, phone) come from fixed patterns. The method then asks
how strongly the words around a protected value give it away. Contexts are lines. For a
value e and a term t that share a line,

    disclosure(t; e) = PMI(t; e) / IC(e) = ln(P(e | t) / P(e)) / ln(1 / P(e)),
    P(e | t) = (n(t,e) + SMOOTHING P(e)) / (n(t) + SMOOTHING),  P(e) = n(e) / N,

the part of the information content of e that t reveals, with n counted over all lines of
all documents, copies included. Values and terms of every count are scored; smoothing, which
moves P(e | t) of a rare term towards P(e), stands in place of a least count. Terms over
``REMOVE`` are removed, those over ``GENERALISE`` replaced by a placeholder, wherever they
stand in a line with the value.

All of it is DataFrame code. Values, lines and terms are counted with partial sums; the
corpus count keeps only terms that share a line with a value, found by a bitmap of their hashes
before anything is shuffled.

Patterns are written with possessive quantifiers and a run-start test, which match the same
strings as the plain patterns but need neither recursion nor rescans of long runs.

Defined results: a null text counts as empty and has no spans; positions are code points of
the whole text, end exclusive; rows that repeat id and text get equal spans; rows that repeat
only the id are judged by their own text; long texts are taken whole; extra columns are
carried by ``sanitise``, with names it adds replaced; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.llm.common import col, saved, whole_text
from cohortline.llm.hash_filter import among

KINDS = ("email", "ip", "card", "phone")
TERM_KINDS = ("generalise", "remove")     # spans of the method, after the base kinds

LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
WORD = r"[\p{L}\p{N}]+"

SMOOTHING = 1.25         # occurrences of a term that are added at the value's corpus rate
GENERALISE, REMOVE = 0.8, 0.95


def positions(text: Column, pattern: str, matches: Column) -> Column:
    """[(start, end, match)] of a pattern's matches, found from the pieces between them."""
    pieces = F.split(text, pattern, -1)
    start = F.struct(F.lit(0).alias("at"), F.expr(
        "cast(array() as array<struct<start: int, end: int, match: string>>)").alias("out"))

    def step(state: Column, i: Column) -> Column:
        begin = state["at"] + F.length(F.get(pieces, i))
        match = F.get(matches, i)
        end = begin + F.length(match)
        return F.struct(end.alias("at"), F.array_append(
            state["out"], F.struct(begin.alias("start"), end.alias("end"), match.alias("match"))).alias("out"))

    found = F.aggregate(F.sequence(F.lit(0), F.size(matches) - 1), start, step, lambda s: s["out"])
    return F.when(F.size(matches) > 0, found).otherwise(
        F.expr("cast(array() as array<struct<start: int, end: int, match: string>>)"))


def _valid(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False)))
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)
    if kind == "phone":
        return n.between(10, 15)

    def luhn(total: Column, i: Column) -> Column:
        digit = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(i % 2 == 1, digit).when(twice > 9, twice - 9).otherwise(twice)

    passes = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), luhn) % 10 == 0
    return F.when(n.between(14, 19), passes).otherwise(False)


def _kept(number: int, kind: str) -> Column:
    """The valid matches of a kind, with its number in place of its name."""
    valid = F.filter(f"__p_{kind}", lambda s: _valid(kind, s["match"]))
    return F.transform(valid, lambda s: F.struct(
        s["start"].alias("start"), F.lit(number).alias("kind"), s["end"].alias("end"), s["match"].alias("match")))


def base_spans(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` plus ``__spans``: [(start, kind, end, match)] sorted by start, then kind."""
    content = whole_text(text)
    digits = content.rlike("[0-9]")
    needed = {"email": F.contains(content, F.lit("@")), "ip": digits, "card": digits,
              "phone": F.contains(content, F.lit("+")) & digits}
    none = F.expr("cast(array() as array<string>)")
    out = docs.withColumns({
        f"__m_{k}": F.when(needed[k], F.regexp_extract_all(content, F.lit(PATTERNS[k]), F.lit(0))).otherwise(none)
        for k in KINDS})
    out = out.withColumns({f"__p_{k}": positions(content, PATTERNS[k], F.col(f"__m_{k}")) for k in KINDS})
    spans = [_kept(i, k) for i, k in enumerate(KINDS)]
    out = out.withColumn("__spans", F.array_sort(F.concat(*spans)))
    return out.drop(*[f"__{x}_{k}" for x in "mp" for k in KINDS])


def _value(kind: Column, match: Column) -> Column:
    """A protected value, whatever its spelling: e-mails in lower case, digits of the others."""
    plain = F.when(kind == 0, F.lower(match)).when(kind == 1, match).otherwise(F.regexp_replace(match, "[^0-9]", ""))
    return F.concat(kind.cast("string"), F.lit(":"), plain)


def _terms(line: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(line), F.lit(WORD), F.lit(0)))


def disclosing_terms(docs: DataFrame, contexts: DataFrame, text: str) -> DataFrame:
    """(value, term, action) of the terms that give a value away.

    ``contexts``: (value, line_hash, line), one row per value and line with it."""
    lines = saved(contexts.groupBy("value", "line_hash").agg(F.first("line").alias("line"), F.count("*").alias("copies")))
    of_value = lines.groupBy("value").agg(F.sum("copies").alias("n_e"))
    shared = saved(
        lines.select("value", "copies", F.explode(_terms(F.col("line"))).alias("term"))
        .groupBy("value", "term").agg(F.sum("copies").alias("n_te"))
        .join(of_value, "value")
    )
    wanted = saved(shared.select("term").distinct().withColumn("hash", F.xxhash64("term")))
    all_lines = docs.select(F.explode(F.split(whole_text(text), "\n")).alias("line")).filter("line != ''")
    every_term = all_lines.select(F.explode(_terms(F.col("line"))).alias("term"))
    # only terms that may be wanted are counted and shuffled
    counted = among(every_term.withColumn("__h", F.xxhash64("term")), "__h", wanted, "hash").filter("__among")
    of_term = counted.groupBy("term").agg(F.count("*").alias("n_t")).join(wanted.select("term"), "term")
    total = all_lines.agg(F.count("*").alias("n"))
    rate = F.col("n_e") / F.col("n")
    given = (F.col("n_te") + SMOOTHING * rate) / (F.col("n_t") + SMOOTHING)
    score = F.log(given / rate) / F.log(1 / rate)
    return (
        shared.join(of_term, "term").join(F.broadcast(total))
        .withColumn("score", F.when(F.col("n") > F.col("n_e"), score)).filter(F.col("score") >= GENERALISE)
        .select("value", "term", F.when(F.col("score") >= REMOVE, len(KINDS) + 1).otherwise(len(KINDS)).alias("kind"))
    )


def detect(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: id, ``text_hash`` (xxhash64), ``base`` and ``spans``, both lists of
    (start, kind number, end) sorted by start and kind."""
    rows = docs.select(col(id_col).alias("__id"), whole_text(text).alias("__text"))
    rows = base_spans(rows, "__text").withColumn("__text_hash", F.xxhash64("__text"))
    # each line that holds a base span, once, with its place
    line_start = F.array_distinct(F.transform("__spans", lambda s: s["start"] - F.length(
        F.substring_index(F.substring(F.col("__text"), F.lit(1), s["start"]), "\n", -1))))
    lines = F.transform(line_start, lambda a: F.struct(a.alias("at"), F.substring_index(
        F.substring(F.col("__text"), a + 1, F.length("__text")), "\n", 1).alias("line")))
    found = saved(rows.select("__id", "__text_hash", "__spans", lines.alias("__lines")))
    in_line = found.select("__id", "__text_hash", "__spans", F.explode("__lines").alias("l")).select(
        "__id", "__text_hash", "__spans", "l.at", "l.line", F.xxhash64("l.line").alias("line_hash"))
    here = F.filter("__spans", lambda s: (s["start"] >= F.col("at")) & (s["start"] < F.col("at") + F.length("line")))
    contexts = saved(in_line.select("__id", "__text_hash", "at", "line", "line_hash", F.explode(F.array_distinct(
        F.transform(here, lambda s: _value(s["kind"], s["match"])))).alias("value")))
    terms = saved(disclosing_terms(docs, contexts, text).withColumn("pair", F.xxhash64("value", "term")))
    # a line's own words meet the terms of its values, so rows grow with the words of lines; only
    # words that may be such a term are shuffled
    own = contexts.select("__id", "__text_hash", "at", "line", "value", F.explode(_terms(F.col("line"))).alias("term"))
    own = among(own.withColumn("__pair", F.xxhash64("value", "term")), "__pair", terms, "pair").filter("__among")
    # the strongest action per line and term
    acts = (
        own.drop("__pair", "__among").join(terms.drop("pair"), ["value", "term"])
        .groupBy("__id", "__text_hash", "at", "line", "term").agg(F.max("kind").alias("kind"))
        .groupBy("__id", "__text_hash", "at", "line").agg(
            F.map_from_entries(F.collect_list(F.struct("term", "kind"))).alias("acts"))
    )
    words = F.regexp_extract_all(F.col("line"), F.lit(WORD), F.lit(0))
    between = F.split(F.regexp_replace("line", r"\x00", " "), WORD, -1)
    # terms to act on stand between NULs, so that only they are counted through, not all words
    hit = lambda w: F.coalesce(F.map_contains_key(F.col("acts"), F.lower(w)), F.lit(False))
    marked = F.array_join(F.zip_with(between, F.col("__words"), lambda p, w: F.concat(
        p, F.when(hit(w), F.concat(F.lit("\0"), w, F.lit("\0"))).otherwise(F.coalesce(w, F.lit(""))))), "")
    acts = acts.withColumn("__words", words).withColumn("__marked", marked)
    acts = acts.withColumn("__at", positions(F.col("__marked"), r"\x00[^\x00]*+\x00", F.filter("__words", hit)))
    added = (
        acts.select("__id", "__text_hash", F.transform("__at", lambda s: F.struct(
            (s["start"] + F.col("at")).alias("start"), F.element_at(F.col("acts"), F.lower(s["match"])).alias("kind"),
            (s["end"] + F.col("at")).alias("end"))).alias("spans"))
        .groupBy("__id", "__text_hash").agg(F.array_distinct(F.flatten(F.collect_list("spans"))).alias("__added"))
        .withColumnsRenamed({"__id": "__id2", "__text_hash": "__hash2"})
    )
    base = F.transform("__spans", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    joined = found.select("__id", "__text_hash", base.alias("base")).join(
        added, F.col("__id").eqNullSafe(F.col("__id2")) & (F.col("__text_hash") == F.col("__hash2")), "left")
    free = F.filter("__added", lambda s: ~F.exists("base", lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"])))
    spans = F.when(F.col("__added").isNull(), F.col("base")).otherwise(F.array_sort(F.concat(F.col("base"), free)))
    return joined.select(F.col("__id").alias(id_col), F.col("__text_hash").alias("text_hash"), "base", spans.alias("spans"))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with spans of base kinds and generalised terms replaced by ``<kind>`` and
    removed terms left out; where spans overlap, the first stands for all."""
    found = detect(docs, id_col, text).dropDuplicates([id_col, "text_hash"]).select(
        col(id_col).alias("__id2"), "text_hash", "spans")
    names = F.array(*[F.lit(f"<{k}>") for k in (*KINDS, "term")], F.lit(""))
    content = whole_text(text)

    def step(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        grown = F.concat(state["out"], F.substring(content, state["at"] + 1, s["start"] - state["at"]), F.get(names, s["kind"]))
        return F.struct(F.greatest(s["end"], state["at"]).alias("at"), F.when(fresh, grown).otherwise(state["out"]).alias("out"))

    clean = F.aggregate("spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                        lambda s: F.concat(s["out"], F.substring(content, s["at"] + 1, F.length(content))))
    joined = docs.withColumn("__text_hash", F.xxhash64(content)).join(
        found, col(id_col).eqNullSafe(F.col("__id2")) & (F.col("__text_hash") == F.col("text_hash")), "left")
    return joined.select(*[
        F.when(F.size("spans") > 0, clean).otherwise(docs[c]).alias(c) if c == text else docs[c] for c in docs.columns])
