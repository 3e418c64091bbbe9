"""Fill-in-the-middle transformation of texts: prefix, suffix and middle change places.

Method: a text is a row of units. ``regexp_count`` gives their number n, two hashes of the row
draw the cuts a <= b in 0..n, and a pattern made for the row, ``(unit{a})(unit{b-a})(rest)`` with
possessive counted quantifiers, captures prefix, middle and suffix in one match, which writes the
output at once. Possessive groups keep no way back, so the match runs in constant stack space
however long the text is. All of it is Spark's own regular expressions; nothing is shuffled.

``restore`` rebuilds the text from output and form alone. It is exact: a text that holds a
sentinel stays plain, and no sentinel may hold or overlap another one.

Defined results: a null or empty text has no units and is plain with an empty output; a null id
draws as the empty string; repeated rows (same id and text) are cut alike; an empty table stays
empty; an input column with the name of an added one is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.llm.common import col, whole_text, without

PLAIN, PSM, SPM = "plain", "psm", "spm"


@dataclass(frozen=True)
class Plan:
    """Units, draws and sentinels of a transformation.

    ``unit`` is a regular expression that matches at every place of every text and at least one
    character, so that units tile the text. ``rate`` percent of the texts are cut, ``spm`` percent
    of those have the suffix first. ``seed`` leads the hashed string."""

    unit: str = "[A-Za-z]+|[^A-Za-z]"
    seed: str = "1"
    rate: int = 90
    spm: int = 20
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        marks = (self.prefix, self.suffix, self.middle)
        # an end of one mark that starts another (or itself) would let text and mark form an
        # earlier mark together
        overlap = any(a.endswith(b[:k]) for a in marks for b in marks for k in range(1, len(b)))
        if overlap or not all(marks) or len(set(marks)) < 3 or any(a in b for a in marks for b in marks if a != b):
            raise ValueError("sentinels must not be empty, equal, or overlap one another")


def draws(doc_id: Column, seed: str) -> list[Column]:
    """h1 to h4: the first four groups of eight hex digits of the row's SHA-256 hash."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def _quoted(mark: str) -> str:
    """A sentinel as part of a replacement, where ``\\`` and ``$`` have a meaning."""
    return mark.replace("\\", "\\\\").replace("$", "\\$")


def transform(docs: DataFrame, plan: Plan = Plan(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` plus ``n`` (long, units), ``form`` (plain, psm or spm), ``output`` (string),
    ``prefix_chars`` and ``middle_chars`` (long, code points; null where plain)."""
    added = ("n", "form", "output", "prefix_chars", "middle_chars")
    work = ("__text", "__a", "__b", "__form", "__n", "__output")
    whole, (h1, h2, h3, h4) = F.col("__text"), draws(col(doc_id), plan.seed)
    n, a, b, form = F.col("__n"), F.col("__a"), F.col("__b"), F.col("__form")
    marked = whole.contains(plan.prefix) | whole.contains(plan.suffix) | whole.contains(plan.middle)
    out = without(docs, [*work, *(c for c in added if c not in (doc_id, text))]).withColumn("__text", whole_text(text))
    out = out.withColumn("__n", F.regexp_count(whole, F.lit(plan.unit)).cast("long"))
    out = out.withColumns({
        "__a": F.least(h1 % (n + 1), h2 % (n + 1)), "__b": F.greatest(h1 % (n + 1), h2 % (n + 1)),
        "__form": F.when((whole == "") | marked | (h3 % 100 >= plan.rate), PLAIN).when(h4 % 100 < plan.spm, SPM).otherwise(PSM)})
    counted = lambda times: F.concat(F.lit(f"((?:{plan.unit}){{"), times.cast("string"), F.lit("}+)"))
    pattern = F.concat(F.lit("(?s)\\A"), counted(a), counted(b - a), F.lit("(.*+)\\z"))
    p, s, m = (_quoted(x) for x in (plan.prefix, plan.suffix, plan.middle))
    order = F.when(form == SPM, f"{s}$3{p}$1{m}$2").otherwise(f"{p}$1{s}$3{m}$2")
    out = out.withColumn("__output", F.when(form == PLAIN, whole).otherwise(F.regexp_replace(whole, pattern, order)))
    first, second, third = parts(F.col("__output"), form, plan)
    prefix = F.when(form == PSM, F.char_length(first)).when(form == SPM, F.char_length(second))
    middle = F.when(form != PLAIN, F.char_length(third))
    return out.withColumns({
        "prefix_chars": prefix.cast("long"), "middle_chars": middle.cast("long"),
        "n": n, "form": form, "output": F.col("__output")}).drop(*work)


def parts(output: Column, form: Column, plan: Plan = Plan()) -> tuple[Column, Column, Column]:
    """The three pieces of an output that is not plain, in the order in which they stand."""
    opening = F.when(form == SPM, plan.suffix).otherwise(plan.prefix)
    inner = F.when(form == SPM, plan.prefix).otherwise(plan.suffix)
    body = F.substr(output, F.char_length(opening) + 1)
    before, last = F.substring_index(body, plan.middle, 1), F.substring_index(body, plan.middle, -1)
    return F.split_part(before, inner, F.lit(1)), F.split_part(before, inner, F.lit(2)), last


def restore(output: Column, form: Column, plan: Plan = Plan()) -> Column:
    """The text that ``transform`` was given, from its output and form."""
    first, second, third = parts(output, form, plan)
    return F.when(form == PLAIN, output).when(form == SPM, F.concat(second, third, first)).otherwise(F.concat(first, third, second))
