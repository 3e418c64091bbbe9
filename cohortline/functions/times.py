"""Text-to-time rules of the event specification."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The strftime directives the specification uses, and the Spark
# datetime pattern letters each one means.
STRFTIME_TO_SPARK = {
    "%Y": "yyyy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss",
    # further ones that a user's own specification may hold
    "%y": "yy", "%b": "MMM", "%h": "MMM", "%B": "MMMM", "%j": "DDD", "%I": "hh", "%p": "a", "%f": "SSSSSS",
    "%F": "yyyy-MM-dd", "%T": "HH:mm:ss", "%R": "HH:mm", "%D": "MM/dd/yy",
}


# Formats whose text is exactly what a plain cast to TIMESTAMP_NTZ reads;
# a full-match pattern guards the cast, so both accept and reject the same strings
# (the cast alone is lenient: it also takes "2021-03-14" for the first one).
FAST_FORMATS = {
    "%Y-%m-%d %H:%M:%S": r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\z",
    "%Y-%m-%d": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z",
    "%Y": r"^[0-9]{4}\z",
}


def spark_pattern(fmt: str) -> str:
    """Translate a strftime format into a Spark datetime pattern (literals quoted)."""
    out, i = [], 0
    literal = []
    while i < len(fmt):
        tok = fmt[i:i + 2]
        if tok == "%%":
            literal.append("%")
            i += 2
        elif tok in STRFTIME_TO_SPARK:
            if literal:
                out.append(_quote("".join(literal)))
                literal = []
            out.append(STRFTIME_TO_SPARK[tok])
            i += 2
        elif fmt[i] == "%":
            raise ValueError(f"unsupported time directive {tok!r} in {fmt!r}")
        else:
            literal.append(fmt[i])
            i += 1
    if literal:
        out.append(_quote("".join(literal)))
    return "".join(out)


def _quote(text: str) -> str:
    # Separators Spark reads literally need no quoting; letters do.
    return text if all(not ch.isalpha() for ch in text) else "'" + text.replace("'", "''") + "'"


def parse_time(c: Column, formats: str | list[str] | None, source_type: T.DataType | None = None) -> Column:
    """Parse text with each format in order; first full match wins, else null (D3).

    Columns that already hold a date or timestamp are only re-typed to
    TIMESTAMP_NTZ (wall clock), never re-parsed.
    """
    if isinstance(source_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return c.cast("timestamp_ntz")
    if formats is None:
        raise ValueError("a dynamic event needs a time_format")
    if isinstance(formats, str):
        formats = [formats]
    text = c.cast("string")
    parsed = [_parse_one(text, f) for f in formats]
    return parsed[0] if len(parsed) == 1 else F.coalesce(*parsed)


def _parse_one(text: Column, fmt: str) -> Column:
    if fmt in FAST_FORMATS:
        # The cast is a hand-written scanner; the formatter path is several times slower.
        return F.when(text.rlike(FAST_FORMATS[fmt]), text.try_cast("timestamp_ntz"))
    return F.try_to_timestamp(text, F.lit(spark_pattern(fmt))).cast("timestamp_ntz")


def static_time() -> Column:
    """The time of a static event: a typed null."""
    return F.lit(None).cast("timestamp_ntz")
