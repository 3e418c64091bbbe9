"""Code construction: composite codes, templates and collation."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values (D1): separator between code parts, and the text used for a null part.
CODE_SEPARATOR = "//"
NULL_PART = "UNK"

_COL_RE = re.compile(r"^col\((.+)\)$")


def column_ref(part: str) -> str | None:
    """Name inside ``col(name)``, or None when ``part`` is a constant."""
    m = _COL_RE.match(part.strip()) if isinstance(part, str) else None
    return m.group(1).strip() if m else None


def code_parts(code) -> list[str]:
    return [code] if isinstance(code, str) else list(code)


def code_column(df: DataFrame | frozenset, code) -> tuple[Column, Column]:
    """(code, keep) for a code given as a constant, ``col(x)``, or a list of parts.

    Parts are joined by ``//``; a null column part becomes ``UNK`` unless it is the
    leading part, in which case ``keep`` is false and the row is dropped (D1, B5).
    Columns missing from ``df`` count as null.
    """
    names = available(df)
    parts = code_parts(code)
    cols, keep = [], F.lit(True)
    for i, part in enumerate(parts):
        name = column_ref(part)
        if name is None:
            cols.append(F.lit(part))
            continue
        value = _text(names, name)
        if i == 0:
            keep = value.isNotNull()
            cols.append(value)
        else:
            cols.append(F.coalesce(value, F.lit(NULL_PART)))
    code_col = cols[0] if len(cols) == 1 else F.concat_ws(CODE_SEPARATOR, *cols)
    return code_col, keep


def available(df) -> frozenset[str]:
    """Column names of ``df`` (a DataFrame, or names already fetched).

    ``DataFrame.columns`` is a round trip to the JVM on every call, so builders
    fetch the names once and pass them along.
    """
    if isinstance(df, (set, frozenset)):
        return frozenset(df)
    return frozenset(df.columns)


def _text(names: frozenset[str], name: str) -> Column:
    if name in names:
        return F.col(f"`{name}`").cast("string")
    return F.lit(None).cast("string")


_FIELD_RE = re.compile(r"\{([^{}]+)\}")


def template(df: DataFrame | frozenset, text: str) -> Column:
    """``"ICD{icd_version}CM/{norm_icd_code}"`` -> concat of literals and columns.

    A null (or missing) column makes the whole result null, so no half-filled
    parent code is produced (H13).
    """
    names = available(df)
    pieces, pos = [], 0
    for m in _FIELD_RE.finditer(text):
        if m.start() > pos:
            pieces.append(F.lit(text[pos:m.start()]))
        pieces.append(_text(names, m.group(1)))
        pos = m.end()
    if pos < len(text):
        pieces.append(F.lit(text[pos:]))
    return pieces[0] if len(pieces) == 1 else F.concat(*pieces)


def conditional_template(df: DataFrame | frozenset, options: list[dict]) -> Column:
    """``[{template: {column: value, ...}}, ...]``: the first template whose equality
    filters all hold; null when none does (B7, H13)."""
    names = available(df)
    expr = None
    for option in options:
        (text, filters), = option.items()
        cond = F.lit(True)
        for name, value in filters.items():
            cond = cond & (_text(names, name) == F.lit(str(value)))
        expr = F.when(cond, template(names, text)) if expr is None else expr.when(cond, template(names, text))
    return expr


def collate(df: DataFrame | frozenset, columns: str | list[str]) -> Column:
    """First non-null of several columns."""
    names = available(df)
    if isinstance(columns, str):
        return _text(names, columns)
    return F.coalesce(*[_text(names, c) for c in columns])
