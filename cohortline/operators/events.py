"""The declarative event extractor (K0) with single-scan fan-out.

Every event of one raw table becomes one struct per source row; ``inline`` over the
array of structs emits them from a single scan of the table (three events of one
table cost one scan, not three). Rows then drop out by two rules: a dynamic event
whose time is null or does not parse (B4, D2), and an event whose leading code part
is a null column (B5, D1). Static events (``time: None``) keep a null time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortline.functions.codes import code_column, code_parts, column_ref
from cohortline.functions.times import parse_time, static_time
from cohortline.functions.values import typed_value
from cohortline.plans.event_spec import RESERVED_KEYS, SUBJECT_ID_COL
from cohortline.schemas import CORE_COLUMNS, EVENT_COLUMNS, EVENT_TYPES


def value_columns(events: dict[str, dict]) -> list[str]:
    """Output columns the given events fill, in the declared output order; columns that
    only a user's own specification names come last, by name."""
    used = {k for ev in events.values() for k in ev if k not in RESERVED_KEYS}
    core = {n for n, _ in CORE_COLUMNS}
    return [n for n, _ in EVENT_COLUMNS if n in used or n in core] + sorted(used - set(EVENT_TYPES))


def _typed(types: dict, ref: str, target) -> Column:
    """The input column ``ref`` in the output type (no cast when it already is)."""
    name = column_ref(ref) or ref
    if name not in types:
        return _null(target)
    if types[name] == target:
        return F.col(f"`{name}`")
    return typed_value(F.col(f"`{name}`"), target)


_NULLS: dict[str, Column] = {}


def _null(target) -> Column:
    key = target.simpleString()
    if key not in _NULLS:
        _NULLS[key] = F.lit(None).cast(target)
    return _NULLS[key]


def _time_key(names: frozenset[str], ev: dict) -> tuple | None:
    if ev.get("time") is None:
        return None
    name = column_ref(ev["time"]) or ev["time"]
    if name not in names:
        return None
    fmts = ev.get("time_format")
    return name, tuple([fmts] if isinstance(fmts, str) else (fmts or []))


def event_struct(types: dict, ev: dict, columns: list[str], parsed: dict[tuple, str]) -> Column:
    """One event of one row as a struct of ``columns`` plus the ``_keep`` flag.

    ``parsed`` names the columns holding already parsed times (one per distinct
    source column and formats), so a time shared by several events is parsed once.
    """
    names = frozenset(types)
    code, keep = code_column(names, ev["code"])
    key = _time_key(names, ev)
    if ev.get("time") is None:
        time = static_time()
    elif key is None:
        time = static_time()
        keep = F.lit(False)
    else:
        time = F.col(parsed[key])
        keep = keep & time.isNotNull()
    fields: list[Column] = []
    for name in columns:
        target = EVENT_TYPES.get(name, T.StringType())
        if name == "subject_id":
            value = _typed(types, SUBJECT_ID_COL, target)
        elif name == "time":
            value = time
        elif name == "code":
            value = code
        else:
            value = _typed(types, ev[name], target) if name in ev else _null(target)
        fields.append(value.alias(name))
    return F.struct(*fields, keep.alias("_keep"))


def _with_times(df: DataFrame, schema: T.StructType, events: dict[str, dict]) -> tuple[DataFrame, dict[tuple, str]]:
    """``df`` with the times of ``events`` parsed, and the columns that hold them."""
    names = frozenset(schema.names)
    parsed: dict[tuple, str] = {}
    time_cols = []
    for ev in events.values():
        key = _time_key(names, ev)
        if key is not None and key not in parsed:
            parsed[key] = f"_time{len(parsed)}"
            name, fmts = key
            time_cols.append(parse_time(F.col(f"`{name}`"), list(fmts) or None,
                                        schema[name].dataType).alias(parsed[key]))
    return df.select("*", *time_cols) if time_cols else df, parsed


def extract_events(df: DataFrame, events: dict[str, dict], columns: list[str] | None = None) -> DataFrame:
    """All ``events`` of one table, from one scan of ``df``.

    ``columns`` names the output columns that are wanted (all by default). Nothing can be
    pruned through the generator, so the others are not built and not read."""
    wanted = value_columns(events)
    columns = wanted if columns is None else [c for c in wanted if c in columns]
    schema = df.schema  # one JVM round trip; DataFrame.schema is not cached
    base, parsed = _with_times(df, schema, events)
    types = {f.name: f.dataType for f in schema.fields}
    types.update({alias: EVENT_TYPES["time"] for alias in parsed.values()})
    structs = [event_struct(types, ev, columns, parsed) for ev in events.values()]
    if len(structs) == 1:
        out = base.select(structs[0].alias("_e")).select("_e.*")
    else:
        out = base.select(F.inline(F.array(*structs)))
    return out.filter(F.col("_keep")).drop("_keep")


@dataclass(frozen=True)
class EventRows:
    """Rows of a table from which its events can be made later, all that they need in few columns:
    ``subject_id``, each of their times parsed once, and the columns that they name.

    ``events``: for each event its specification and the column of its time (None: static). None
    instead of a list: ``rows`` are events already."""

    rows: DataFrame
    events: list[tuple[dict, str | None]] | None = None

    def columns(self) -> list[str]:
        """Columns of the events."""
        if self.events is None:
            return self.rows.columns
        return value_columns({str(i): ev for i, (ev, _) in enumerate(self.events)})

    def structs(self, columns: dict[str, T.DataType], types: dict, prefix: str) -> list[Column]:
        """Structs of ``columns`` and ``_keep``, one an event, for rows whose columns, of ``types``,
        were given ``prefix`` (``subject_id`` was not)."""
        own = {"subject_id": types["subject_id"]} | {prefix + n: t for n, t in types.items() if n != "subject_id"}
        if self.events is None:
            name = lambda n: n if n == "subject_id" else prefix + n
            return [F.struct(*[_typed(own, name(n), t).alias(n) for n, t in columns.items()], F.lit(True).alias("_keep"))]
        out = []
        for ev, at in self.events:
            parts = [_prefixed(p, types, prefix) if column_ref(p) else p for p in code_parts(ev["code"])]
            code, keep = code_column(frozenset(own), parts)
            time = static_time() if at is None else F.col(f"`{prefix}{at}`")
            fields = {"subject_id": F.col("subject_id"), "time": time, "code": code}
            for n, t in columns.items():
                if n not in fields:
                    fields[n] = _typed(own, _prefixed(ev[n], types, prefix), t) if n in ev else _null(t)
            keep = keep if at is None else keep & time.isNotNull()
            out.append(F.struct(*[fields[n].alias(n) for n in columns], keep.alias("_keep")))
        return out


def _prefixed(ref: str, types: dict, prefix: str) -> str:
    """A reference to a column, renamed; the table's own subject, whatever its type, is ``_subject``."""
    name = column_ref(ref) or ref
    name = "_subject" if name == SUBJECT_ID_COL else name
    return f"col({prefix}{name})" if name in types else f"col({prefix})"


def event_rows(df: DataFrame, events: dict[str, dict]) -> EventRows:
    """What ``extract_events`` of ``df`` is made of, without rows whose times or codes are null. (A filter
    by the parsed times would be moved below their parsing, and have them parsed twice.)"""
    schema = df.schema
    types = {f.name: f.dataType for f in schema.fields}
    base, parsed = _with_times(df, schema, events)
    kept, used, some = [], dict.fromkeys(parsed.values()), F.lit(False)
    for ev in events.values():
        key = _time_key(frozenset(types), ev)
        if ev.get("time") is not None and key is None:
            continue        # its time is no column: no such event
        at = parsed[key] if key is not None else None
        _, keep = code_column(frozenset(types), ev["code"])
        some = some | (keep if at is None else keep & F.col(f"`{key[0]}`").isNotNull())
        kept.append((ev, at))
        refs = [column_ref(p) for p in code_parts(ev["code"])] + [column_ref(v) or v for k, v in ev.items() if k not in RESERVED_KEYS]
        used |= dict.fromkeys(r for r in refs if r in types)
    subject = _typed(types, SUBJECT_ID_COL, EVENT_TYPES["subject_id"]).alias("subject_id")
    rows = base.filter(some).select(
        subject, *[F.col(f"`{c}`").alias("_subject" if c == SUBJECT_ID_COL else c) for c in used])
    return EventRows(rows, kept)
