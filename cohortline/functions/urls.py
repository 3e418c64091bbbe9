"""References resolved against a base URL (A16): the generic rules of RFC 3986 as the usual
libraries apply them, dot segments included."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortline.functions.values import let

# Schemes whose references may be relative.
RELATIVE_SCHEMES = ("", "http", "https", "ftp", "file")
_SCHEME = r"^([a-zA-Z][a-zA-Z0-9+.\-]*):"


def _parts(url: Column) -> Column:
    """Struct of scheme, host, path, parameters of its last segment, query and fragment; absent
    ones empty."""
    def named(rest: Column) -> Column:
        path = F.regexp_extract(rest, r"(?s)^(?://[^/?#]*)?([^?#]*)", 1)
        return F.struct(
            F.regexp_extract(rest, r"^//([^/?#]*)", 1).alias("host"),
            F.regexp_replace(path, r";[^/]*$", "").alias("path"), F.regexp_extract(path, r";([^/]*)$", 1).alias("params"),
            F.regexp_extract(rest, r"(?s)^[^?#]*\?([^#]*)", 1).alias("query"),
            F.regexp_extract(rest, r"(?s)^[^#]*#(.*)$", 1).alias("fragment"))

    clean = F.regexp_replace(F.regexp_replace(url, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")
    return let(clean, lambda u: F.struct(
        F.lower(F.regexp_extract(u, _SCHEME, 1)).alias("scheme"), let(F.regexp_replace(u, _SCHEME, ""), named).alias("rest")))


def _after(mark: str, part: Column) -> Column:
    return F.when(part == "", "").otherwise(F.concat(F.lit(mark), part))


def _whole(scheme: Column, host: Column, path: Column, params: Column, query: Column, fragment: Column) -> Column:
    def rooted(p: Column) -> Column:
        slash = F.when((p == "") | p.startswith("/"), "").otherwise("/")
        return F.when(host != "", F.concat(F.lit("//"), host, slash, p)).otherwise(p)

    return F.concat(F.when(scheme == "", "").otherwise(F.concat(scheme, F.lit(":"))),
                    let(F.concat(path, _after(";", params)), rooted), _after("?", query), _after("#", fragment))


def without_dots(segments: Column) -> Column:
    """Path segments with ``.`` dropped and ``..`` dropped together with the one before it: a fold
    over a stack. A path that ends in either ends in a slash."""
    none = F.array().cast("array<string>")

    def step(stack: Column, segment: Column) -> Column:
        up = F.when(F.size(stack) > 0, F.slice(stack, F.lit(1), F.greatest(F.size(stack) - 1, F.lit(0)))).otherwise(stack)
        return F.when(segment == "..", up).when(segment == ".", stack).otherwise(F.concat(stack, F.array(segment)))

    last = F.element_at(segments, -1)
    return F.concat(F.reduce(segments, none, step), F.when(last.isin(".", ".."), F.array(F.lit(""))).otherwise(none))


def _merged(base: Column, path: Column) -> Column:
    """``path`` placed where the last segment of ``base`` was; empty segments inside are dropped
    unless the path starts at the root."""
    folder = F.regexp_replace(base, r"[^/]+$", "")
    before = F.when(base == "", F.array(F.lit(""))).when(folder == "", F.array().cast("array<string>")).otherwise(
        F.split(F.when(base.endswith("/"), base).otherwise(F.regexp_replace(base, r"/[^/]*$", "")), "/"))

    def dense(segments: Column) -> Column:
        inner = F.filter(F.slice(segments, F.lit(2), F.greatest(F.size(segments) - 2, F.lit(0))), lambda s: s != "")
        return F.when(F.size(segments) > 1, F.concat(F.slice(segments, 1, 1), inner, F.slice(segments, -1, 1))).otherwise(segments)

    segments = F.when(path.startswith("/"), F.split(path, "/")).otherwise(let(F.concat(before, F.split(path, "/")), dense))
    joined = F.array_join(let(segments, without_dots), "/")
    return let(joined, lambda j: F.when(j == "", "/").otherwise(j))


def _joined(base: Column, b: Column, reference: Column, r: Column) -> Column:
    scheme = F.when(r["scheme"] == "", b["scheme"]).otherwise(r["scheme"])
    foreign = (scheme != b["scheme"]) | ~scheme.isin(*RELATIVE_SCHEMES)
    b, r = b["rest"], r["rest"]
    same_page = (r["path"] == "") & (r["params"] == "")
    query = F.when(r["query"] == "", b["query"]).otherwise(r["query"])
    own_host, own_path = r["host"] != "", (r["host"] != "") | ~same_page
    path = F.when(own_host, r["path"]).when(same_page, b["path"]).otherwise(_merged(b["path"], r["path"]))
    whole = _whole(scheme, F.when(own_host, r["host"]).otherwise(b["host"]), path,
                   F.when(own_path, r["params"]).otherwise(b["params"]), F.when(own_path, r["query"]).otherwise(query),
                   r["fragment"])
    return F.when(base == "", reference).when(reference == "", base).when(foreign, reference).otherwise(whole)


def join_url(base: Column, reference: Column) -> Column:
    """``reference`` as seen from ``base``."""
    both = F.struct(base.alias("base"), _parts(base).alias("b"), reference.alias("reference"), _parts(reference).alias("r"))
    return let(both, lambda x: _joined(x["base"], x["b"], x["reference"], x["r"]))
