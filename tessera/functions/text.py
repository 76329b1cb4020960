"""Text and identity functions (survey D): built-in expressions, Python only where Spark has no equal."""

from __future__ import annotations

import json
import unicodedata
from urllib.parse import quote, unquote, urlsplit, urlunsplit

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What Python's str.isspace takes for white space: Java's Unicode class lacks U+001C to U+001F.
SPACE = r"[\s\x1c-\x1f]"
UNIT_SEPARATOR = "\x1f"
ASCII_ONLY = r"\A[\x00-\x7F]*\z"


def normalize_text(text: Column) -> Column:
    """No leading byte order mark, and every kind of line end as a line feed."""
    plain = F.when(text.startswith("\ufeff"), text.substr(F.lit(2), F.length(text))).otherwise(text)
    return F.regexp_replace(plain, "\r\n?|\u2028|\u2029", "\n")


def normalized_content(text: Column) -> Column:
    """Normalised text without line feeds at its end."""
    return F.regexp_replace(normalize_text(text), r"\n+\z", "")


def sha256(text: Column) -> Column:
    """D3: hex SHA-256 of the UTF-8 bytes."""
    return F.sha2(text.cast("binary"), 256)


def content_hash(text: Column) -> Column:
    return sha256(normalized_content(text))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?U)\A{SPACE}+|{SPACE}+\z", "")


def collapse_whitespace(text: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return strip(F.regexp_replace(text, rf"(?U){SPACE}+", " "))


def is_blank(text: Column) -> Column:
    return F.coalesce(strip(text), F.lit("")) == ""


@F.arrow_udf(T.StringType())
def _nfkc(texts: pa.Array) -> pa.Array:
    return pa.array([x.as_py() and unicodedata.normalize("NFKC", x.as_py()) for x in texts], pa.string())


@F.arrow_udf(T.StringType())
def _casefold(texts: pa.Array) -> pa.Array:
    return pa.array([x.as_py() and x.as_py().casefold() for x in texts], pa.string())


def _beyond_ascii(function, text: Column, otherwise: Column) -> Column:
    """Texts of ASCII alone pass Python as null and take the built-in way."""
    return F.coalesce(function(F.when(~text.rlike(ASCII_ONLY), text)), otherwise)


def nfkc(text: Column) -> Column:
    return _beyond_ascii(_nfkc, text, text)


def identity_text(text: Column) -> Column:
    """NFKC, trimmed, white space collapsed, case folded."""
    collapsed = collapse_whitespace(nfkc(text))
    return _beyond_ascii(_casefold, collapsed, F.lower(collapsed))


def tokens_of(normalized: Column) -> Column:
    """The distinct tokens between white space of a text that has been through NFKC, which changes nothing the second time."""
    return F.array_distinct(F.filter(F.split(normalized, rf"(?U){SPACE}+"), lambda x: x != ""))


def token_set(text: Column) -> Column:
    """The distinct tokens between white space, after NFKC."""
    return tokens_of(nfkc(text))


def joined(*parts: Column, by: str = UNIT_SEPARATOR) -> Column:
    """Parts as text, null as None, with a separator between."""
    return F.concat_ws(by, *(F.coalesce(p.cast("string"), F.lit("None")) for p in parts))


def stable_id(prefix: str, *parts: Column, length: int = 40) -> Column:
    """A prefixed id from the parts' hash."""
    return F.concat(F.lit(f"{prefix}_"), F.left(sha256(joined(*parts)), F.lit(length)))


@F.arrow_udf(T.StringType())
def _dumps(texts: pa.Array) -> pa.Array:
    return pa.array([json.dumps(x.as_py(), ensure_ascii=False) if x.is_valid else None for x in texts], pa.string())


#: Characters that JSON writes with a letter, and those that need a number and so Python's way of writing it.
_ESCAPES = (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\b", "\\b"), ("\f", "\\f"))
_NUMBERED = r"[\x00-\x07\x0b\x0e-\x1f]"


def json_string(text: Column) -> Column:
    """A JSON string as canonical JSON has it: nothing beyond ASCII is escaped. Null gives null."""
    escaped = text
    for raw, shown in _ESCAPES:
        escaped = F.replace(escaped, F.lit(raw), F.lit(shown))
    odd = text.rlike(_NUMBERED)
    return F.when(odd, _dumps(F.when(odd, text))).otherwise(F.concat(F.lit('"'), escaped, F.lit('"')))


def canonical_object(**fields: Column) -> Column:
    """A canonical JSON object: keys sorted, no spaces, null written out. Values are strings, whole numbers or flags."""
    parts: list[Column] = []
    for i, name in enumerate(sorted(fields)):
        value = fields[name]
        parts += [F.lit(("," if i else "{") + json.dumps(name) + ":"), F.coalesce(value, F.lit("null"))]
    return F.concat(*parts, F.lit("}"))


def config_hash(**options: Column) -> Column:
    """The hash of a parser's options, each given as JSON."""
    return sha256(canonical_object(**options))


def canonical_json(value: Column) -> Column:
    """D4, for structs whose fields stand in sorted order and hold strings, integers and arrays of such."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def _canonical(text: str | None) -> str | None:
    if text is None:
        return None
    try:
        return json.dumps(json.loads(text), ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    except ValueError:
        return None


@F.arrow_udf(T.StringType())
def canonical_text(texts: pa.Array) -> pa.Array:
    """JSON text in its canonical form: keys sorted at every level, no spaces, nothing beyond ASCII escaped, and numbers
    as Python prints them: the shortest that reads back as the same double. Of repeated keys the last counts. Null for null
    and for what isn't JSON."""
    return pa.array([_canonical(x.as_py()) for x in texts], pa.string())


def canonical_value(value: Column) -> Column:
    """D4, for structs, maps and arrays of any depth, VARIANT among them; null members and elements are written out."""
    return canonical_text(F.to_json(value, {"ignoreNullFields": "false"}))


def _normal_url(value: str | None) -> str | None:
    if value is None:
        return None
    try:
        parts = urlsplit(value.strip())
        port = parts.port
    except ValueError:
        return None
    scheme = parts.scheme.lower()
    if scheme not in ("http", "https") or not parts.hostname:
        return None
    host = parts.hostname.lower()
    if port and (scheme, port) not in (("http", 80), ("https", 443)):
        host = f"{host}:{port}"
    path = quote(unquote(parts.path or "/"), safe="/%:@")
    return urlunsplit((scheme, host, path if path == "/" else path.rstrip("/"), parts.query, ""))


@F.arrow_udf(T.StringType())
def _url(values: pa.Array) -> pa.Array:
    return pa.array([_normal_url(x.as_py()) for x in values], pa.string())


_PLAIN_URL = r"\A(?i:https?)://[A-Za-z0-9.-]+(?:/[A-Za-z0-9._~:@/-]*)?(?:\?[A-Za-z0-9._~:@/=&-]+)?(?:#.*)?\z"


def normalize_http_url(url: Column) -> Column:
    """Null for what isn't an absolute HTTP(S) URL. URLs that need no re-quoting never reach Python."""
    plain = url.rlike(_PLAIN_URL)
    scheme = F.lower(F.regexp_extract(url, r"\A([A-Za-z]+)://", 1))
    host = F.lower(F.regexp_extract(url, r"://([^/?#]+)", 1))
    path = F.regexp_replace(F.regexp_extract(url, r"\A[A-Za-z]+://[^/?#]+([^?#]*)", 1), "/+$", "")
    query = F.regexp_extract(url, r"\A[^?#]*(\?[^#]*)", 1)
    built = F.concat(scheme, F.lit("://"), host, F.when(path == "", "/").otherwise(path), query)
    return F.when(plain, built).otherwise(_url(F.when(~plain, url)))


def canonical_source_key(name: Column, kind: Column, explicit: Column, homepage: Column) -> Column:
    """An explicit key, else the homepage, else kind and name."""
    given = lambda c: F.coalesce(c, F.lit("")) != ""
    return (
        F.when(given(explicit), F.concat(F.lit("key:"), identity_text(explicit)))
        .when(given(homepage), F.concat(F.lit("url:"), normalize_http_url(homepage)))
        .otherwise(F.concat(F.lit("name:"), kind, F.lit(":"), identity_text(name)))
    )


def source_id(workspace: Column, kind: Column, key: Column) -> Column:
    """D10."""
    return stable_id("src", workspace, kind, key)


def dedupe_key(source: Column, content: Column, parser: Column, version: Column, config: Column) -> Column:
    """A document's exact identity; the default configuration is left out."""
    parts = [source, content, parser, version]
    plain = F.coalesce(config, F.lit("default")).isin("", "default")
    return F.when(plain, sha256(joined(*parts))).otherwise(sha256(joined(*parts, config)))


def series_key(source: Column, uri: Column, idempotency: Column) -> Column:
    """What versions of one document share."""
    named = F.coalesce(idempotency, F.lit("")) != ""
    return sha256(joined(source, F.when(named, F.concat(F.lit("explicit:"), identity_text(idempotency))).otherwise(F.concat(F.lit("uri:"), uri))))


def document_id(dedupe: Column, series: Column, version: Column) -> Column:
    return stable_id("doc", dedupe, series, version)


def content_unit_id(document: Column, kind: Column, sequence: Column, text_hash: Column) -> Column:
    return stable_id("cu", document, kind, sequence, text_hash)


def fiscal_period(text: Column) -> Column:
    """2025Q3, 2025H1 or 2025 as struct<start: date, end: date>; null for anything else."""
    year = F.regexp_extract(text, r"\A(\d{4})", 1).cast("int")
    part = F.regexp_extract(text, r"[QH](\d)\z", 1)
    size = F.when(text.rlike(r"\A\d{4}Q[1-4]\z"), 3).when(text.rlike(r"\A\d{4}H[12]\z"), 6).when(text.rlike(r"\A\d{4}\z"), 12)
    number = F.when(part == "", 1).otherwise(part.cast("int"))
    first = F.make_date(year, (number - 1) * size + 1, F.lit(1))
    return F.when(size.isNotNull(), F.struct(first.alias("start"), F.last_day(F.add_months(first, size - 1)).alias("end")))


def horizon_point(text: Column) -> Column:
    """A day, month, year or epoch seconds as a timestamp; null for anything else."""
    shapes = ((r"\A\d{4}-\d{1,2}-\d{1,2}\z", "yyyy-M-d"), (r"\A\d{4}-\d{1,2}\z", "yyyy-M"), (r"\A\d{4}\z", "yyyy"))
    dated = F.coalesce(*(F.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(form))) for shape, form in shapes))
    epoch = F.when(text.rlike(r"\A\d{5,12}(?:\.\d+)?\z"), F.timestamp_seconds(text.cast("double")))
    return F.coalesce(dated, epoch)


def enum_cast(value: Column, allowed: tuple[str, ...]) -> Column:
    """The value if it is a member, else null."""
    return F.when(value.isin(*allowed), value)


def version_number(text: Column) -> Column:
    """D24."""
    return F.coalesce(text.try_cast("int"), F.lit(1))


def ordered_distinct(*arrays: Column) -> Column:
    """The first of each, in order."""
    return F.array_distinct(F.concat(*arrays))


def timestamp_seconds(text: Column) -> Column:
    """C11: [H]H:MM:SS.mmm or MM:SS.mmm, with a point or a comma, as seconds; null for anything else."""
    parts = F.split(F.replace(text, F.lit(","), F.lit(".")), ":")
    n = F.size(parts)
    hours = F.when(n == 3, F.get(parts, F.lit(0))).otherwise("0")
    value = hours.try_cast("int") * 3600 + F.get(parts, n - 2).try_cast("int") * 60 + F.get(parts, n - 1).try_cast("double")
    return F.when(text.rlike(r"\A(?:\d{1,2}:)?\d{2}:\d{2}[,.]\d{3}\z"), value)


def redact_url_password(url: Column) -> Column:
    """D28."""
    return F.regexp_replace(url, r"\A([A-Za-z0-9+.-]+://[^:/@]*):[^@/]*@", "$1:***@")
