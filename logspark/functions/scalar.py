"""Scalar functions on columns. All are built-in expressions, so they stay in the JVM and in code generation.

A null argument gives null unless a function says otherwise. Casts that may fail give null, never an error.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Characters that part tokens, unless a caller names others.
DELIMITERS = " \t\r\n,;:=\"'()[]{}<>|/\\&?!@#$%^*+`~"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _class(chars: str) -> str:
    """A regular-expression class of the characters."""
    return "[" + "".join("\\" + c if c in "\\]^-[&~" else c for c in chars) + "]"


def tokenize(col, delims: str = DELIMITERS) -> Column:
    """C1. Non-empty parts between delimiter characters; case is kept."""
    return F.filter(F.split(_c(col), _class(delims)), lambda x: x != "") if delims else F.filter(F.array(_c(col)), lambda x: x != "")


def epoch_millis(col) -> Column:
    """C2. Epoch time in ms from s, ms, us or ns, told apart by magnitude (open bounds); null if it is none of them."""
    x = _c(col).cast("long")  # whole-number division below: a double can't hold nanoseconds
    within = lambda low, high: (x > low) & (x < high)
    return (
        F.when(within(10**12, 10**13), x)
        .when(within(10**9, 10**10), x * 1000)
        .when(within(10**15, 10**16), F.call_function("div", x, F.lit(1000)))
        .when(x > 10**18, F.call_function("div", x, F.lit(10**6)))
    )


def time_bucket(ms, resolution: int) -> Column:
    """C3. Start of the bucket of resolution ms."""
    if resolution <= 0:
        raise ValueError("resolution must be positive")
    return _c(ms) - F.pmod(_c(ms), F.lit(resolution).cast("long"))


def query_reason(scanned, matched, tasks, requests) -> Column:
    """C4. Why a query ended as it did."""
    s, m, t, r = map(_c, (scanned, matched, tasks, requests))
    return F.when((m > 0) & (r > 0), "success").when(t == 0, "empty-range").when((s > 0) & (m == 0), "bloom-miss").when((m > 0) & (r == 0), "match-no-dispatch").otherwise("unknown")


def object_hash(col) -> Column:
    """C5. URL-safe base64 of the MD5 of an object's name."""
    return F.translate(F.base64(F.unhex(F.md5(_c(col).cast("binary")))), "+/", "-_")


def series_hash(name, *labels) -> Column:
    """C6. 64-bit key of a series name and its labels; equal inputs give equal keys within Spark."""
    return F.xxhash64(_c(name), *map(_c, labels))


def poly_hash(col, start=0) -> Column:
    """C6. h = 31 * h + c over a string's characters, in wrapping 64-bit arithmetic; start chains it to an earlier hash.

    ANSI arithmetic raises where 64 bits overflow, so the two halves are multiplied apart.
    """
    low = lambda v: v.bitwiseAND(F.lit(0xFFFFFFFF))

    def step(h: Column, c: Column) -> Column:
        small = low(h) * 31 + F.coalesce(F.ascii(c), F.lit(0)).cast("long")
        large = F.shiftrightunsigned(h, 32) * 31 + F.shiftrightunsigned(small, 32)
        return F.shiftleft(low(large), 32).bitwiseOR(low(small))

    chars = F.filter(F.split(_c(col), ""), lambda c: c != "")
    return F.aggregate(chars, (F.lit(start) if isinstance(start, int) else _c(start)).cast("long"), step)


def utf8_length(col) -> Column:
    """C7. Bytes in UTF-8."""
    return F.octet_length(_c(col))


def has_control(col) -> Column:
    """C8. Whether a character below U+0020 occurs."""
    return _c(col).rlike(r"[\x00-\x1F]")


def escape_control(col) -> Column:
    """C8. Line feed, return and tab as \\n, \\r, \\t, other characters below U+0020 as \\u00XX."""
    out = F.replace(F.replace(F.replace(_c(col), F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r")), F.lit("\t"), F.lit("\\t"))
    rare = out
    for code in range(0x20):
        if code not in (9, 10, 13):
            rare = F.replace(rare, F.lit(chr(code)), F.lit(f"\\u{code:04X}"))
    return F.when(out.rlike(r"[\x00-\x1F]"), rare).otherwise(out)


def index_key(prefix, epoch, target_hash, chunk) -> Column:
    """C9. prefix/epoch/hash/chunk."""
    return F.concat_ws("/", _c(prefix), _c(epoch).cast("string"), _c(target_hash), _c(chunk).cast("string"))


def parse_index_key(col) -> Column:
    """C9. The parts of a key, counted from its end, so that the prefix may hold slashes."""
    parts = F.split(_c(col), "/")
    at = lambda i: F.element_at(parts, i)
    return F.when(F.size(parts) >= 4, F.struct(F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 3), "/").alias("prefix"), at(-3).try_cast("long").alias("epoch"), at(-2).alias("target_hash"), at(-1).try_cast("long").alias("chunk")))


def template_hash_of(line) -> Column:
    """C10. templateHash of a JSON line, null if it has none."""
    return F.get_json_object(_c(line), "$.templateHash")


def parse_duration_ns(col, default_unit: str = "ms") -> Column:
    """C11. Nanoseconds of 10s, -3m, 250 (in default_unit) or of an ISO-8601 duration in days to seconds; null if neither."""
    unit_ns = {"ns": 1, "us": 10**3, "ms": 10**6, "s": 10**9, "m": 60 * 10**9, "h": 3600 * 10**9, "d": 86400 * 10**9}
    x = F.trim(_c(col))
    unit = F.lower(F.regexp_extract(x, r"^[+-]?[0-9]+([a-zA-Z]{0,2})$", 1))
    factor = F.when(unit == "", F.lit(unit_ns[default_unit]))
    for name, ns in unit_ns.items():
        factor = factor.when(unit == name, F.lit(ns))
    simple = F.regexp_extract(x, r"^\+?(-?[0-9]+)[a-zA-Z]{0,2}$", 1).try_cast("long") * factor.cast("long")
    iso = r"(?i)^([+-]?)P(?:([+-]?[0-9]+)D)?(?:T(?:([+-]?[0-9]+)H)?(?:([+-]?[0-9]+)M)?(?:([+-]?[0-9]+)(?:[.,]([0-9]{0,9}))?S)?)?$"
    part = lambda i: F.coalesce(F.regexp_extract(x, iso, i).try_cast("long"), F.lit(0).cast("long"))
    fraction = F.rpad(F.regexp_extract(x, iso, 6), 9, "0").try_cast("long")
    sign = F.when(F.startswith(F.regexp_extract(x, iso, 5), F.lit("-")), -1).otherwise(1)
    total = ((part(2) * 86400 + part(3) * 3600 + part(4) * 60 + part(5)) * F.lit(10**9).cast("long") + F.coalesce(fraction, F.lit(0)) * sign) * F.when(F.regexp_extract(x, iso, 1) == "-", -1).otherwise(1)
    return F.when(x.rlike(r"^[+-]?[0-9]+[a-zA-Z]{0,2}$"), simple).when(x.rlike(iso) & x.rlike(r"(?i)[0-9][DHMS]$"), total)


# Time unit -> pattern of rolled output.
DATE_PATTERNS = {"s": "yyyy-MM-dd HH:mm:ss", "m": "yyyy-MM-dd HH:mm", "h": "yyyy-MM-dd HH", "H": "yyyy-MM-dd HH", "d": "yyyy-MM-dd", "D": "yyyy-MM-dd", "M": "yyyy-MM", "y": "yyyy", "Y": "yyyy"}


def date_pattern(unit: str) -> str:
    """C12. Date pattern of a rolling unit."""
    if unit not in DATE_PATTERNS:
        raise ValueError(f"unknown unit {unit!r}")
    return DATE_PATTERNS[unit]


SYSLOG = r"(?s)^<[^>]*>(?:[^ ]* ){6}(?:(?:-|(?:\[[^\]]*\])+) ?)?(.*)$"


def syslog_msg(col) -> Column:
    """C13. MSG of an RFC 5424 line; any other line stays as it is."""
    x = _c(col)
    return F.when(x.rlike(SYSLOG), F.regexp_extract(x, SYSLOG, 1)).otherwise(x)


def pick_tag(resource) -> Column:
    """C14. service.name, else k8s.pod.name, else otel; an empty value counts as missing."""
    r = _c(resource)
    return F.coalesce(F.nullif(r["service.name"], F.lit("")), F.nullif(r["k8s.pod.name"], F.lit("")), F.lit("otel"))


def tag_or(tag, field=None, default: str = "") -> Column:
    """C15. A tag, else a field's value, else a constant; empty counts as missing."""
    options = [F.nullif(_c(x).cast("string"), F.lit("")) for x in (tag, field) if x is not None]
    return F.coalesce(*options, F.lit(default))


#: A JSON string; JSON without brackets outside of strings.
STRING = r'"(?:[^"\\]++|\\.)*+"'
FLAT = rf'(?:[^\[\]{{}}"]++|{STRING})*+'


def any_value_to_json(col) -> Column:
    """C16. Plain JSON of an AnyValue given as JSON text, at any depth; null if it holds no value.

    Scalars are unwrapped at once, then lists and maps from the inside out, as often as there are any. Brackets of what
    is done stand as control characters, which JSON text never holds.
    """
    x = F.to_json(F.try_parse_json(_c(col)))
    for pattern, to in (
        (rf'\{{"stringValue":({STRING})\}}', "$1"), (r'\{"(?:boolValue|intValue|doubleValue)":"?([^"{}\[\],]*+)"?\}', "$1"), (r'\{"bytesValue":("[^"]*+")\}', "$1"),
        (r'\{"arrayValue":\{(?:"values":\[\])?\}\}', "\x01\x02"), (r'\{"kvlistValue":\{(?:"values":\[\])?\}\}', "\x03\x04"), (rf'\G((?:[^"{{]++|{STRING}|\{{(?!\}}))*+)\{{\}}', "$1null"),
    ):
        x = F.regexp_replace(x, pattern, to)

    def deeper(s: Column, _: Column) -> Column:
        s_ = F.regexp_replace(s, rf'\{{"key":({STRING}),"value":({FLAT})\}}', "$1:$2")
        s_ = F.regexp_replace(s_, rf'\{{"arrayValue":\{{"values":\[({FLAT})\]\}}\}}', "\x01$1\x02")
        return F.when(s.contains('Value":{"values":['), F.regexp_replace(s_, rf'\{{"kvlistValue":\{{"values":\[({FLAT})\]\}}\}}', "\x03$1\x04")).otherwise(s)

    def flat(s: Column) -> Column:
        levels = F.regexp_count(s, F.lit(r'\{"(?:arrayValue|kvlistValue)":'))
        nested = F.aggregate(F.sequence(F.lit(1), levels), F.regexp_replace(s, rf'\{{"key":({STRING})\}}', "$1:null"), deeper)
        return F.when(levels > 0, nested).otherwise(s)

    # As a lambda's argument x is computed once; Spark would compute it anew for each place that it is used at inside a lambda.
    return F.nullif(F.translate(F.get(F.transform(F.array(x), flat), F.lit(0)), "\x01\x02\x03\x04", "[]{}"), F.lit("null"))


def json_to_any_value(col) -> Column:
    """C16. AnyValue, as JSON text, of JSON; a null in it is an AnyValue without value. Lists and maps go through Arrow."""
    x = F.trim(_c(col))
    scalar = (
        F.when(x.rlike('^"'), F.concat(F.lit('{"stringValue":'), x, F.lit("}")))
        .when(x.isin("true", "false"), F.concat(F.lit('{"boolValue":'), x, F.lit("}")))
        .when(x.rlike(r"^-?[0-9]+$"), F.concat(F.lit('{"intValue":'), x, F.lit("}")))
        .when(x.rlike(r"^-?[0-9.]+([eE][+-]?[0-9]+)?$"), F.concat(F.lit('{"doubleValue":'), x, F.lit("}")))
    )
    return F.when(x.rlike(r"^[\[{]"), F.pandas_udf(_any_values, StringType())(F.when(x.rlike(r"^[\[{]"), x))).otherwise(scalar)


def _any_values(texts: pd.Series) -> pd.Series:
    def wrap(v):
        if v is None:
            return {}
        if isinstance(v, bool):
            return {"boolValue": v}
        if isinstance(v, list):
            return {"arrayValue": {"values": [wrap(i) for i in v]}}
        if isinstance(v, dict):
            return {"kvlistValue": {"values": [{"key": k, "value": wrap(i)} for k, i in v.items()]}}
        return {("stringValue" if isinstance(v, str) else "intValue" if isinstance(v, int) else "doubleValue"): v}

    return texts.map(lambda t: json.dumps(wrap(json.loads(t)), ensure_ascii=False, separators=(",", ":")), na_action="ignore")


def _quoted(x: Column) -> Column:
    """A string as a JSON string."""
    return F.regexp_extract(F.to_json(F.struct(x.alias("x"))), r"(?s)^\{\"x\":(.*)\}$", 1)


def otlp_body(col) -> Column:
    """C17. The body of a record: text for a string, else its JSON."""
    return F.coalesce(F.get_json_object(_c(col), "$.stringValue"), any_value_to_json(col))


#: Prefix of attributes that only carry times and resource keys between systems; a parameter where others use another.
MARKER = "_carried_"


def split_markers(attributes, prefix: str = MARKER) -> Column:
    """C18. Attributes without the carried markers."""
    return F.map_filter(_c(attributes), lambda k, v: ~k.startswith(prefix))


def join_markers(attributes, prefix: str = MARKER, **markers) -> Column:
    """C18. Attributes with markers added; a key that is there already keeps its value."""
    held = F.coalesce(_c(attributes), F.expr("cast(map() as map<string,string>)"))
    more = F.create_map(*[x for k, v in markers.items() for x in (F.lit(prefix + k), _c(v).cast("string"))])
    return F.map_concat(held, F.map_filter(more, lambda k, v: v.isNotNull() & ~F.map_contains_key(held, k)))


def observed_time(observed, time, now) -> Column:
    """C19. Observed time, else event time, else now; zero counts as missing."""
    return F.coalesce(F.nullif(_c(observed), F.lit(0)), F.nullif(_c(time), F.lit(0)), _c(now))


def flatten_values(col, kind: str) -> Column:
    """C20. Values of an array of arrays (array), a map (map) or an array of maps (maps) as one array."""
    x = _c(col)
    return {"array": lambda: F.flatten(x), "map": lambda: F.map_values(x), "maps": lambda: F.flatten(F.transform(x, lambda m: F.map_values(m)))}[kind]()


def first_or_scalar(array, scalar) -> Column:
    """C21. First element of an array, else a scalar, else the empty string."""
    return F.coalesce(F.get(_c(array), F.lit(0)), _c(scalar), F.lit(""))


# Enrichment column -> dimension.
DIMENSIONS = {"severity_level": "level", "http_status_class": "http", "http_code": "http", "log_group": "group", "geo_country": "geo", "geo_region": "geo"}


def dimension_name(col) -> Column:
    """C22. Dimension of an enrichment column."""
    x = _c(col)
    out = F.when(F.lit(False), "")
    for k, v in DIMENSIONS.items():
        out = out.when(x == k, v)
    return out.otherwise(F.replace(x, F.lit("_"), F.lit("")))


def truncate_dimension(value, name) -> Column:
    """C23. Level: 4 characters, upper case, UNCL if empty; http: 3; all others: 10."""
    v, n = _c(value), _c(name)
    return F.when(n == "level", F.upper(F.left(F.coalesce(F.nullif(v, F.lit("")), F.lit("UNCLASSIFIED")), F.lit(4)))).when(n == "http", F.left(v, F.lit(3))).otherwise(F.left(v, F.lit(10)))


#: Fields of a summary that are no dimensions.
STANDARD_FIELDS = ("type", "message_pattern", "user_service", "summaryVolume", "summaryBytes", "summaryTotals")


def dimensions(columns: list[str], skip: tuple[str, ...] = STANDARD_FIELDS) -> Column:
    """C24. Map of dimension -> value of the non-blank columns that are not standard; of two columns for one dimension the later."""
    held = {}
    for c in columns:
        if c not in skip:
            held.setdefault(DIMENSIONS.get(c, c.replace("_", "")), []).append(c)
    pairs = []
    for name, cols in held.items():
        value = F.coalesce(*[F.nullif(F.trim(F.col(c).cast("string")), F.lit("")) for c in reversed(cols)])
        pairs += [F.lit(name), F.when(value.isNotNull(), truncate_dimension(value, F.lit(name)))]
    return F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull()) if pairs else F.expr("cast(map() as map<string,string>)")


def format_bytes(col) -> Column:
    """C25. Size in GB, MB, KB (one digit, halves away from zero) or B."""
    x = _c(col).cast("long")
    digit = lambda unit: (F.floor(x / (unit / 10) + F.lit(0.5)) / 10).cast("decimal(18,1)").cast("string")
    return F.when(x >= 10**9, F.concat(digit(10**9), F.lit("GB"))).when(x >= 10**6, F.concat(digit(10**6), F.lit("MB"))).when(x >= 1000, F.concat(digit(1000), F.lit("KB"))).otherwise(F.concat(x.cast("string"), F.lit("B")))


def compression_pct(encoded, total) -> Column:
    """C26. Per cent saved, 0 without input."""
    return F.when(_c(total) > 0, (1 - _c(encoded) / _c(total)) * 100).otherwise(F.lit(0.0))


def ratio(template_length, average_encoded) -> Column:
    """C26. Template length over average encoded length, 0 where that is 0."""
    return F.when(_c(average_encoded) > 0, _c(template_length) / _c(average_encoded)).otherwise(F.lit(0.0))


def join_tokens(col, delimiter: str = ",") -> Column:
    """C27."""
    return F.array_join(_c(col), delimiter)


def split_tokens(col, delimiter: str = ",") -> Column:
    """C27. Non-empty parts; an empty string has none."""
    return F.filter(F.split(_c(col), _class(delimiter)), lambda x: x != "")


def pairs_to_map(col) -> Column:
    """C28. [k, v, k, v, ...] as a map; a last key without value is dropped, of equal keys the last one holds."""
    a = _c(col)
    n = (F.size(a) / 2).cast("int")
    keys = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: F.get(a, i * 2))
    values = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: F.get(a, i * 2 + 1))
    last = F.filter(F.transform(keys, lambda k, i: F.struct(k.alias("k"), F.get(values, i).alias("v"), i.alias("i"))), lambda s: ~F.array_contains(F.slice(keys, s["i"] + 2, F.size(keys)), s["k"]))
    return F.when(n > 0, F.map_from_entries(F.transform(last, lambda s: F.struct(s["k"], s["v"])))).otherwise(F.expr("cast(map() as map<string,string>)"))


def as_array(col, is_array: bool = False) -> Column:
    """C29. A scalar as a one-element list; a list stays."""
    return _c(col) if is_array else F.array(_c(col))


def lower_keys(json) -> Column:
    """C29. JSON text with its keys in lower case, so that a schema in lower case reads it."""
    held = F.from_json(_c(json), "map<string,string>")
    return F.to_json(F.transform_keys(held, lambda k, v: F.lower(k)))


def coerce(col, kind: str) -> Column:
    """C30. A string option as string, long, int, double, float, boolean, short or byte; null if it is none."""
    names = {"long": "bigint", "int": "int", "double": "double", "float": "float", "boolean": "boolean", "short": "smallint", "byte": "tinyint", "string": "string"}
    return F.trim(_c(col)).try_cast(names[kind])


def event_time_seconds(col) -> Column:
    """C33. Seconds of an 8-byte event time: its first four bytes, big-endian."""
    return F.conv(F.hex(F.substring(_c(col), 1, 4)), 16, 10).cast("long")


def slice_label(t0, t1) -> Column:
    """C35."""
    return F.concat_ws("_", _c(t0).cast("string"), _c(t1).cast("string"))


def sample_value(kind, value, total) -> Column:
    """C36. Value of a data point by its metric's kind; an unknown kind is an error."""
    k = _c(kind)
    return F.when(k.isin("counter", "gauge", "unknown"), _c(value)).when(k == "summary", _c(total)).when(k.isin("info", "stateset"), F.lit(1.0)).otherwise(F.raise_error(F.concat(F.lit("unsupported data point: "), F.coalesce(k, F.lit("null")))).cast("double"))


def metric_name(name, kind) -> Column:
    """C37. Counters end in _total."""
    return F.when(_c(kind) == "counter", F.concat(_c(name), F.lit("_total"))).otherwise(_c(name))


def log_json(level, message, data: dict[str, Column]) -> Column:
    """C38. Log record as JSON; numbers stay unquoted."""
    return F.to_json(F.struct(_c(level).alias("level"), _c(message).alias("message"), F.struct(*[v.alias(k) for k, v in data.items()]).alias("data")))


def time_slice(t0: int, t1: int, base: int, most: int) -> int:
    """C39. Slice length, a multiple of base, with which at most this many slices cover the range."""
    if base <= 0:
        return 0
    return base if base * most >= t1 - t0 else base * -(-(t1 - t0) // (base * most))


def normalise_option_keys(options, prefix: str) -> Column:
    """C40. Keys without the prefix and with a small first letter."""
    cut = lambda k: F.when(k.startswith(prefix), F.substring(k, len(prefix) + 1, 1 << 20)).otherwise(k)
    return F.transform_keys(_c(options), lambda k, v: F.concat(F.lower(F.left(cut(k), F.lit(1))), F.substring(cut(k), 2, 1 << 20)))


def is_well_formed_utf8(col) -> Column:
    """C41. Whether bytes are valid UTF-8."""
    return F.is_valid_utf8(_c(col))


def non_blank(col) -> Column:
    """P14."""
    return F.coalesce(F.trim(_c(col)) != "", F.lit(False))


def is_numeric(col) -> Column:
    """P15."""
    return _c(col).try_cast("double").isNotNull()


def bar(value, total, width: int) -> Column:
    """T8. Text bar of width * value / total signs; empty without a total."""
    return F.when(_c(total) > 0, F.repeat(F.lit("#"), F.expr("0") if width <= 0 else F.floor(F.lit(width) * _c(value) / _c(total)).cast("int"))).otherwise("")
