"""Value rules: from a source column, as text or as a tagged value, to a Spark column.

All of them are built-in column expressions, so they stay inside generated code and
work alike on tables and streams. A rule gives null for text it cannot read; the jobs
that use the rules decide whether that is an error (see ``required``).
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values -------------------------------------------------------------------
#: timestamps in micros at or above this bound mean +infinity, those below the lower one -infinity
TIMESTAMP_MAX = 9223371331200000000
TIMESTAMP_MIN = -211813488000000000
#: length that marks a numeric without a declared scale
VARIABLE_SCALE_LENGTH = 131089
#: bit of the geometry type that says a reference system number follows
SRID_FLAG = 0x20000000
#: text that stands for a large value the log did not repeat
UNAVAILABLE = "__unavailable_value"
#: long type names and serial types, with the short names used everywhere else
TYPE_ALIASES = {
    "bigint": "int8",
    "bigserial": "int8",
    "bit varying": "varbit",
    "boolean": "bool",
    "character": "bpchar",
    "character varying": "varchar",
    "decimal": "numeric",
    "double precision": "float8",
    "int": "int4",
    "integer": "int4",
    "real": "float4",
    "serial": "int4",
    "serial2": "int2",
    "serial4": "int4",
    "smallint": "int2",
    "smallserial": "int2",
    "time with time zone": "timetz",
    "time without time zone": "time",
    "timestamp with time zone": "timestamptz",
    "timestamp without time zone": "timestamp",
}
# -------------------------------------------------------------------------------------

MICROS = 1_000_000
DAY_MICROS = 86_400 * MICROS
#: a twelfth of 365.25 days
MONTH_MICROS = 2_629_800 * MICROS

OFFSET = r"(?:Z|([+-])(\d{2})(?::?(\d{2})(?::?(\d{2}))?)?)"
TIME_TEXT = r"^(\d{2}):(\d{2}):(\d{2})(?:\.(\d{1,6}))?$"
TIMETZ_TEXT = r"^(\d{2}):(\d{2}):(\d{2})(?:\.(\d{1,6}))?" + OFFSET + "$"
#: as intervals are printed: years, months, days and a clock, each optional, in this order
INTERVAL_TEXT = "^(?=.)" + "".join(
    rf"(?:([-+]?\d+) {unit}s?(?: (?=.)|$))?" for unit in ("year", "mon", "day")
) + r"(?:([-+]?\d+):(\d{2}):(\d{2})(?:\.(\d+))?)?$"
DATE_TEXT = r"^(\d{4,10})-(\d{2})-(\d{2})(?: (AD|BC))?$"
TIMESTAMP_TEXT = (
    r"^(\d{4,10})-(\d{2})-(\d{2}) (\d{2}):(\d{2})(?::(\d{2})(?:\.(\d{1,9}))?)?"
    + OFFSET
    + r"?(?: (AD|BC))?$"
)
QUOTED = r'"[^"\\]*(?:\\.[^"\\]*)*"'
HSTORE_PAIR = rf"({QUOTED}|[^\s=>,\"]+)\s*=>\s*({QUOTED}|[^\s,]+)"
ARRAY_ITEM = rf"({QUOTED}|[^,{{}}]+)"


#: stands between the groups of a match; no source text holds it
SEPARATOR = "\u0001"


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` or null, with the value worked out once however often it is used."""
    return F.transform(F.array(value), lambda v: F.when(v.isNotNull(), use(v)))[0]


def _groups(text: Column, pattern: str, use: Callable[[Callable[[int], Column]], Column]) -> Column:
    """``use(g)``, where ``g(n)`` is the n-th group of the pattern; null where it does not match.

    One replacement gives all the groups, so the text is matched once.
    """
    count = re.compile(pattern).groups
    joined = F.regexp_replace(text, pattern, SEPARATOR.join(f"${i + 1}" for i in range(count)))
    parts = _once(joined, lambda j: F.when(j.contains(SEPARATOR), F.split(j, SEPARATOR)))
    return _once(parts, lambda p: use(lambda n: p[n - 1]))


def _number(digits: Column) -> Column:
    """A number, 0 where its group is absent."""
    return F.when(digits == "", F.lit(0)).otherwise(digits.cast("bigint")).cast("bigint")


def _fraction(digits: Column) -> Column:
    """Micros from the digits behind the point; digits past the sixth are cut."""
    return F.rpad(digits, 6, "0").cast("bigint")


# ---- plain scalars ------------------------------------------------------------------


def boolean(text: Column, tag: Column | None = None) -> Column:
    """``t``/``f`` in any case, else null."""
    read = F.when(F.lower(text) == "t", True).when(F.lower(text) == "f", False)
    return read if tag is None else F.coalesce(tag, read)


def number(text: Column, kind: str, tag: Column | None = None) -> Column:
    """int2, int4, int8, float4 or float8: the tagged value, else the text."""
    spark_type = {
        "int2": "smallint", "int4": "int", "int8": "bigint", "oid": "bigint",
        "float4": "float", "float8": "double",
    }[kind]
    read = text.try_cast(spark_type)
    return read if tag is None else F.coalesce(tag.cast(spark_type), read)


def bit_flag(text: Column) -> Column:
    """A one-bit string as a boolean."""
    return F.when(text.rlike("^[01]+$"), text.contains("1"))


def bit_bytes(text: Column) -> Column:
    """A bit string as little-endian bytes, no longer than its highest set bit needs."""
    bits = F.ltrim(text, F.lit("0"))
    width = (F.ceil(F.length(bits) / 8) * 8).cast("int")
    padded = F.lpad(bits, width, "0")
    octets = F.transform(
        F.sequence(F.lit(1), (width / 8).cast("int")),
        lambda i: F.lpad(F.conv(F.substring(padded, width - i * 8 + 1, F.lit(8)), 2, 16), 2, "0"),
    )
    return F.when(
        text.rlike("^[01]*$"),
        F.when(bits == "", F.unhex(F.lit(""))).otherwise(F.unhex(F.array_join(octets, ""))),
    )


def money(text: Column | None, hundredths: Column | None = None) -> Column:
    """Money text with sign, brackets or symbol, or a count of hundredths."""
    parts = []
    if hundredths is not None:
        parts.append((hundredths.cast("decimal(20,0)") * F.lit(1).cast("decimal(3,2)") / 100)
                     .cast("decimal(19,2)"))
    if text is not None:
        digits = F.regexp_replace(text, "[^0-9.]", "").try_cast("decimal(19,2)")
        negative = text.startswith("-") | text.startswith("(")
        parts.append(F.when(negative, -digits).otherwise(digits).cast("decimal(19,2)"))
    return F.coalesce(*parts)


def numeric(text: Column, precision: int = 38, scale: int = 18, mode: str = "precise") -> Column:
    """A decimal. Not-a-number and the infinities are kept.

    ``precise`` gives struct(value, special); ``double`` and ``string`` one value. A number
    is never rounded: one with more digits than the decimal holds gives null, as does
    text that is no number, so that strict decoding stops there. ``string`` holds any number.
    """
    if mode == "double":
        return text.try_cast("double")
    if mode == "string":
        return text
    special = F.when(text.isin("NaN", "Infinity", "-Infinity"), text)
    fits = rf"^[-+]?0*\d{{0,{precision - scale}}}(?:\.\d{{0,{scale}}}0*)?$"
    return F.when(
        special.isNotNull() | (text.rlike(fits) & text.rlike(r"\d")),
        F.struct(
            F.when(special.isNull(), text.try_cast(f"decimal({precision},{scale})")).alias("value"),
            special.alias("special"),
        ),
    )


def numeric_any_scale(text: Column) -> Column:
    """A numeric without declared scale: struct(scale, unscaled) without trailing zeros."""
    shape = r"^([+-]?\d+)(?:\.(\d*?)0*)?$"
    read = _groups(
        text,
        shape,
        lambda g: F.struct(
            F.length(g(2)).alias("scale"),
            F.concat(g(1), g(2)).try_cast("decimal(38,0)").alias("unscaled"),
        ),
    )
    return F.when(read["unscaled"].isNotNull(), read)  # null over 38 digits, as in ``numeric``


def bytes_text(text: Column) -> Column:
    """Bytes written as text: ``\\x`` and hex digits, else the characters themselves."""
    return F.when(
        text.rlike(r"^\\x([0-9A-Fa-f]{2})*$"), F.unhex(F.substring(text, F.lit(3), F.length(text)))
    ).otherwise(F.encode(text, "UTF-8"))


def binary(value: Column, mode: str = "bytes") -> Column:
    """Bytes as they are, or as ``base64`` or ``hex`` text."""
    return {"bytes": lambda: value, "base64": lambda: F.base64(value),
            "hex": lambda: F.lower(F.hex(value))}[mode]()


def unavailable(kind: str, placeholder: str = UNAVAILABLE) -> Column:
    """Stand-in for an unchanged large value, by Spark type; null where no stand-in exists."""
    if kind == "string":
        return F.lit(placeholder)
    if kind == "binary":
        if placeholder.startswith("hex:"):
            return F.unhex(F.lit(placeholder[4:]))
        return F.encode(F.lit(placeholder), "UTF-8")
    return F.lit(None).cast(kind)


# ---- time ---------------------------------------------------------------------------


def interval_parts(text: Column) -> Column:
    """struct(years, months, days, hours, minutes, micros); absent parts are 0."""

    def parts(g: Callable[[int], Column]) -> Column:
        sign = F.when(g(4).startswith("-"), -1).otherwise(1)
        return F.struct(
            _number(g(1)).alias("years"),
            _number(g(2)).alias("months"),
            _number(g(3)).alias("days"),
            _number(g(4)).alias("hours"),
            (sign * _number(g(5))).alias("minutes"),
            (sign * (_number(g(6)) * MICROS + _fraction(g(7)))).alias("micros"),
        )

    return _groups(text, INTERVAL_TEXT, parts)


def interval_micros(text: Column) -> Column:
    """An interval in micros, with months of average length."""

    def total(p: Column) -> Column:
        months = p["years"] * 12 + p["months"]
        minutes = p["hours"] * 60 + p["minutes"]
        return (
            months * MONTH_MICROS + p["days"] * DAY_MICROS + minutes * (60 * MICROS) + p["micros"]
        )

    return _once(interval_parts(text), total)


def _seconds_text(micros: Column) -> Column:
    size = F.abs(micros)
    fraction = F.rtrim(F.lpad((size % MICROS).cast("string"), 6, "0"), F.lit("0"))
    return F.concat(
        F.when(micros < 0, "-").otherwise(""),
        F.floor(size / MICROS).cast("string"),
        F.when(fraction == "", "").otherwise(F.concat(F.lit("."), fraction)),
    )


def interval_iso(text: Column) -> Column:
    """``P1Y2M3DT4H5M6.7S``."""
    return _once(
        interval_parts(text),
        lambda p: F.concat(
            F.lit("P"), p["years"], F.lit("Y"), p["months"], F.lit("M"), p["days"], F.lit("DT"),
            p["hours"], F.lit("H"), p["minutes"], F.lit("M"), _seconds_text(p["micros"]),
            F.lit("S"),
        ),
    )


def interval_iso_from_micros(micros: Column) -> Column:
    return F.concat(F.lit("P0Y0M0DT0H0M"), _seconds_text(micros), F.lit("S"))


def _clock_micros(g: Callable[[int], Column]) -> Column:
    seconds = (_number(g(1)) * 60 + _number(g(2))) * 60 + _number(g(3))
    return seconds * MICROS + _fraction(g(4))


def time_micros(text: Column) -> Column:
    """Time of day in micros; ``24:00:00`` is the end of the day."""
    return _groups(text, TIME_TEXT, _clock_micros)


def time_text_from_micros(micros: Column) -> Column:
    """``HH:mm:ss[.ffffff]`` with as many digits as needed."""
    fraction = F.rtrim(F.lpad((micros % MICROS).cast("string"), 6, "0"), F.lit("0"))
    seconds = F.floor(micros / MICROS)
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    return F.concat(
        two(F.floor(seconds / 3600)), F.lit(":"), two(F.floor(seconds / 60) % 60), F.lit(":"),
        two(seconds % 60), F.when(fraction == "", "").otherwise(F.concat(F.lit("."), fraction)),
    )


def timetz_utc(text: Column) -> Column:
    """Time with an offset, shifted to UTC: ``HH:mm:ss[.ffffff]Z``."""

    def shifted(g: Callable[[int], Column]) -> Column:
        size = (_number(g(6)) * 3600 + _number(g(7)) * 60 + _number(g(8))) * MICROS
        offset = F.when(g(5) == "-", -size).otherwise(size)
        return F.pmod(_clock_micros(g) - offset, F.lit(DAY_MICROS))

    local = _once(_groups(text, TIMETZ_TEXT, shifted), time_text_from_micros)
    return F.concat(local, F.lit("Z"))


def _plain_era(text: Column) -> Column:
    """The text without its era: the year before 1 AD is 0, the one before that -1."""
    year = F.regexp_extract(text, r"^(\d+)-", 1).try_cast("int") - 1
    rest = F.regexp_extract(text, r"^\d+(-.*) BC$", 1)
    return F.when(
        text.endswith(" BC"), F.concat(F.lit("-"), F.lpad(year.cast("string"), 4, "0"), rest)
    ).otherwise(F.regexp_replace(text, " AD$", ""))


def date(text: Column, epoch_day: Column | None = None) -> Column:
    """Date text with an optional era, or days since 1970."""
    read = F.when(text.rlike(DATE_TEXT), _plain_era(text).try_cast("date"))
    if epoch_day is None:
        return read
    return F.coalesce(F.date_from_unix_date(epoch_day.cast("int")), read)


def timestamp(text: Column, micros: Column | None = None) -> Column:
    """Timestamp text (era and offset optional) or micros; null for the infinities."""
    read = F.when(text.rlike(TIMESTAMP_TEXT), _plain_era(text).try_cast("timestamp"))
    if micros is None:
        return read
    inside = (micros < F.lit(TIMESTAMP_MAX)) & (micros >= F.lit(TIMESTAMP_MIN))
    return F.when(micros.isNotNull(), F.timestamp_micros(F.when(inside, micros))).otherwise(read)


def timestamptz_iso(text: Column, micros: Column | None = None) -> Column:
    """The same as ISO text in UTC, with ``infinity`` and ``-infinity`` kept."""
    out = F.when(text.isin("infinity", "-infinity"), text)
    if micros is not None:
        out = (
            F.when(micros >= F.lit(TIMESTAMP_MAX), F.lit("infinity"))
            .when(micros < F.lit(TIMESTAMP_MIN), F.lit("-infinity"))
            .when(text.isin("infinity", "-infinity"), text)
        )
    return out.otherwise(iso_offset(timestamp(text, micros)))


def iso_offset(ts: Column) -> Column:
    """ISO text in UTC with as many fraction digits as needed."""
    text = ts.cast("timestamp").cast("string")
    return F.concat(F.replace(text, F.lit(" "), F.lit("T")), F.lit("Z"))


def iso_instant(ts: Column) -> Column:
    """ISO text in UTC with a fraction of 0, 3 or 6 digits."""
    text = F.replace(ts.cast("timestamp").cast("string"), F.lit(" "), F.lit("T"))
    point = F.instr(text, ".")
    digits = F.when(F.length(text) - point <= 3, 3).otherwise(6)
    padded = F.when(point == 0, text).otherwise(F.rpad(text, point + digits, F.lit("0")))
    return F.concat(padded, F.lit("Z"))


# ---- composed values ----------------------------------------------------------------


def _unquote(item: Column) -> Column:
    inner = F.substring(item, F.lit(2), F.length(item) - 2)
    return F.when(
        item.startswith('"'), F.regexp_replace(inner, r"\\(.)", "$1")
    ).otherwise(F.when(F.upper(item) != "NULL", item))


def hstore_map(text: Column) -> Column:
    """``"k"=>"v", "n"=>NULL`` as a map; values may be null."""
    keys = F.regexp_extract_all(text, F.lit(HSTORE_PAIR), F.lit(1))
    values = F.regexp_extract_all(text, F.lit(HSTORE_PAIR), F.lit(2))
    plain_key = lambda k: F.when(k.startswith('"'), _unquote(k)).otherwise(k)
    return F.map_from_arrays(F.transform(keys, plain_key), F.transform(values, _unquote))


def hstore_json(text: Column) -> Column:
    return F.to_json(hstore_map(text), {"ignoreNullFields": "false"})


def array(text: Column, element: Callable[[Column], Column] = lambda c: c) -> Column:
    """``{a,NULL,"b,c"}`` as an array, with ``element`` applied to each item; null if nested."""
    nested = F.regexp_replace(text, QUOTED, "").rlike(r"\{.*\{")
    return _items(F.when(~nested, text), element)


def _items(text: Column, element: Callable[[Column], Column]) -> Column:
    items = F.filter(F.regexp_extract_all(text, F.lit(ARRAY_ITEM), F.lit(1)), lambda i: F.trim(i) != "")
    return F.transform(F.transform(items, lambda i: _unquote(F.trim(i))), element)


def nested_array(text: Column, depth: int, element: Callable[[Column], Column] = lambda c: c) -> Column:
    """``{{a,b},{c,NULL}}`` as arrays in arrays, ``depth`` of them.

    Such arrays are boxes: all parts of a level have one size. The items before the first run
    of j closing braces fill a part j levels high, so items are cut into parts of that size, level by
    level. Null for text of another depth or with parts of unlike size; ``{}`` is empty.
    """
    items = _items(text, element)
    marked = F.regexp_replace(F.regexp_replace(text, QUOTED, "v"), r"[^{},]*[^{},\s][^{},]*", "v")
    shape = F.regexp_replace(marked, r"[,\s]+", "")
    first = [F.substring(shape, F.lit(1), F.instr(shape, "}" * j) - 1) for j in range(1, depth + 1)]
    sizes = [F.length(F.regexp_replace(f, "[^v]", "")) for f in first]

    def parts(items: Column, level: int) -> Column:
        if level == 1:
            return items
        size = sizes[level - 2]
        starts = F.sequence(F.lit(1), F.size(items), size)
        return F.transform(starts, lambda at: parts(F.slice(items, at, size), level - 1))

    # the shape that a box of these sizes has
    box = F.lit("v")
    for j, size in enumerate(sizes):
        inside = F.lit(1) if j == 0 else F.greatest(sizes[j - 1], F.lit(1))
        box = F.concat(F.lit("{"), F.repeat(box, (size / inside).cast("int")), F.lit("}"))
    none = F.array().cast("array<int>")
    empty = parts(items, 1) if depth == 1 else F.transform(none, lambda _: parts(items, depth - 1))
    return F.when(shape == "{}", empty).when((sizes[0] > 0) & (shape == box), parts(items, depth))


def ltree_array(text: Column) -> Column:
    """``{a.b,c}`` as a list of paths."""
    return F.split(F.substring(text, F.lit(2), F.length(text) - 2), ",")


def point(text: Column, x: Column | None = None, y: Column | None = None) -> Column:
    """``(x,y)`` as struct(x, y)."""
    shape = r"^\s*\(?\s*([^,()\s]+)\s*,\s*([^,()\s]+)\s*\)?\s*$"
    read = _groups(
        text,
        shape,
        lambda g: F.struct(g(1).try_cast("double").alias("x"), g(2).try_cast("double").alias("y")),
    )
    px, py = read["x"], read["y"]
    if x is not None and y is not None:
        px, py = F.coalesce(x, px), F.coalesce(y, py)
    return F.when(px.isNotNull() & py.isNotNull(), F.struct(px.alias("x"), py.alias("y")))


def geometry(hex_text: Column) -> Column:
    """Hex geometry as struct(wkb, srid); fewer than nine bytes is no geometry."""
    little = F.substring(hex_text, 1, 2) != "00"

    def word(start: int) -> Column:
        octet = lambda i: F.substring(hex_text, start + 2 * i, 2)
        turned = F.concat(octet(3), octet(2), octet(1), octet(0))
        text = F.when(little, turned).otherwise(F.substring(hex_text, start, 8))
        return F.conv(text, 16, 10).cast("long")

    srid = word(11)
    signed = F.when(srid > 2147483647, srid - F.lit(1 << 32)).otherwise(srid).cast("int")
    has_srid = word(3).bitwiseAND(F.lit(SRID_FLAG)) != 0
    return F.when(
        hex_text.rlike("^(?:[0-9A-Fa-f]{2}){9,}$"),
        F.struct(F.unhex(hex_text).alias("wkb"), F.when(has_srid, signed).alias("srid")),
    )


# ---- names and keys -----------------------------------------------------------------


def type_name(name: Column) -> Column:
    """Short type name: schema and quotes off, aliases applied."""
    plain = F.regexp_replace(F.regexp_replace(name, r'^[^".]+\.', ""), r'^"(.*)"$', "$1")
    pairs = [F.lit(part) for pair in TYPE_ALIASES.items() for part in pair]
    return F.coalesce(F.create_map(*pairs)[plain], plain)


def transaction_id(value: Column) -> Column:
    """Unsigned 32-bit number as a long."""
    return value.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))


def identifier(name: Column) -> Column:
    """An identifier part without its quotes."""
    return F.regexp_replace(name, r'^"(.*)"$', "$1")


def table_id(name: Column, default_schema: str = "public") -> Column:
    """struct(schema, table) of ``schema.table``, ``"schema"."table"`` or ``table``."""
    shape = r'^(?:(?:.*\.)?("[^"]*"|[^".]*)\.)?("[^"]*"|[^".]*)$'
    schema = identifier(F.regexp_extract(name, shape, 1))
    return F.struct(
        F.when(schema == "", F.lit(default_schema)).otherwise(schema).alias("schema"),
        identifier(F.regexp_extract(name, shape, 2)).alias("table"),
    )


def enum(text: Column, allowed: list[str]) -> Column:
    """The label if it is one of the type's labels."""
    return F.when(text.isin(allowed), text)


# ---- by type name -------------------------------------------------------------------


def from_text(kind: str, text: Column, options: dict | None = None) -> Column:
    """The rule for a column read as text, by its short type name (``[]`` for arrays, once per level)."""
    o = options or {}
    kind = TYPE_ALIASES.get(kind, kind)
    if kind.endswith("[]"):
        if kind == "ltree[]":
            return ltree_array(text)
        depth = (len(kind) - len(kind.rstrip("[]"))) // 2
        element = lambda item: from_text(kind[: -2 * depth], item, o)
        return array(text, element) if depth == 1 else nested_array(text, depth, element)
    rules: dict[str, Callable[[], Column]] = {
        "bool": lambda: boolean(text),
        "bit": lambda: bit_flag(text),
        "varbit": lambda: bit_bytes(text),
        "money": lambda: money(text),
        "numeric": lambda: numeric(
            text, o.get("precision", 38), o.get("scale", 18), o.get("decimal_mode", "precise")
        ),
        "numeric_any": lambda: numeric_any_scale(text),
        "interval": lambda: interval_iso(text)
        if o.get("interval_mode") == "string"
        else interval_micros(text),
        "date": lambda: date(text),
        "time": lambda: time_micros(text),
        "timetz": lambda: timetz_utc(text),
        "timestamp": lambda: timestamp(text),
        "timestamptz": lambda: timestamptz_iso(text),
        "hstore": lambda: hstore_map(text)
        if o.get("hstore_mode") == "map"
        else hstore_json(text),
        "point": lambda: point(text),
        "geometry": lambda: geometry(text),
        "geography": lambda: geometry(text),
        "bytea": lambda: binary(bytes_text(text), o.get("binary_mode", "bytes")),
    }
    if kind in ("int2", "int4", "int8", "oid", "float4", "float8"):
        return number(text, kind)
    return rules.get(kind, lambda: text)()


def datum_text(d: Column) -> Column:
    return F.coalesce(d["datum_string"], F.decode(d["datum_bytes"], "UTF-8"))


def from_datum(kind: str, d: Column, options: dict | None = None) -> Column:
    """The rule for a tagged value of the log: its tag first, else its text."""
    o = options or {}
    kind = TYPE_ALIASES.get(kind, kind)
    text = datum_text(d)
    tagged: dict[str, Callable[[], Column]] = {
        "bool": lambda: boolean(text, d["datum_bool"]),
        "int2": lambda: number(text, "int2", d["datum_int32"]),
        "int4": lambda: number(text, "int4", d["datum_int32"]),
        "int8": lambda: number(text, "int8", d["datum_int64"]),
        "oid": lambda: number(text, "oid", d["datum_int64"]),
        "float4": lambda: number(text, "float4", d["datum_float"]),
        "float8": lambda: number(text, "float8", d["datum_double"]),
        "numeric": lambda: from_text(
            kind, F.coalesce(d["datum_double"].cast("string"), text), o
        ),
        "money": lambda: money(text, d["datum_int64"]),
        "interval": lambda: F.when(
            d["datum_double"].isNotNull(), interval_iso_from_micros(d["datum_double"].cast("long"))
        ).otherwise(interval_iso(text))
        if o.get("interval_mode") == "string"
        else F.coalesce(d["datum_double"].cast("long"), interval_micros(text)),
        "date": lambda: date(text, d["datum_int32"]),
        "time": lambda: F.coalesce(d["datum_int64"], time_micros(text)),
        "timetz": lambda: F.when(
            d["datum_double"].isNotNull(),
            F.concat(
                time_text_from_micros(
                    F.pmod(d["datum_double"].cast("long"), F.lit(DAY_MICROS))
                ),
                F.lit("Z"),
            ),
        ).otherwise(timetz_utc(text)),
        "timestamp": lambda: timestamp(text, d["datum_int64"]),
        "timestamptz": lambda: timestamptz_iso(text, d["datum_int64"]),
        "bytea": lambda: binary(d["datum_bytes"], o.get("binary_mode", "bytes")),
        "point": lambda: point(text, d["datum_point"]["x"], d["datum_point"]["y"]),
        # a type without a rule stays bytes, and only if asked for
        "unknown": lambda: d["datum_bytes"]
        if o.get("include_unknown")
        else F.lit(None).cast("binary"),
    }
    return tagged.get(kind, lambda: from_text(kind, text, o))()


def required(raw: Column, value: Column, what: str) -> Column:
    """``value``, or an error where the source had something the rule could not read."""
    return F.when(raw.isNull() | value.isNotNull(), value).otherwise(
        F.raise_error(F.concat(F.lit(f"cannot read {what}: "), raw.cast("string")))
    )
