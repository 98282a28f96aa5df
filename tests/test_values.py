"""Value rules on literal rows: normal, null, empty, malformed and extreme input."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import lsn
from tidemark.functions import values as V


def apply(spark, rule, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r["o"] for r in df.select("i", rule(F.col("v")).alias("o")).orderBy("i").collect()]


CASES = [
    (V.boolean, {"t": True, "T": True, "f": False, "yes": None, "": None, None: None}),
    (lambda c: V.number(c, "int4"), {"12": 12, "-2147483648": -(2**31), "x": None, None: None}),
    (lambda c: V.number(c, "int8"), {"9223372036854775807": 2**63 - 1, "": None}),
    (lambda c: V.number(c, "float8"), {"1.5": 1.5, "-Infinity": float("-inf"), "q": None}),
    (V.bit_flag, {"1": True, "0": False, "2": None, None: None}),
    (V.bit_bytes, {"101": b"\x05", "100000001": b"\x01\x01", "0000": b"", "": b"",
                   "1" + "0" * 15: b"\x00\x80", "12": None, None: None}),
    (V.money, {"$1,234.56": Decimal("1234.56"), "-$0.05": Decimal("-0.05"),
               "($7.00)": Decimal("-7.00"), "": None, None: None}),
    (lambda c: V.numeric(c, 10, 2), {"1.50": (Decimal("1.50"), None), "NaN": (None, "NaN"),
                                     "-Infinity": (None, "-Infinity"), None: None, "1.239": None,
                                     "123456789.1": None, "0012345678.9900": (Decimal("12345678.99"), None),
                                     "junk": None, "": None, ".5": (Decimal("0.50"), None)}),
    (V.bytes_text, {"\\xDEAD": b"\xde\xad", "\\x": b"", "abc": b"abc", "\\xZZ": b"\\xZZ", None: None}),
    (V.numeric_any_scale, {"123.4500": (2, Decimal(12345)), "100": (0, Decimal(100)),
                           "-0.10": (1, Decimal(-1)), "9" * 39: None, "x": None, None: None}),
    (V.interval_micros, {
        "1 year 2 mons 3 days 04:05:06.7":
            14 * 2629800000000 + 3 * 86400000000 + (4 * 3600 + 5 * 60 + 6) * 1000000 + 700000,
        "-00:00:01.5": -1500000, "-1 days": -86400000000, "100:00:00": 360000000000,
        "": None, "garbage": None, "3 days junk": None, None: None}),
    (V.interval_iso, {"1 year 2 mons 3 days 04:05:06.78": "P1Y2M3DT4H5M6.78S",
                      "-01:02:03": "P0Y0M0DT-1H-2M-3S", "3 days": "P0Y0M3DT0H0M0S", "": None}),
    (V.time_micros, {"00:00:00": 0, "24:00:00": 86400000000, "23:59:59.000001": 86399000001,
                     "7:00": None, None: None}),
    (V.timetz_utc, {"10:00:00+02": "08:00:00Z", "23:30:00.5-01:00": "00:30:00.5Z",
                    "00:15:00+00:30": "23:45:00Z", "01:02:03Z": "01:02:03Z", "bad": None}),
    (V.date, {"2020-02-29": dt.date(2020, 2, 29), "2020-01-01 AD": dt.date(2020, 1, 1),
              "bad": None, None: None}),
    (lambda c: V.date(c).cast("string"), {"0001-03-01 BC": "0000-03-01", "0044-03-15 BC": "-0043-03-15"}),
    (lambda c: V.iso_instant(V.timestamp(c)), {
        "2020-01-01 00:00:00": "2020-01-01T00:00:00Z",
        "2020-01-01 00:00:00.5": "2020-01-01T00:00:00.500Z",
        "2020-01-01 00:00:00.000001": "2020-01-01T00:00:00.000001Z",
        "1969-12-31 23:59:59.999": "1969-12-31T23:59:59.999Z", "nope": None, None: None}),
    (V.timestamptz_iso, {
        "2020-06-01 12:00:00+02": "2020-06-01T10:00:00Z",
        "2020-06-01 12:00:00.25-03:30": "2020-06-01T15:30:00.25Z",
        "1880-01-01 00:00:00+00:17:30": "1879-12-31T23:42:30Z",
        "infinity": "infinity", "-infinity": "-infinity", None: None}),
    (V.hstore_map, {'"a"=>"1", "b"=>NULL': {"a": "1", "b": None}, "": {},
                    'k=>v,"x y"=>"say \\"hi\\", ok"': {"k": "v", "x y": 'say "hi", ok'}, None: None}),
    (V.hstore_json, {'"a"=>"1", "b"=>NULL': '{"a":"1","b":null}', "": "{}"}),
    (V.ltree_array, {"{a.b,c}": ["a.b", "c"], None: None}),
    (V.array, {'{1,NULL,"a,b","NULL"}': ["1", None, "a,b", "NULL"], "{}": [], "{{1,2},{3,4}}": None, '{"{",b}': ["{", "b"], None: None}),
    (lambda c: V.from_text("int4[]", c), {"{1,-2,NULL}": [1, -2, None]}),
    (lambda c: V.from_text("timestamptz[]", c),
     {'{"2020-06-01 12:00:00+02"}': ["2020-06-01T10:00:00Z"]}),
    (V.point, {"(1,2.5)": (1.0, 2.5), "( -3 , 4e2 )": (-3.0, 400.0), "(1)": None, None: None}),
    (V.geometry, {
        "0101000020E6100000000000000000F03F0000000000000040":
            (bytes.fromhex("0101000020E6100000000000000000F03F0000000000000040"), 4326),
        "00000000013FF00000000000004000000000000000":
            (bytes.fromhex("00000000013FF00000000000004000000000000000"), None),
        "0020000001000010E63FF00000000000004000000000000000":
            (bytes.fromhex("0020000001000010E63FF00000000000004000000000000000"), 4326),
        "0101": None, "zz": None, None: None}),
    (V.type_name, {"serial": "int4", "pg_catalog.bigint": "int8", '"Mood"': "Mood",
                   "character varying": "varchar", "uuid": "uuid", 'app."Mood"': "Mood"}),
    (lambda c: F.struct(V.table_id(c)["schema"], V.table_id(c)["table"]),
     {"orders": ("public", "orders"), "a.b": ("a", "b"), '"A"."b c"': ("A", "b c"),
      "db.a.b": ("a", "b")}),
    (lambda c: V.enum(c, ["sad", "ok"]), {"ok": "ok", "no": None, None: None}),
    (lambda c: V.binary(F.encode(c, "UTF-8"), "base64"), {"ab": "YWI=", None: None}),
    (lambda c: V.binary(F.encode(c, "UTF-8"), "hex"), {"az": "617a"}),
    (lambda c: V.required(c, V.number(c, "int4"), "n"), {"7": 7, None: None}),
    (lsn.parse, {"16/3002D50": 0x1603002D50, "0/0": 0, "FFFFFFFF/FFFFFFFF": -1, "abc": 0,
                 "/12": 0, "G/1": None, None: None}),
]


@pytest.mark.parametrize("rule,cases", CASES, ids=[str(i) for i in range(len(CASES))])
def test_rule(spark, rule, cases):
    got = apply(spark, rule, list(cases))
    plain = [bytes(g) if isinstance(g, bytearray) else g for g in got]
    plain = [
        tuple(bytes(x) if isinstance(x, bytearray) else x for x in g) if isinstance(g, tuple) else g
        for g in plain
    ]
    assert plain == list(cases.values())


def test_micros_with_infinity(spark):
    inputs = [0, 1577836800000001, V.TIMESTAMP_MAX, V.TIMESTAMP_MAX - 1, V.TIMESTAMP_MIN - 1, None]
    got = apply(spark, lambda c: V.timestamptz_iso(F.lit(None).cast("string"), c), inputs, "long")
    assert got[0] == "1970-01-01T00:00:00Z"
    assert got[1] == "2020-01-01T00:00:00.000001Z"
    assert got[2] == "infinity" and got[4] == "-infinity" and got[5] is None
    assert got[3] not in ("infinity", None)


def test_tags_come_first(spark):
    got = apply(spark, lambda c: V.money(None, c), [12345, -5, 2**63 - 1], "long")
    assert got == [Decimal("123.45"), Decimal("-0.05"), Decimal("92233720368547758.07")]
    assert apply(spark, V.interval_iso_from_micros, [1500000, -250], "long") == [
        "P0Y0M0DT0H0M1.5S", "P0Y0M0DT0H0M-0.00025S"]
    assert apply(spark, lambda c: V.date(F.lit(None).cast("string"), c), [0, 18321], "int") == [
        dt.date(1970, 1, 1), dt.date(2020, 2, 29)]
    assert apply(spark, V.transaction_id, [-1, 7], "int") == [4294967295, 7]


def test_unavailable(spark):
    df = spark.range(1).select(
        V.unavailable("string").alias("s"),
        V.unavailable("binary", "hex:00ff").alias("b"),
        V.unavailable("int").alias("i"),
    )
    r = df.first()
    assert (r.s, bytes(r.b), r.i) == ("__unavailable_value", b"\x00\xff", None)


def test_required_fails_on_unreadable_text(spark):
    with pytest.raises(Exception, match="cannot read n"):
        apply(spark, lambda c: V.required(c, V.number(c, "int4"), "n"), ["7", "x"])


def test_lsn_round_trip_and_order(spark):
    numbers = [0, 1, 2**32 - 1, 2**32, 2**63 - 1, -(2**63), -1]
    assert apply(spark, lambda c: lsn.parse(lsn.text(c)), numbers, "long") == numbers
    assert apply(spark, lsn.text, [0x1603002D50, 0, -1], "long") == [
        "16/3002D50", "0/0", "FFFFFFFF/FFFFFFFF"]
    ranks = apply(spark, lsn.rank, numbers, "long")
    assert ranks == sorted(ranks)
    assert apply(spark, lambda c: lsn.unrank(lsn.rank(c)), numbers, "long") == numbers


def test_nested_arrays(spark):
    cases = {
        "{{a,b},{c,NULL}}": [["a", "b"], ["c", None]],
        '{{"x,{y}","q\\"r"},{ "" , NULL }}': [["x,{y}", 'q"r'], ["", None]],
        "{{1},{2},{3}}": [["1"], ["2"], ["3"]],
        "{}": [],
        "{{a,b},{c}}": None,  # no box
        "{a,b}": None, "{{{a}}}": None, "{{a},{b}": None, "{{a},{b}}}": None, "": None, "{{},{}}": None, None: None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r.t: r.a for r in df.select("t", V.from_text("text[][]", F.col("t")).alias("a")).collect()}
    assert got == cases
    cube = [[[str(100 * i + 10 * j + k) for k in range(4)] for j in range(3)] for i in range(2)]
    text = str(cube).replace("[", "{").replace("]", "}").replace("'", "")
    got = spark.createDataFrame([(text,)], "t string").select(V.from_text("int8[][][]", F.col("t"))).first()[0]
    assert got == [[[int(x) for x in c] for c in b] for b in cube]
