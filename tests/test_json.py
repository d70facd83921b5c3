"""Printing of attributes, bodies, ids and times on small literals."""

import json

import pytest
from pyspark.sql import functions as F

from spanloom.functions.json_text import attributes_encodable, attributes_json, body_text, events_json, links_json
from spanloom.functions.scalars import span_id_text, timestamp_text, trace_id_text, translate_path


def attrs(**values):
    pairs = ", ".join(f"named_struct('key', '{k}', 'value', CAST({v} AS VARIANT))" for k, v in values.items())
    return f"array({pairs})"


def one(spark, expr, fn):
    return spark.range(1).selectExpr(f"{expr} AS x").select(fn("x").alias("y")).first().y


@pytest.mark.parametrize(
    "value, text",
    [
        ("'<a&b>'", '"\\u003ca\\u0026b\\u003e"'),
        ("1.0D", "1"),
        ("1.5D", "1.5"),
        ("1e10D", "10000000000"),
        ("1e20D", "100000000000000000000"),
        ("0.000001D", "0.000001"),
        ("-12.25D", "-12.25"),
        ("0D", "0"),
        ("5L", "5"),
        ("true", "true"),
        ("X'00ff'", '"AP8="'),
        ("CAST(NULL AS STRING)", "null"),
        ("concat('a', decode(X'E280A8', 'UTF-8'), 'b')", '"a\\u2028b"'),
        ("concat(char(27), char(9), char(1))", '"\\u001b\\t\\u0001"'),
        # An escaped backslash followed by the letters u001B is no escape.
        (r"r'\u001B'", r'"\\u001B"'),
        (r"concat(r'\', char(27))", r'"\\\u001b"'),
        ("to_variant_object(map('b', 1, 'a', 2))", '{"a":2,"b":1}'),
        ("to_variant_object(array('<', 'x'))", '["\\u003c","x"]'),
    ],
)
def test_attribute_value(spark, value, text):
    assert one(spark, attrs(k=value), attributes_json) == '{"k":' + text + "}"


def test_attribute_objects(spark):
    assert one(spark, attrs(b="1", a="2", B="3"), attributes_json) == '{"B":3,"a":2,"b":1}'
    repeated = "concat({}, {})".format(attrs(k="'first'"), attrs(k="'last'"))
    assert one(spark, repeated, attributes_json) == '{"k":"last"}'
    empty = f"slice({attrs(k='1')}, 1, 0)"
    assert one(spark, empty, attributes_json) == "{}"
    assert one(spark, f"CASE WHEN false THEN {attrs(k='1')} END", attributes_json) == "{}"


@pytest.mark.parametrize(
    "value, ok",
    [
        ("double('NaN')", False),
        ("double('-Infinity')", False),
        ("'NaN'", True),
        ("1.5D", True),
        ("to_variant_object(array(1D, double('NaN')))", False),
        ("to_variant_object(array('NaN', 'Infinity'))", True),
        ("to_variant_object(map('a', array(map('b', double('Infinity')))))", False),
        ("to_variant_object(map('a', array(map('b', 1D))))", True),
        ("to_variant_object(array(CAST('NaN' AS VARIANT), CAST(double('NaN') AS VARIANT)))", False),
        ("CAST(NULL AS STRING)", True),
    ],
)
def test_encodable(spark, value, ok):
    assert one(spark, attrs(a="'x'", k=value), attributes_encodable) is ok


@pytest.mark.parametrize(
    "body, text",
    [
        ("CAST('as <is>' AS VARIANT)", "as <is>"),
        ("CAST(NULL AS VARIANT)", ""),
        ("parse_json('null')", ""),
        ("CAST(X'00ff' AS VARIANT)", "AP8="),
        ("CAST(2.0D AS VARIANT)", "2"),
        ("CAST(double('NaN') AS VARIANT)", "json: unsupported value: NaN"),
        ("CAST(double('Infinity') AS VARIANT)", "json: unsupported value: +Inf"),
        ("CAST(double('-Infinity') AS VARIANT)", "json: unsupported value: -Inf"),
        ("CAST(false AS VARIANT)", "false"),
        ("parse_json('{\"b\": [1, \"<\"], \"a\": null}')", '{"a":null,"b":[1,"\\u003c"]}'),
        ("to_variant_object(array(double('NaN')))", ""),
    ],
)
def test_body(spark, body, text):
    assert one(spark, body, body_text) == text


def test_events_and_links(spark):
    event = f"""named_struct('time_unix_nano', 1704067200123456789L, 'name', 'e', 'attributes', {attrs(z='1', a="'x'")},
      'dropped_attributes_count', 2L)"""
    bare = f"""named_struct('time_unix_nano', 0L, 'name', CAST(NULL AS STRING), 'attributes',
      slice({attrs(z='1', a="'x'")}, 1, 0), 'dropped_attributes_count', 0L)"""
    assert one(spark, f"array({event}, {bare})", events_json) == (
        '[{"timestamp":"2024-01-01 00:00:00.123456+00","name":"e","attributes":{"a":"x","z":1},'
        '"dropped_attributes":2},{"timestamp":"1970-01-01 00:00:00.000000+00","name":""}]'
    )
    assert one(spark, f"slice(array({event}), 1, 0)", events_json) == "[]"
    link = f"""named_struct('trace_id', unhex(repeat('0A', 16)), 'span_id', unhex(repeat('00', 8)), 'trace_state', 's=1',
      'attributes', {attrs(k='1')}, 'dropped_attributes_count', 0L, 'flags', 1L)"""
    assert one(spark, f"array({link})", links_json) == (
        '[{"trace_id":"' + "0a" * 16 + '","span_id":"","trace_state":"s=1","attributes":{"k":1},"flags":1}]'
    )
    assert json.loads(one(spark, f"array({link})", links_json))


def test_ids(spark):
    for fn, width in ((trace_id_text, 16), (span_id_text, 8)):
        assert one(spark, f"unhex(repeat('00', {width}))", fn) is None
        assert one(spark, "X''", fn) is None
        assert one(spark, "CAST(NULL AS BINARY)", fn) is None
        assert one(spark, f"unhex(concat(repeat('00', {width - 1}), 'AB'))", fn) == "00" * (width - 1) + "ab"


def test_scalars(spark):
    assert one(spark, "timestamp'2024-05-06 07:08:09.000010'", lambda c: timestamp_text(F.col(c))) == (
        "2024-05-06 07:08:09.000010+00"
    )
    move = lambda c: translate_path(F.col(c), "/in/", "/out")
    assert one(spark, "'/in/main/t/f'", move) == "/out/main/t/f"
    assert one(spark, "'/inside/f'", move) == "/inside/f"
    assert one(spark, "'/x/in/f'", move) == "/x/in/f"


def nest(depth, leaf, kind="mixed"):
    for i in range(depth):
        leaf = {"k": leaf} if kind == "map" or kind == "mixed" and i % 2 else [leaf]
    return leaf


@pytest.mark.parametrize("depth", [1, 7, 12, 40])
def test_nested_values_of_any_depth(spark, depth):
    def variant(value, leaf):
        for i in range(depth):
            value = f"to_variant_object({'map' if i % 2 else 'array'}({chr(39) + 'k' + chr(39) + ', ' if i % 2 else ''}{value}))"
        return value.replace("LEAF", leaf)

    text = json.dumps(nest(depth, "LEAF"), separators=(",", ":"))
    for leaf, printed in [("2.0D", "2"), ("1e-7D", "1e-7"), ("1.5e21D", "1.5e+21"), ("-0.0D", "-0"), ("'<'", '"\\u003c"')]:
        value = variant("CAST(LEAF AS VARIANT)", leaf)
        want = text.replace('"LEAF"', printed)
        assert one(spark, attrs(k=value), attributes_json) == '{"k":' + want + "}"
        assert one(spark, value, body_text) == want
        assert one(spark, attrs(k=value), attributes_encodable) is True
    for leaf in ("double('NaN')", "double('Infinity')"):
        value = variant("CAST(LEAF AS VARIANT)", leaf)
        assert one(spark, attrs(a="1", k=value), attributes_encodable) is False
        assert one(spark, value, body_text) == ""


@pytest.mark.parametrize(
    "value, text",
    [
        ("1e-7D", "1e-7"), ("-1.25e-10D", "-1.25e-10"), ("1e21D", "1e+21"), ("1.7976931348623157e308D", "1.7976931348623157e+308"),
        ("9.99e20D", "999000000000000000000"), ("-0.0D", "-0"), ("0.000001D", "0.000001"),
        ("to_variant_object(array(1e21D, 1.0D, 0.5D))", "[1e+21,1,0.5]"),
        ("to_variant_object(array(CAST(1 AS VARIANT), CAST('b\"<' AS VARIANT), CAST(2.5D AS VARIANT), parse_json('null'), parse_json('{}'), parse_json('[]')))",
         '[1,"b\\"\\u003c",2.5,null,{},[]]'),
        ("to_variant_object(map('é', 1D, 'z', 2D, 'A', 3D))", '{"A":3,"z":2,"é":1}'),
    ],
)
def test_double_forms(spark, value, text):
    assert one(spark, attrs(k=value), attributes_json) == '{"k":' + text + "}"
    assert one(spark, f"CAST({value} AS VARIANT)", body_text) == text
