"""Attribute lists, span events, span links and bodies as JSON text.

VARIANT does the heavy lifting: an object built with to_variant_object() prints with byte-sorted keys at every
level and binary values as base64, which is the stored form.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spanloom.functions.scalars import TIMESTAMP_TEXT, hex_or_null_text

# Characters that are written as escapes although JSON does not require it.
ESCAPED = {"<": r"\u003c", ">": r"\u003e", "&": r"\u0026", "\u2028": r"\u2028", "\u2029": r"\u2029"}


def with_escapes_text(json: str) -> str:
    """SQL text: JSON with HTML characters and line separators escaped and control characters in lower-case hex.

    `json` is expensive, so it is named once with transform(array(x), j -> ...) instead of being repeated.
    """
    lowered = "j"
    for digit in "ABCDEF":
        # Only a real escape counts, so the backslash in front of "u" must not itself be escaped.
        pattern = rf"(?<!\\)((?:\\\\)*\\u00[01]){digit}"
        lowered = f"regexp_replace({lowered}, r'{pattern}', '$1{digit.lower()}')"
    text = rf"CASE WHEN contains(j, r'\u00') THEN {lowered} ELSE j END"
    for char, escape in ESCAPED.items():
        text = f"replace({text}, '{char}', r'{escape}')"
    # Most texts hold none of these, which is found out in one pass.
    some = rf"j RLIKE r'[{''.join(ESCAPED)}]|\\u00'"
    return f"element_at(transform(array({json}), j -> CASE WHEN {some} THEN {text} ELSE j END), 1)"


def double_text(value: str) -> str:
    """SQL text of a finite DOUBLE as it stands in JSON: plain digits for zero and magnitudes in [1e-6, 1e21), with a sign
    for a negative zero; else the shortest digits with an exponent that has a sign and no leading zero."""
    exponent = f"replace(replace(replace(CAST({value} AS STRING), '.0E', 'E'), 'E-', 'e-'), 'E', 'e+')"
    return f"""CASE WHEN {value} = 0D THEN CASE WHEN CAST({value} AS STRING) = '-0.0' THEN '-0' ELSE '0' END
      WHEN abs({value}) >= 1e21D OR abs({value}) < 1e-6D THEN {exponent}
      WHEN abs({value}) >= 1e15D THEN CAST(CAST({value} AS DECIMAL(38, 0)) AS STRING)
      ELSE regexp_replace(regexp_replace(CAST(CAST({value} AS DECIMAL(38, 22)) AS STRING), '0+$', ''), '[.]$', '') END"""


# --- values of any depth ---------------------------------------------------------------------------------------------
#
# A nested value is laid out as a list of nodes, level by level: aggregate() appends the children of the newest level
# until a level adds none. What is asked of the value is then answered from the last node to the first, so that a node's
# children are always answered before it. No nesting is written into the expression, so none is too deep.

_NODE = "named_struct('parent', {parent}, 'key', {key}, 'v', {value})"


def nodes_text(value: str, children: str, most_levels: str) -> str:
    """SQL text: a nested value and all that is below it as an array of (parent, key, v); the value itself comes first and
    has the parent -1. `children` is SQL text over `nd.v` for an array of (key, v), empty or NULL for a leaf, `most_levels`
    for a number that is no less than the value's depth."""
    top = _NODE.format(parent="-1", key="CAST(NULL AS STRING)", value=value)
    grown = f"""flatten(transform(slice(t.nodes, t.first + 1, size(t.nodes) - t.first), (nd, ni) ->
      transform(coalesce({children}, array()), ch -> {_NODE.format(parent='t.first + ni', key='ch.key', value='ch.v')})))"""
    step = f"named_struct('nodes', concat(t.nodes, {grown}), 'first', size(t.nodes))"
    return f"""aggregate(sequence(1, {most_levels}), named_struct('nodes', array({top}), 'first', 0),
      (t, lv) -> CASE WHEN t.first = size(t.nodes) THEN t ELSE {step} END, t -> t.nodes)"""


def folded_text(nodes: str, answer: str, kind: str) -> str:
    """SQL text: the answer for the first of `nodes`, of the SQL type `kind`. `answer` is SQL text over the node `nd` and
    `below`, the answers of its children in order as an array of (key, r)."""
    none = f"filter(array(named_struct('parent', 0, 'key', '', 'r', CAST(NULL AS {kind}))), x -> false)"
    below = "transform(reverse(filter(t, x -> x.parent = i)), x -> named_struct('key', x.key, 'r', x.r))"
    named = f"element_at(transform(array({below}), below -> {answer}), 1)"
    one = f"element_at(transform(array(ns[i]), nd -> named_struct('parent', nd.parent, 'key', nd.key, 'r', {named})), 1)"
    return f"""element_at(transform(array({nodes}), ns -> aggregate(sequence(size(ns) - 1, 0), {none},
      (t, i) -> concat(filter(t, x -> x.parent <> i), array({one})), t -> t[0].r)), 1)"""


_PLAIN_CHILDREN = """CASE WHEN schema_of_variant(nd.v) LIKE 'ARRAY<%'
    THEN transform(try_variant_get(nd.v, '$', 'array<variant>'), c -> named_struct('key', CAST(NULL AS STRING), 'v', c))
  WHEN schema_of_variant(nd.v) LIKE 'OBJECT<%'
    THEN transform(map_entries(try_variant_get(nd.v, '$', 'map<string,variant>')), c -> named_struct('key', c.key, 'v', c.value)) END"""


def _plain_nodes(value: str) -> str:
    """Brackets and braces of the printed value are no fewer than its levels."""
    levels = f"2 + length(regexp_replace(to_json({value}), r'[^\\[{{]', ''))"
    return nodes_text(value, _PLAIN_CHILDREN, levels)


def plain_double_text(value: str) -> str:
    """SQL text of a DOUBLE as a VARIANT that prints as JSON wants it: a decimal, without exponent or a bare '.0'. What
    no decimal can print (negative zero, magnitudes that need an exponent, NaN) stays a double."""
    return f"""CASE WHEN {_needs_own_text(value)} THEN CAST({value} AS VARIANT)
      WHEN abs({value}) >= 1e15D THEN CAST(CAST({value} AS DECIMAL(38, 0)) AS VARIANT)
      ELSE CAST(CAST({value} AS DECIMAL(38, 22)) AS VARIANT) END"""


def _needs_own_text(number: str) -> str:
    return f"({number} <> 0D AND NOT (abs({number}) >= 1e-6D AND abs({number}) < 1e21D) OR CAST({number} AS STRING) = '-0.0')"


def _number(value: str) -> str:
    return f"try_variant_get({value}, '$', 'double')"


def _is_double(value: str, kind: str | None = None) -> str:
    return f"{kind or f'schema_of_variant({value})'} IN ('DOUBLE', 'FLOAT')"


def _may_hold_doubles(value: str, kind: str | None = None) -> str:
    """Lists and maps whose schema text shows doubles or mixed items, which may be doubles."""
    return f"{kind or f'schema_of_variant({value})'} RLIKE '^(ARRAY|OBJECT)<.*(DOUBLE|FLOAT|VARIANT)'"


def _scalar_json(value: str) -> str:
    return f"""CASE WHEN {value} IS NULL OR schema_of_variant({value}) = 'VOID' THEN 'null'
      WHEN {_is_double(value)} THEN {double_text(_number(value))} ELSE to_json({value}) END"""


def value_json(value: str) -> str:
    """SQL text: a VARIANT as JSON text; missing becomes null. What holds no doubles prints as it is; the rest is taken
    apart, at every level, since a double of a VARIANT prints in another form."""
    answer = f"""CASE WHEN schema_of_variant(nd.v) LIKE 'ARRAY<%' THEN concat('[', array_join(transform(below, c -> c.r), ','), ']')
      WHEN schema_of_variant(nd.v) LIKE 'OBJECT<%'
        THEN concat('{{', array_join(transform(below, c -> concat(to_json(CAST(c.key AS VARIANT)), ':', c.r)), ','), '}}')
      ELSE {_scalar_json('nd.v')} END"""
    nested = folded_text(_plain_nodes(value), answer, "STRING")
    return f"CASE WHEN {_may_hold_doubles(value)} THEN {nested} ELSE {_scalar_json(value)} END"


def with_kinds(attributes: str) -> str:
    """SQL text: attribute pairs with the `kind` of each value, its schema as text, which is asked for several times."""
    return f"transform({attributes}, a -> named_struct('key', a.key, 'value', a.value, 'kind', schema_of_variant(a.value)))"


def object_text(attributes: str) -> str:
    """SQL text: attribute pairs with kinds as a JSON object with byte-sorted keys. The last of several equal keys wins."""

    def whole(value: str) -> str:
        pairs = f"transform({attributes}, a -> named_struct('key', a.key, 'value', coalesce({value}, parse_json('null'))))"
        return f"to_variant_object(map_from_entries({pairs}))"

    # Doubles at the top become decimals and print as they should; only others call for the walk.
    double = _is_double("a.value", "a.kind")
    plain = f"CASE WHEN {double} THEN {plain_double_text(_number('a.value'))} ELSE a.value END"
    walk = f"{_may_hold_doubles('a.value', 'a.kind')} OR {double} AND {_needs_own_text(_number('a.value'))}"
    walked = f"element_at(transform(array({whole('a.value')}), o -> {value_json('o')}), 1)"
    return f"CASE WHEN exists({attributes}, a -> coalesce({walk}, false)) THEN {walked} ELSE to_json({whole(plain)}) END"


def _object(attributes: str) -> str:
    """The same of pairs without kinds."""
    return f"element_at(transform(array({with_kinds(attributes)}), ps -> {object_text('ps')}), 1)"


def attributes_json(attributes: str, printed: str | None = None) -> Column:
    """A column of attribute pairs as a JSON object. `printed` is SQL text for the object if it is at hand."""
    json = with_escapes_text(printed or _object(attributes))
    return F.expr(f"CASE WHEN size({attributes}) > 0 THEN {json} ELSE '{{}}' END")


def _array_json(items: str, *fields: str) -> Column:
    """A JSON array of objects; a field that is NULL is left out. Fields are SQL text over the item `i` and its position `n`."""
    item = f"concat('{{', concat_ws(',', {', '.join(fields)}), '}}')"
    json = with_escapes_text(f"concat('[', array_join(transform({items}, (i, n) -> {item}), ','), ']')")
    return F.expr(f"CASE WHEN size({items}) > 0 THEN {json} ELSE '[]' END")


def _text_field(name: str, text: str) -> str:
    return f"""concat('"{name}":', to_json(CAST({text} AS VARIANT)))"""


def _count_field(name: str, count: str) -> str:
    return f"""concat('"{name}":', CAST(nullif({count}, 0L) AS STRING))"""


def _attributes_field(printed: str | None) -> str:
    printed = printed or f"CASE WHEN size(i.attributes) > 0 THEN {_object('i.attributes')} END"
    return f"""concat('"attributes":', {printed})"""


def events_json(events: str, printed: str | None = None) -> Column:
    """A column of span events as a JSON array. `printed` is SQL text for the attributes of the event number `n` as an
    object, NULL if it has none, if they are at hand."""
    return _array_json(
        events,
        _text_field("timestamp", f"date_format(timestamp_micros(coalesce(i.time_unix_nano, 0L) div 1000L), '{TIMESTAMP_TEXT}')"),
        _text_field("name", "coalesce(i.name, '')"),
        _attributes_field(printed),
        _count_field("dropped_attributes", "i.dropped_attributes_count"),
    )


def links_json(links: str, printed: str | None = None) -> Column:
    """A column of span links as a JSON array, `printed` as with events."""
    return _array_json(
        links,
        _text_field("trace_id", f"coalesce({hex_or_null_text('i.trace_id', 16)}, '')"),
        _text_field("span_id", f"coalesce({hex_or_null_text('i.span_id', 8)}, '')"),
        _text_field("trace_state", "nullif(i.trace_state, '')"),
        _attributes_field(printed),
        _count_field("dropped_attributes", "i.dropped_attributes_count"),
        _count_field("flags", "i.flags"),
    )


def _not_finite(value: str, kind: str | None = None) -> str:
    """SQL text: whether a NaN or an infinity is in a value, at any level."""

    def bad(v: str, kind: str | None = None) -> str:
        return f"coalesce({_is_double(v, kind)} AND (isnan({_number(v)}) OR abs({_number(v)}) = double('Infinity')), false)"

    return f"""CASE WHEN {_may_hold_doubles(value, kind)} THEN exists({_plain_nodes(value)}, n -> {bad('n.v')})
      ELSE {bad(value, kind)} END"""


def encodable_text(attributes: str) -> str:
    """SQL text: false if some attribute of pairs with kinds cannot be written as JSON."""
    return f"NOT coalesce(exists({attributes}, a -> {_not_finite('a.value', 'a.kind')}), false)"


def attributes_encodable(attributes: str) -> Column:
    """False if some attribute of a column of pairs cannot be written as JSON."""
    return F.expr(f"NOT coalesce(exists({attributes}, a -> {_not_finite('a.value')}), false)")


def body_text(body: str) -> Column:
    """A body column as text: strings as they are, binary as base64, other scalars printed, lists and maps as JSON."""
    number = _number(body)
    # The texts that numbers JSON lacks turn into.
    return F.expr(f"""CASE
      WHEN {body} IS NULL OR schema_of_variant({body}) = 'VOID' THEN ''
      WHEN schema_of_variant({body}) = 'STRING' THEN try_variant_get({body}, '$', 'string')
      WHEN schema_of_variant({body}) = 'BINARY' THEN base64(try_variant_get({body}, '$', 'binary'))
      WHEN {_is_double(body)} THEN CASE
        WHEN isnan({number}) THEN 'json: unsupported value: NaN'
        WHEN {number} = double('Infinity') THEN 'json: unsupported value: +Inf'
        WHEN {number} = double('-Infinity') THEN 'json: unsupported value: -Inf'
        ELSE {double_text(number)} END
      WHEN {_not_finite(body)} THEN ''
      ELSE {with_escapes_text(value_json(body))} END""")
