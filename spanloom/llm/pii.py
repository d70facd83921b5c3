"""Personal data: patterns find the values to protect, and what the whole corpus says about the words in the same documents
decides which of those words give a value away and have to go too."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import whole_text, written

# Kinds in the order of the contract. The patterns match what the plain ones match, without their backtracking: runs are
# possessive and entered at their first character only (or where the last match ended).
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A text without this character holds no match, so the pattern is not tried.
NEEDED = {"email": "@", "ip": ".", "card": "", "phone": "+"}
TERM = "term"

WORD = r"[\p{L}\p{N}]+"
# A word is sensitive from this share of the value's own information on. From REMOVED_SHARE on it is removed, below it
# generalised to a mark.
DISCLOSED_SHARE = 0.75
REMOVED_SHARE = 0.9


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def located(text: str, pattern: str) -> str:
    """SQL: all matches of a pattern as array<struct<start, end, value>>, in code points.

    The gaps between matches come from a split by the same pattern, and their lengths place the matches.
    """
    found, gaps = f"regexp_extract_all({text}, {_sql(pattern)}, 0)", f"split({text}, {_sql(pattern)}, -1)"
    step = (
        "transform(array(s.at + length(m.gaps[i])), a -> named_struct('at', a + length(m.found[i]), 'out', concat(s.out, "
        "array(named_struct('start', a, 'end', a + length(m.found[i]), 'value', m.found[i])))))[0]"
    )
    none = "CAST(array() AS ARRAY<STRUCT<start: INT, end: INT, value: STRING>>)"
    placed = f"aggregate(sequence(0, size(m.found) - 1), named_struct('at', 0, 'out', {none}), (s, i) -> {step}, s -> s.out)"
    return f"transform(array(named_struct('found', {found}, 'gaps', {gaps})), m -> if(size(m.found) = 0, {none}, {placed}))[0]"


def _valid(kind: str, value: str) -> str:
    digits = f"regexp_replace({value}, '[^0-9]', '')"
    digit = "CAST(substr(d, length(d) + 1 - i, 1) AS INT)"
    luhn = f"aggregate(sequence(1, length(d)), 0, (s, i) -> s + CASE WHEN i % 2 = 1 THEN {digit} WHEN {digit} > 4 THEN 2 * {digit} - 9 ELSE 2 * {digit} END) % 10 = 0"
    return {
        "email": "true",
        "ip": f"{value} RLIKE {_sql(r'^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}$')}",
        "card": f"exists(array({digits}), d -> length(d) BETWEEN 12 AND 19 AND {luhn})",
        "phone": f"length({digits}) BETWEEN 9 AND 15",
    }[kind]


def base_spans(text: str) -> str:
    """SQL: the values to protect in a text, array<struct<start, n, kind, end, value>> by start, then kind as listed."""
    parts = []
    for n, kind in enumerate(PATTERNS):
        spans = located(text, PATTERNS[kind])
        if NEEDED[kind]:
            spans = f"if(contains({text}, {_sql(NEEDED[kind])}), {spans}, CAST(array() AS ARRAY<STRUCT<start: INT, end: INT, value: STRING>>))"
        entry = f"named_struct('start', x.start, 'n', {n}, 'kind', '{kind}', 'end', x.end, 'value', x.value)"
        parts.append(f"transform(filter({spans}, x -> {_valid(kind, 'x.value')}), x -> {entry})")
    return f"array_sort(concat({', '.join(parts)}))"


def _masked(text: str, spans: str) -> str:
    """SQL: the text with a space for every character of its spans."""
    gap = f"substring({text}, s.at + 1, greatest(x.start, s.at) - s.at)"
    return (
        f"aggregate({spans}, named_struct('at', 0, 'out', ''), (s, x) -> if(x.end <= s.at, s, named_struct('at', x.end, "
        f"'out', concat(s.out, {gap}, repeat(' ', x.end - greatest(x.start, s.at))))), s -> concat(s.out, substring({text}, s.at + 1)))"
    )


def _term(word: str) -> str:
    return f"xxhash64(lower({word}))"


def _terms(text: str) -> str:
    """SQL: the different words of a text, as numbers."""
    return f"array_distinct(transform(regexp_extract_all({text}, {_sql(WORD)}, 0), w -> {_term('w')}))"


_TERM_SPANS = "ARRAY<STRUCT<start: INT, end: INT, removed: BOOLEAN>>"


def _occurrences(text: str, marks: str) -> str:
    """SQL: where the words of `marks`, array<struct<term, removed>>, stand in a text, array<struct<start, end, removed>>."""
    hit = f"filter({marks}, y -> y.term = z.term)[0]"
    step = (
        f"transform(array(named_struct('at', s.at + length(m.gaps[i]), 'term', {_term('m.found[i]')}, 'size', length(m.found[i]))), z -> named_struct("
        f"'at', z.at + z.size, 'out', if(exists({marks}, y -> y.term = z.term), concat(s.out, array(named_struct("
        f"'start', z.at, 'end', z.at + z.size, 'removed', {hit}.removed))), s.out)))[0]"
    )
    walk = f"aggregate(sequence(0, size(m.found) - 1), named_struct('at', 0, 'out', CAST(array() AS {_TERM_SPANS})), (s, i) -> {step}, s -> s.out)"
    return (
        f"transform(array(named_struct('found', regexp_extract_all({text}, {_sql(WORD)}, 0), 'gaps', split({text}, {_sql(WORD)}, -1))), "
        f"m -> if(size(m.found) = 0, CAST(array() AS {_TERM_SPANS}), {walk}))[0]"
    )


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, key): rows with equal doc_id and text, and only those, have one key."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.expr(whole_text()).alias("text"))
    return rows.withColumn("key", F.expr("unhex(substr(sha2(concat(coalesce(CAST(doc_id AS STRING), ''), ':', text), 256), 1, 32))"))


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, key, base, terms) of `docs` (doc_id, text): the protected values of each text, and all places of the words in
    it that disclose one of them. Spans are in code points, their end exclusive.

    How much a word says about a value is their pointwise mutual information, log2(P(value | word) / P(value)), as a share
    of the value's own information, log2(1 / P(value)): a word seen with hardly anything else has a share near 1, a
    word seen everywhere near 0. All three counts are of documents of the whole corpus, wherever in a text word and value
    stand; words that lie in values are not looked at. A value of one document is disclosed by that document's rarest words.

    P(value, word) is at most P(value), so only words of up to n_value^DISCLOSED_SHARE * n^(1 - DISCLOSED_SHARE) documents
    can disclose a value; other pairs are left out before they are made.

    A null text is empty, an empty text has no spans; rows with equal doc_id and text count as documents of their own and
    get equal results; a null doc_id is kept; other columns are ignored; an empty table gives no rows.
    """
    rows = _keyed(docs)
    spans = rows.withColumn("base", F.expr(base_spans("text")))
    scanned = written(spans.selectExpr("doc_id", "key", "base", f"if(size(base) > 0, {_masked('text', 'base')}, NULL) AS masked"), "pii-spans")
    n = scanned.count()
    holding = scanned.where("masked IS NOT NULL")
    held = holding.selectExpr("key", "explode(array_distinct(transform(base, x -> xxhash64(x.kind, x.value)))) AS value")
    values = held.groupBy("value").agg(F.count("*").alias("n_value")).where(f"n_value < {n}")
    # `most`: the most documents of a word that can still disclose the value, rounded up against errors of the last digit.
    most = f"ceil(pow(n_value, {DISCLOSED_SHARE}D) * pow({n}, {1 - DISCLOSED_SHARE}D)) + 1"
    valued = written(held.distinct().join(values, "value").selectExpr("key", "value", "n_value", f"{most} AS most"), "pii-values")
    frequency = rows.selectExpr(f"explode({_terms('text')}) AS term").groupBy("term").agg(F.count("*").alias("n_term"))
    reach = valued.groupBy("key").agg(F.max("most").alias("reach"))
    words = holding.select("key", "masked").join(reach, "key").selectExpr("key", "reach", f"explode({_terms('masked')}) AS term")
    rare = words.join(frequency, "term").where("n_term <= reach").select("key", "term", "n_term")
    pairs = written(rare.join(valued, "key").where("n_term <= most").select("key", "value", "term", "n_value", "n_term"), "pii-pairs")
    share = f"log2(n_both * {n}D / (CAST(n_value AS DOUBLE) * n_term)) / log2({n}D / n_value)"
    disclosing = (
        pairs.groupBy("value", "term", "n_value", "n_term").agg(F.count("*").alias("n_both"))
        .selectExpr("value", "term", f"{share} AS share").where(f"share >= {DISCLOSED_SHARE}")
    )
    marked = (
        pairs.join(disclosing, ["value", "term"])
        .groupBy("key", "term").agg(F.expr(f"max(share) >= {REMOVED_SHARE} AS removed"))
        .groupBy("key").agg(F.collect_list(F.struct("term", "removed")).alias("marks"))
    )
    placed = f"if(marks IS NULL, CAST(array() AS {_TERM_SPANS}), {_occurrences('masked', 'marks')})"
    return scanned.join(marked, "key", "left").selectExpr("doc_id", "key", "base", f"{placed} AS terms")


def sanitise(docs: DataFrame) -> DataFrame:
    """(doc_id, text): protected values replaced by their kind, disclosing words removed or generalised to [TERM].

    Of spans that overlap, the one that starts first is replaced and the others with it. Repeated rows come out as often
    as they came in.
    """
    spans = find(docs).drop("doc_id").dropDuplicates(["key"])
    cuts = """array_sort(concat(transform(base, x -> struct(x.start AS start, x.end AS end, concat('[', upper(x.kind), ']') AS mark)),
        transform(terms, x -> struct(x.start AS start, x.end AS end, if(x.removed, '', '[TERM]') AS mark))))"""
    cleaned = f"""aggregate({cuts}, named_struct('at', 0, 'out', ''),
        (s, x) -> named_struct('at', greatest(s.at, x.end), 'out',
            if(x.start < s.at, s.out, concat(s.out, substring(text, s.at + 1, x.start - s.at), x.mark))),
        s -> concat(s.out, substring(text, s.at + 1, length(text))))"""
    return _keyed(docs).join(spans, "key").selectExpr("doc_id", f"{cleaned} AS text")


def span_digest(docs: DataFrame) -> DataFrame:
    """Per document the counts of base spans, their digest, and all spans as kind:start:end."""
    counts = [f"CAST(size(filter(base, x -> x.kind = '{k}')) AS BIGINT) AS n_{k}" for k in PATTERNS]
    shown = "concat(x.kind, ':', x.start, ':', x.end)"
    everything = (
        f"array_sort(concat(transform(base, x -> named_struct('start', x.start, 'n', x.n, 'kind', x.kind, 'end', x.end)), "
        f"transform(terms, x -> named_struct('start', x.start, 'n', {len(PATTERNS)}, 'kind', '{TERM}', 'end', x.end))))"
    )
    return find(docs).selectExpr(
        "doc_id",
        *counts,
        f"sha2(array_join(transform(base, x -> {shown}), ','), 256) AS base_sha256",
        f"array_join(transform({everything}, x -> {shown}), ',') AS spans",
        "CAST(size(terms) AS BIGINT) AS n_terms",
    )
