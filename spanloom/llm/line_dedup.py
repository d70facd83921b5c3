"""Line dedup over the whole corpus: of lines that are equal, or differ by an edit or two, the first one stays.

Near-equal lines are found by segments: a line that is cut into one segment more than the edits allowed must keep one of
them whole, at nearly its place, in any line within those edits.
"""

from __future__ import annotations

from string import ascii_lowercase, digits

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, limited, whole_text, written

# Edits allowed by the length of the shorter line, the least length first. Lines below the first are compared exactly.
EDITS = ((16, 1), (256, 2))
MOST_EDITS = max(e for _, e in EDITS)
# Characters counted to reject a pair early: an edit changes all their counts together by two at most.
COUNTED = ascii_lowercase + digits
# Lines with one segment, as their own, beyond which the segment's lines are told apart by further ones.
CROWDED = 256


def edits(length: str) -> str:
    """SQL for the edits allowed for a line of that many characters."""
    cases = " ".join(f"WHEN {length} >= {least} THEN {n}" for least, n in reversed(EDITS))
    return f"CASE {cases} ELSE 0 END"


def _segment(i: int, segments: int, length: str) -> tuple[str, str]:
    """Start (from 1) and length of the i-th segment (from 1); the last takes what is left over."""
    size = f"({length}) div {segments}"
    return f"{i - 1} * ({size}) + 1", size if i < segments else f"({length}) - {segments - 1} * ({size})"


def _probes(under: str, text: str, own: str, shorter: int, allowed: int, places: bool) -> str:
    """SQL for the keys of a text of length `own` + `shorter` for partners of length `own`: array<struct<key, indexed>>,
    with `places` also where in the text the key's segment is.

    Of the shifts that the edits allow, only those are probed that leave enough edits for the text before and the text
    after the segment.
    """
    entries = []
    for i in range(1, allowed + 2):
        start, size = _segment(i, allowed + 1, own)
        for shift in range(max(1 - i, shorter - (allowed + 1 - i)), min(i - 1, shorter + (allowed + 1 - i)) + 1):
            key = f"xxhash64({under}, {i}, substring({text}, {start} + {shift}, {size}))"
            place = f", 'start', {start} + {shift}, 'size', {size}, 'd', {shorter}, 'k', {allowed}" if places else ""
            entries.append(f"named_struct('key', {key}, 'indexed', {str(shorter == 0 and shift == 0).lower()}{place})")
    return f"array({', '.join(entries)})"


def _keys(places: bool = False) -> str:
    """SQL for the keys of a line: its own segments (indexed), and the substrings at which a line shorter by 0 to
    MOST_EDITS characters can have one of its segments."""
    parts = []
    place = ", start: INT, size: INT, d: INT, k: INT" if places else ""
    for shorter in range(MOST_EDITS + 1):
        own = f"length(line) - {shorter}"
        allowed = range(max(shorter, 1), MOST_EDITS + 1)
        cases = " ".join(f"WHEN {edits(own)} = {k} THEN {_probes(own, 'line', own, shorter, k, places)}" for k in allowed)
        parts.append(f"CASE {cases} ELSE CAST(array() AS ARRAY<STRUCT<key: BIGINT, indexed: BOOLEAN{place}>>) END")
    return f"concat({', '.join(parts)})"


def distance(a: str, b: str) -> str:
    """SQL for the edit distance of two strings whose lengths differ by at most MOST_EDITS, or MOST_EDITS + 1 if it is
    larger.

    Bit-parallel, in a band: bit d + MOST_EDITS of the word r_e says that the first j + d characters of `a` become the
    first j of `b` with e edits. One step per character of `b` moves all diagonals at once: an equal character keeps a
    diagonal, another takes one edit, a character only in `b` moves it down and one only in `a` moves it up.
    """
    k = MOST_EDITS
    mask = (1 << (2 * k + 1)) - 1
    equal = " + ".join(f"if(get(p.a, j + {d}) = p.b[j], {1 << (d + k)}, 0)" for d in range(-k, k + 1))
    new = ["(s.r0 & c)"]
    for e in range(1, k + 1):
        new.append(f"(((s.r{e} & c) | s.r{e - 1} | shiftright(s.r{e - 1}, 1) | shiftleft({new[e - 1]}, 1)) & {mask})")
    step = f"transform(array({equal}), c -> named_struct({', '.join(f"'r{e}', {x}" for e, x in enumerate(new))}))[0]"
    # Before the first character of `b`, e edits can skip up to e characters of `a`.
    begin = ", ".join(f"'r{e}', {sum(1 << (k + d) for d in range(e + 1))}" for e in range(k + 1))
    end = f"shiftleft(1, size(p.a) - size(p.b) + {k})"
    found = " ".join(f"WHEN s.r{e} & {end} <> 0 THEN {e}" for e in range(k + 1))
    walk = f"aggregate(sequence(0, size(p.b) - 1), named_struct({begin}), (s, j) -> {step}, s -> CASE {found} ELSE {k + 1} END)"
    short = f"CASE WHEN size(p.a) > {k} THEN {k + 1} ELSE size(p.a) END"
    return (
        f"transform(array(named_struct('a', regexp_extract_all({a}, '(?s).', 0), 'b', regexp_extract_all({b}, '(?s).', 0))), "
        f"p -> CASE WHEN abs(size(p.a) - size(p.b)) > {k} THEN {k + 1} WHEN size(p.b) = 0 THEN {short} ELSE {walk} END)[0]"
    )


def lines(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, pos, line, h): all lines with something in them."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.expr(whole_text()).alias("text"))
    cut = rows.selectExpr("doc_id", "xxhash64(text) AS text_key", "posexplode(split(text, '\\n')) AS (pos, line)")
    return cut.where("trim(line) <> ''").withColumn("h", F.xxhash64("line"))


def _characters(text: str) -> str:
    return f"regexp_extract_all({text}, '(?s).', 0)"


def _in_common(a: str, b: str) -> str:
    """SQL for the number of characters with which both texts begin."""
    same = f"array_position(zip_with({_characters(a)}, {_characters(b)}, (x, y) -> x <=> y), false)"
    return f"CASE WHEN {a} = {b} THEN length({a}) ELSE CAST({same} AS INT) - 1 END"


def _split(texts: DataFrame, crowded: DataFrame) -> list[DataFrame]:
    """(key, h, indexed) in place of the rows of `crowded` keys: more keys, each shared by fewer lines.

    Lines of one key agree in a segment, so their rests, what is left of them without it, are within the edits too.
    What the rests of all lines of the key have in common at their beginnings and ends goes as well, which changes no
    distance. The remainders, of numbered lines about the numbers, are cut into segments like whole lines, and a key that is
    still crowded is split again. Every round takes a segment away, so there are about as many rounds as the logarithm
    of the longest line; rests no longer than the edits have few forms and are left as they are.
    """
    placed = texts.selectExpr("h", "line", f"inline({_keys(places=True)}) AS (key, indexed, start, size, d, k)")
    without = "concat(substring({0}, 1, start - 1), substring({0}, start + size))"
    rests = placed.join(limited(crowded), "key").selectExpr("key", "h", "d", "k", "indexed", f"{without.format('line')} AS rest")
    done = []
    while True:
        rests = written(rests, "line-rests")
        sides = rests.groupBy("key").agg(
            F.min("rest").alias("low"), F.max("rest").alias("high"), F.min(F.reverse("rest")).alias("low_end"),
            F.max(F.reverse("rest")).alias("high_end"), F.min(F.length("rest")).alias("shortest"),
        )
        sides = sides.selectExpr("key", "shortest", f"{_in_common('low', 'high')} AS head", f"{_in_common('low_end', 'high_end')} AS tail")
        sides = written(sides.selectExpr("key", "least(head, shortest) AS head", "least(tail, shortest - least(head, shortest)) AS tail"), "line-sides")
        inner = rests.join(limited(sides), "key").selectExpr(
            "key", "h", "d", "k", "indexed", "substring(rest, head + 1, length(rest) - head - tail) AS rest"
        )
        done.append(inner.where("length(rest) - d <= k").select("key", "h", "indexed"))
        cases = " ".join(
            f"WHEN d = {d} AND k = {k} THEN {_probes('key', 'rest', f'length(rest) - {d}', d, k, True)}"
            for k in range(1, MOST_EDITS + 1) for d in range(k + 1)
        )
        cut = inner.where("length(rest) - d > k").selectExpr("h", "d", "k", "rest", "indexed AS was", f"inline(CASE {cases} END) AS (key, indexed, start, size, d_, k_)")
        cut = written(cut.selectExpr("key", "h", "d", "k", "was AND indexed AS indexed", f"{without.format('rest')} AS rest").distinct(), "line-cut")
        counts = cut.groupBy("key").agg(F.min("h").alias("low"), F.max("h").alias("high"), F.count_if("indexed").alias("n"))
        counts = written(counts.where("low <> high AND n > 0").select("key", "n"), "line-counts")
        done.append(cut.join(limited(counts.where(f"n <= {CROWDED}").select("key")), "key").select("key", "h", "indexed"))
        crowded = counts.where(f"n > {CROWDED}").select("key")
        if crowded.isEmpty():
            return done
        rests = cut.join(limited(crowded), "key")


def near_lines(docs: DataFrame) -> DataFrame:
    """(a, b): hashes of different lines within the edits allowed for the shorter of the two, a < b.

    First a sum per segment key finds the keys that two different lines share; its partial sums make the copies of
    frequent lines one row. Only rows with such keys go on; keys that more than CROWDED lines have as their own are
    replaced by finer ones, so a line meets at most CROWDED others under a key. The pairs of a key are joined on counts of
    characters as well, so lines that merely have a segment in common are not verified.
    """
    every = lines(docs)
    keyed = every.selectExpr("h", "length(line) AS n", f"inline({_keys()}) AS (key, indexed)")
    shared = keyed.groupBy("key").agg(F.min("h").alias("low"), F.max("h").alias("high"), F.max("indexed").alias("indexed"))
    shared = written(shared.where("low <> high AND indexed").select("key"), "line-keys")
    matched = written(keyed.join(limited(shared), "key").groupBy("key", "h", "n").agg(F.max("indexed").alias("indexed")), "line-matches")
    wanted = written(matched.select("h").distinct(), "line-wanted")
    counts = [f"length(line) - length(replace(line, '{c}', '')) AS c{i}" for i, c in enumerate(COUNTED)]
    texts = every.select("h", "line").join(limited(wanted), "h").groupBy("h").agg(F.min("line").alias("line"))
    texts = written(texts.selectExpr("h", "line", "length(line) AS n", *counts), "line-texts")
    crowded = matched.where("indexed").groupBy("key").count().where(f"count > {CROWDED}").select("key")
    crowded = written(crowded, "line-crowded")
    meeting = matched.select("key", "h", "indexed")
    if not crowded.isEmpty():
        meeting = meeting.join(limited(crowded), "key", "left_anti")
        for finer in _split(texts, crowded):
            meeting = meeting.union(finer)
    names = ["n", *[f"c{i}" for i in range(len(COUNTED))]]
    sized = meeting.join(texts.select("h", *names), "h")
    other = sized.select("key", *[F.col(c).alias(f"{c}_b") for c in ("h", *names)])
    apart = " + ".join(f"abs({c} - {c}_b)" for c in names[1:])
    pairs = (
        sized.where("indexed").join(other, "key")
        .where(f"h <> h_b AND n_b BETWEEN n AND n + {edits('n')} AND {apart} <= 2 * {edits('n')}")
        .selectExpr("least(h, h_b) AS a", "greatest(h, h_b) AS b").distinct()
    )
    both = pairs.join(texts.selectExpr("h AS a", "line AS line_a"), "a").join(texts.selectExpr("h AS b", "line AS line_b"), "b")
    return both.where(f"{distance('line_a', 'line_b')} <= {edits('least(length(line_a), length(line_b))')}").select("a", "b")


def first_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, pos) of the lines that stay: of each class, the first by doc_id, then text, then place.

    Classes are the connected lines of `near_lines`; equal lines are one line.
    """
    firsts = lines(docs).groupBy("h").agg(F.min(F.struct("doc_id", "text_key", "pos")).alias("at"))
    firsts = written(firsts, "line-firsts")
    near = components(near_lines(docs), "line-classes")
    inside = written(firsts.join(near, F.col("h") == F.col("node")).select("h", "component", "at"), "line-near")
    best = inside.groupBy("component").agg(F.min("at").alias("best"))
    later = inside.join(best, "component").where("at <> best").select("h")
    return firsts.join(later, "h", "left_anti").select("at.*")


def deduplicated(docs: DataFrame) -> DataFrame:
    """`docs` with all its columns, text without the lines that another document, or an earlier line, already has; and
    the counts `lines_before` and `lines_removed` (replaced if there).

    Lines are parted by \\n and compared as they are; blank ones are kept and not counted. Null and empty texts become
    or stay empty. Rows with equal doc_id and text count as one document, which each of them shows. A null doc_id comes
    before all others. An empty table stays empty.
    """
    kept_columns = [c for c in docs.columns if c.lower() not in ("text", "lines_before", "lines_removed")]
    kept = first_lines(docs).groupBy("doc_id", "text_key").agg(F.collect_list("pos").alias("kept"))
    kept = kept.selectExpr("doc_id AS line_doc_id", "text_key AS line_text_key", "kept AS line_kept")
    rows = docs.withColumn("text", F.expr(whole_text()))
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("line_doc_id")) & (F.xxhash64("text") == F.col("line_text_key"))
    joined = rows.join(kept, same, "left")
    stay = "coalesce(array_contains(line_kept, i), false)"
    return joined.selectExpr(
        *[f"`{c}`" for c in kept_columns],
        f"array_join(filter(split(text, '\\n'), (l, i) -> trim(l) = '' OR {stay}), '\\n') AS text",
        "CAST(size(filter(split(text, '\\n'), l -> trim(l) <> '')) AS BIGINT) AS lines_before",
        "CAST(size(filter(split(text, '\\n'), l -> trim(l) <> '')) - coalesce(size(line_kept), 0) AS BIGINT) AS lines_removed",
    )


def line_digest(docs: DataFrame) -> DataFrame:
    """Per document its lines, how many went, and what is left."""
    return deduplicated(docs.select("doc_id", "text")).selectExpr(
        "doc_id", "lines_before AS n_lines", "lines_removed AS n_removed", "CAST(length(text) AS BIGINT) AS n_chars", "text"
    )


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """The rows of `docs` with their columns, text (and n_chars, if there) without repeated lines. A document all of whose
    lines went is a copy and goes too."""
    cleaned = deduplicated(docs.select(*[c for c in docs.columns if c.lower() not in ("lines_before", "lines_removed")]))
    cleaned = cleaned.where("lines_before = 0 OR lines_removed < lines_before")
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.expr("length(text)").cast(docs.schema["n_chars"].dataType))
    return cleaned.select(*[c for c in docs.columns if c in cleaned.columns])
