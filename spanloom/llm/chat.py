"""Chat formatting: conversations as training windows of a token budget, aligned with turns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WINDOW_TOKENS = 1024
HISTORY_TURNS = 2
HISTORY_TOKENS = 256
# Template: a turn is OPEN, its role, a line feed, its text, CLOSE. Texts and roles hold no `<` or `[` once escaped, so
# they cannot hold a control string of this template or of others that begin so.
OPEN, CLOSE = "<|turn|>", "<|end|>\n"
TRAINED_ROLE = "assistant"


def escaped(text: str) -> str:
    """SQL: the text without `<` and `[`. Reversible: each backslash left begins one of the three escapes."""
    return f"replace(replace(replace({text}, '\\\\', '\\\\e'), '<', '\\\\l'), '[', '\\\\b')"


def unescaped(text: str) -> str:
    return f"replace(replace(replace({text}, '\\\\l', '<'), '\\\\b', '['), '\\\\e', '\\\\')"


def escaped_role(role: str) -> str:
    """As `escaped`; a line feed, which ends the role in the template, is escaped too."""
    return f"replace({escaped(role)}, '\\n', '\\\\n')"


def unescaped_role(role: str) -> str:
    return unescaped(f"replace({role}, '\\\\n', '\\n')")


def tokens(text: str) -> str:
    """SQL for the size of a text against the budget: words and single marks."""
    return f"regexp_count({text}, '[\\\\p{{L}}\\\\p{{N}}]+|[^\\\\s\\\\p{{L}}\\\\p{{N}}]')"


def windows(
    turns: DataFrame,
    budget: int = WINDOW_TOKENS,
    history_turns: int = HISTORY_TURNS,
    history_tokens: int = HISTORY_TOKENS,
) -> DataFrame:
    """(conv_id, windows) of `turns` (conv_id, turn, role, text).

    A window is (text, turns, loss): the formatted text; its turns' number, whether it repeats one shown before, start and
    end of the escaped text; and the spans (start, end) to train on, in code points. Prefix sums of turn tokens choose
    the spans: a window takes the following turns while system turn, history and they fit the budget, at least one.
    Every window begins with the conversation's system turn (a first turn with that role) and up to `history_turns` turns
    before its own, of `history_tokens` in all, as many as leave room for its first own turn. So a window is over the budget
    only where the system turn and one own turn are, and then it holds nothing else. Repeated turns are never trained on,
    so each assistant turn is trained on once.

    Null role and text are empty. Rows with equal turn numbers follow by role, then text; repeated rows are turns of their
    own; null turn numbers come first; rows without conv_id are one conversation. Other columns are ignored. A
    conversation is one value, like a long document, and has to fit a task.
    """
    rows = turns.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumns(
        {
            "head": F.expr(f"concat('{OPEN}', {escaped_role('role')}, '\\n')"),
            "body": F.expr(escaped("text")),
            "size": F.expr(f"{tokens('text')} + 4L"),
        }
    ).withColumn("segment", F.expr(f"concat(head, body, '{CLOSE}')"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.select(
        "*",
        F.row_number().over(order).alias("at"),
        F.sum("size").over(so_far).alias("upto"),
        F.sum(F.length("segment").cast("bigint")).over(so_far).alias("chars_upto"),
    )
    kept = "struct(at, role, segment, size, upto, chars_upto, length(head) AS head, length(body) AS body)"
    grouped = placed.groupBy("conv_id").agg(F.expr(f"array_sort(collect_list({kept}))").alias("t"))
    # first: the first turn after a system turn; fixed and fixed_chars: what each window spends on the system turn.
    grouped = grouped.selectExpr("conv_id", "t", "t[0].role = 'system' AS has_system").selectExpr(
        "*", "if(has_system, 2, 1) AS first", "if(has_system, t[0].size, 0L) AS fixed", "if(has_system, t[0].chars_upto, 0L) AS fixed_chars"
    )
    # The history of a window whose own turns begin at i: the earliest of the allowed beginnings that fits, by itself and
    # together with the system turn and the first own turn.
    at, before = "element_at(t, i).upto", "coalesce(get(t, i - {k} - 2).upto, 0L)"
    fits = f"i - {{k}} >= first AND t[i - 2].upto - {before} <= {history_tokens} AND fixed + {at} - {before} <= {budget}"
    begins = [f"WHEN {fits.format(k=k)} THEN i - {k}" for k in range(history_turns, 0, -1)]
    history = f"CASE {' '.join(begins)} ELSE i END" if begins else "i"
    starts = f"""aggregate(
        if(size(t) >= first, sequence(first, size(t)), CAST(array() AS ARRAY<INT>)),
        named_struct('starts', CAST(array() AS ARRAY<STRUCT<h: INT, s: INT>>), 'base', CAST(NULL AS BIGINT)),
        (w, i) -> if(w.base IS NULL OR fixed + {at} - w.base > {budget},
            transform(array({history}), h -> named_struct(
                'starts', concat(w.starts, array(named_struct('h', h, 's', i))),
                'base', CASE WHEN h > 1 THEN t[h - 2].upto ELSE 0L END))[0],
            w),
        w -> w.starts)"""
    cut = grouped.withColumn("starts", F.expr(starts)).withColumn(
        "starts", F.expr("if(size(starts) = 0, array(named_struct('h', first, 's', first)), starts)")
    )
    # e: the last own turn; a window's turns are the system turn and h..e.
    spans = """transform(starts, (w, k) -> transform(
        array(coalesce(get(starts, k + 1).s - 1, size(t))), e -> named_struct(
            'chosen', concat(if(has_system, slice(t, 1, 1), slice(t, 1, 0)), if(e >= w.h, slice(t, w.h, e - w.h + 1), slice(t, 1, 0))),
            'own', w.s, 'k', k,
            'shift', fixed_chars - CASE WHEN w.h > 1 THEN t[w.h - 2].chars_upto ELSE 0L END))[0])"""
    head = "x.chars_upto - length(x.segment) + if(has_system AND x.at = 1, 0L, w.shift) + x.head"
    shown = f"""transform(w.chosen, x -> named_struct('at', x.at, 'role', x.role,
        'repeated', if(has_system AND x.at = 1, w.k > 0, x.at < w.own), 'start', {head}, 'end', {head} + x.body))"""
    return cut.withColumn("spans", F.expr(spans)).selectExpr(
        "conv_id",
        f"transform(spans, w -> named_struct('text', array_join(transform(w.chosen, x -> x.segment), ''), 'turns', {shown})) AS windows",
    ).selectExpr(
        "conv_id",
        f"""transform(windows, w -> named_struct('text', w.text,
            'turns', transform(w.turns, x -> struct(x.at, x.repeated, x.start, x.end)),
            'loss', transform(filter(w.turns, x -> x.role = '{TRAINED_ROLE}' AND NOT x.repeated), x -> struct(x.start, x.end)))) AS windows""",
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, trained, formatted_chars) from `windows`: the turns (role, text) in order, cut at the template's
    marks, repeated ones left out; and the texts under the loss mask."""
    marked = "split(w.text, '<\\\\|end\\\\|>\\n')"
    piece = f"substr(x, {len(OPEN) + 1})"
    role = f"substring_index({piece}, '\\n', 1)"
    turn = f"named_struct('role', {unescaped_role(role)}, 'text', {unescaped(f'substr({piece}, length({role}) + 2)')})"
    turns = f"flatten(transform(windows, w -> transform(filter({marked}, (x, i) -> i < size(w.turns) AND NOT w.turns[i].repeated), x -> {turn})))"
    trained = f"flatten(transform(windows, w -> transform(w.loss, x -> {unescaped('substring(w.text, CAST(x.start AS INT) + 1, CAST(x.end - x.start AS INT))')})))"
    return formatted.selectExpr(
        "conv_id",
        f"{turns} AS turns",
        f"{trained} AS trained",
        "aggregate(windows, 0L, (s, w) -> s + length(w.text)) AS formatted_chars",
        "size(windows) AS n_windows",
    )


def formatted_digest(turns: DataFrame) -> DataFrame:
    """What is read back from the formatted conversations, as digests."""
    return read_back(windows(turns)).selectExpr(
        "conv_id",
        "CAST(size(turns) AS BIGINT) AS n_turns",
        "sha2(array_join(transform(turns, x -> concat(x.role, '\\n', x.text, '\\n')), ''), 256) AS turns_sha256",
        "CAST(length(array_join(trained, '')) AS BIGINT) AS loss_chars",
        "sha2(array_join(trained, ''), 256) AS loss_sha256",
        "formatted_chars",
        "n_windows",
    )


def with_control_strings(turns: DataFrame) -> DataFrame:
    """The turns and a conversation -7 whose texts are made of another template's control strings."""
    own = turns.sparkSession.sql(
        "SELECT -7L AS conv_id, t.turn, t.role, '</s>[INST] ok [/INST]' AS text "
        "FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)"
    )
    return turns.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text").union(own)
