"""Chat formatting: budgeted windows of whole turns with masked history.

DataFrame and SQL functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import read_table, running_totals

WINDOW_TOKENS = 1024
HISTORY_TOKENS = 192
BYTES_PER_TOKEN = 4
# Windows are cut on their own in stretches of this many budgets.
STRETCH_WINDOWS = 16

# A turn is HEAD role MIDDLE text TAIL.
HEAD, MIDDLE, TAIL = "<|", "|>\n", "<|end|>\n"
# Control strings, each broken up by a backslash after its first character.
CONTROL = ("<|", "|>", "</s>", "<s>", "[INST]", "[/INST]")


def escape(text: Column) -> Column:
    """No control string is left: backslashes are doubled, then each string gets one inside."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROL:
        out = F.replace(out, F.lit(c), F.lit(f"{c[0]}\\{c[1:]}"))
    return out


def unescape(text: str) -> str:
    """SQL: what :func:`escape` was given."""
    return rf"regexp_replace({text}, r'(?s)\\(.)', '$1')"


def window_starts(placed: DataFrame, window_tokens: int) -> DataFrame:
    """s_conv, s_stretch, starts, following: where windows begin in a stretch, and where in the next one.

    A stretch is gone through once, turn by turn; it has at most ``STRETCH_WINDOWS * window_tokens / 4`` turns,
    as even an empty turn takes four tokens.
    """
    cut = F.expr(
        "aggregate(turns, named_struct('upto', -1L, 'starts', cast(array() as array<struct<rank: bigint, at: bigint>>)), "
        "(acc, t) -> if(t.at + t.size <= acc.upto, acc, named_struct("
        f"'upto', t.at + if(stretch = 0 and size(acc.starts) = 0, {window_tokens}L, room), "
        "'starts', concat(acc.starts, array(named_struct('rank', t.rank, 'at', t.at))))), acc -> acc.starts)"
    )
    lists = placed.groupBy("conv_id", "stretch").agg(
        F.sort_array(F.collect_list(F.struct("rank", "at", "size"))).alias("turns"), F.max("room").alias("room")
    )
    starts = lists.select(F.col("conv_id").alias("s_conv"), F.col("stretch").alias("s_stretch"), cut.alias("starts"))
    following = F.lead("starts").over(Window.partitionBy("s_conv").orderBy("s_stretch"))
    return starts.withColumn("following", F.coalesce(following, F.expr("slice(starts, 1, 0)")))


def chat_windows(
    turns: DataFrame, window_tokens: int = WINDOW_TOKENS, history_tokens: int = HISTORY_TOKENS
) -> DataFrame:
    """Windows of conversations: conv_id, window, formatted, new_from, loss.

    ``turns`` has conv_id, turn, role, text; turns are ordered by turn (ties by role and text, repeated rows
    stay), null roles and texts are empty, a null conv_id is a conversation of its own, other columns are not
    read.  A turn's tokens are its formatted bytes by four.  Prefix sums of tokens give every turn its place in
    the conversation.  A window takes turns as long as they fit in what the budget leaves after the system turns
    and history (all of it in a conversation's first window), and a new one begins before a turn that would
    overrun; so a window is over budget only for a turn, or a system turn, that is too long by itself.

    Windows are cut within stretches of ``STRETCH_WINDOWS`` budgets, at whose borders one begins in any case:
    long conversations are spread over many tasks, and a stretch holds a bounded number of turns.  Every window
    but the first begins with the first system turn, if that came before, and with the latest turns that fit
    in ``history_tokens``.  ``window`` is the rank of its first new turn, ``new_from`` where its new turns begin;
    ``loss`` lists (start, length) of the new assistant texts, so that each is learned once: repeated
    ones are masked.  Offsets are code points.
    """
    if not 0 <= history_tokens < window_tokens:
        raise ValueError("history must be shorter than a window")
    head = F.concat(F.lit(HEAD), escape(F.col("role")), F.lit(MIDDLE))
    body = escape(F.col("text"))
    fmt = F.concat(head, body, F.lit(TAIL))
    tokens = F.ceil(F.octet_length(fmt) / BYTES_PER_TOKEN).cast("long")
    sized = turns.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).select(
        "*",
        tokens.alias("size"),
        F.when(F.col("role") == "system", tokens).otherwise(0).cast("long").alias("system_size"),
        F.lit(1).cast("long").alias("one"),
    )
    placed = running_totals(sized, ("turn", "role", "text"), ("size", "system_size", "one"), by=("conv_id",), label="chat")
    placed = placed.select(
        "conv_id",
        "role",
        "text",
        "size",
        F.col("one_before").alias("rank"),
        F.col("size_before").alias("at"),
        F.expr(f"size_before div {STRETCH_WINDOWS * window_tokens}L").alias("stretch"),
        # what is left for new turns, but never less than an eighth of the window
        F.expr(f"greatest({window_tokens - history_tokens}L - system_size_total, {window_tokens}L div 8)").alias("room"),
    )
    starts = window_starts(placed, window_tokens)
    same_stretch = F.col("conv_id").eqNullSafe(F.col("s_conv")) & (F.col("stretch") == F.col("s_stretch"))
    owned = placed.join(starts, same_stretch).select(
        "conv_id",
        "role",
        "rank",
        fmt.alias("fmt"),
        F.length(head).alias("head_chars"),
        F.length(body).alias("body_chars"),
        F.expr("element_at(filter(starts, s -> s.rank <= rank), -1).rank").alias("own"),
        # later windows that begin so soon after this turn that it is part of their history
        F.expr(
            f"if(role = 'system', array(), transform(filter(concat(starts, following), s -> s.at > at and s.at <= at + {history_tokens}L), s -> s.rank))"
        ).alias("later"),
    )
    # kind 2: new there; kind 1: history of a later window
    uses = F.expr(
        "concat(array(struct(own as window, 2 as kind)), transform(later, w -> struct(w as window, 1 as kind)))"
    )
    parts = owned.select("*", F.explode(uses).alias("use")).select(
        "conv_id",
        "use.window",
        F.struct(
            "use.kind",
            "rank",
            "fmt",
            F.length("fmt").alias("chars"),
            "head_chars",
            "body_chars",
            ((F.col("use.kind") == 2) & (F.col("role") == "assistant")).alias("learned"),
        ).alias("part"),
    )
    windows = parts.groupBy("conv_id", "window").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    first_system = (
        owned.filter(F.col("role") == "system").groupBy(F.col("conv_id").alias("s_conv")).agg(F.min_by(F.struct("own", "fmt"), "rank").alias("s"))
    )
    joined = windows.join(first_system, F.col("conv_id").eqNullSafe(F.col("s_conv")), "left")
    lead = F.when(F.col("s.own") < F.col("window"), F.col("s.fmt")).otherwise(F.lit(""))
    return joined.withColumn("lead", lead).select(
        "conv_id",
        "window",
        F.expr("concat(lead, array_join(transform(parts, p -> p.fmt), ''))").alias("formatted"),
        F.expr(
            "length(lead) + aggregate(filter(parts, p -> p.kind = 1), 0, (n, p) -> n + p.chars)"
        ).alias("new_from"),
        F.expr(
            "aggregate(parts, named_struct('at', length(lead), 'spans', cast(array() as array<struct<first: int, chars: int>>)), "
            "(acc, p) -> named_struct('at', acc.at + p.chars, 'spans', if(p.learned, concat(acc.spans, "
            "array(named_struct('first', acc.at + p.head_chars, 'chars', p.body_chars))), acc.spans)), acc -> acc.spans)"
        ).alias("loss"),
    )


def read_back(windows: DataFrame) -> DataFrame:
    """Digests per conversation, from the formatted windows alone."""
    pieces = windows.select(
        "conv_id",
        F.struct(
            "window",
            F.expr("substring(formatted, new_from + 1)").alias("fresh"),
            F.expr("array_join(transform(loss, s -> substring(formatted, s.first + 1, s.chars)), '')").alias("learned"),
            F.length("formatted").cast("long").alias("chars"),
        ).alias("w"),
    )
    whole = pieces.groupBy("conv_id").agg(F.sort_array(F.collect_list("w")).alias("ws"))
    tail = r"r'<\|end\|>\n'"
    whole = whole.select(
        "conv_id",
        # what follows the last tail is empty
        F.expr(f"slice(split(array_join(transform(ws, w -> w.fresh), ''), {tail}, -1), 1, greatest(size(split(array_join(transform(ws, w -> w.fresh), ''), {tail}, -1)) - 1, 0))").alias("turns"),
        F.expr(unescape("array_join(transform(ws, w -> w.learned), '')")).alias("learned"),
        F.expr("aggregate(ws, 0L, (n, w) -> n + w.chars)").alias("formatted_chars"),
    )
    role = unescape("substring(substring_index(t, '|>\\n', 1), 3)")
    text = unescape("substring(t, length(substring_index(t, '|>\\n', 1)) + 4)")
    return whole.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.expr(f"array_join(transform(turns, t -> concat({role}, '\\n', {text}, '\\n')), '')"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op8_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.sql(
        f"select * from values (-1L, 0L, 'user', '{said}'), (-1L, 1L, 'assistant', '{said}') as t(conv_id, turn, role, text)"
    )
    return read_back(chat_windows(turns.unionByName(extra)))


OP8_SQL = r"""
WITH RECURSIVE turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), escaped AS (
  SELECT *,
    replace(replace(replace(replace(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), '|>', '|\>'),
      '</s>', '<\/s>'), '<s>', '<\s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]') AS e_role,
    replace(replace(replace(replace(replace(replace(replace(text, '\', '\\'), '<|', '<\|'), '|>', '|\>'),
      '</s>', '<\/s>'), '<s>', '<\s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]') AS e_text
  FROM turns
), sized AS (
  SELECT *, 13 + length(e_role) + length(e_text) AS chars, (13 + strlen(e_role) + strlen(e_text) + 3) // 4 AS tokens
  FROM escaped
), placed AS (
  SELECT *,
    coalesce(sum(tokens) OVER (PARTITION BY conv_id
      ORDER BY turn, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins,
    greatest(1024 - 192 - sum(CASE WHEN role = 'system' THEN tokens ELSE 0 END) OVER (PARTITION BY conv_id), 128) AS room,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS rank
  FROM sized
), dealt AS (
  SELECT conv_id, role, chars, tokens, begins, room, rank, begins // (16 * 1024) AS stretch FROM placed
), starts AS (
  SELECT conv_id, stretch, min(rank) AS rank, min(begins) AS begins,
    min(begins) + CASE WHEN stretch = 0 THEN 1024 ELSE min(room) END AS upto
  FROM dealt GROUP BY conv_id, stretch
  UNION ALL
  SELECT s.conv_id, s.stretch, min(d.rank), min(d.begins), min(d.begins) + min(d.room)
  FROM starts s JOIN dealt d
    ON d.conv_id = s.conv_id AND d.stretch = s.stretch AND d.rank > s.rank AND d.begins + d.tokens > s.upto
  GROUP BY s.conv_id, s.stretch
), owned AS (
  SELECT d.*, max(s.rank) OVER (PARTITION BY d.conv_id ORDER BY d.rank ROWS UNBOUNDED PRECEDING) AS own
  FROM dealt d LEFT JOIN starts s ON s.conv_id = d.conv_id AND s.rank = d.rank
), first_system AS (
  SELECT conv_id, arg_min(own, rank) AS own, arg_min(chars, rank) AS chars FROM owned WHERE role = 'system' GROUP BY conv_id
), written AS (
  SELECT conv_id, chars FROM owned
  UNION ALL
  SELECT o.conv_id, o.chars FROM owned o JOIN starts s
    ON s.conv_id = o.conv_id AND s.begins > o.begins AND s.begins <= o.begins + 192
  WHERE o.role <> 'system'
  UNION ALL
  SELECT f.conv_id, f.chars FROM first_system f JOIN starts s ON s.conv_id = f.conv_id AND s.rank > f.own
), formatted AS (
  SELECT conv_id, sum(chars) AS formatted_chars FROM written GROUP BY conv_id
)
SELECT t.conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  any_value(f.formatted_chars)::BIGINT AS formatted_chars
FROM turns t JOIN formatted f ON t.conv_id = f.conv_id
GROUP BY t.conv_id
"""
