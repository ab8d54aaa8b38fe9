"""Chat formatting by prefix-target expansion.

A conversation is written out once with a template that marks its turns:

    <|im_start|>role\\n text <|im_end|>\\n

Every assistant turn becomes an example of its own: all that stands before
its text is the context, and only that text is trainable. The examples of a
conversation share its formatted text as prefixes, so it is stored once, with
two numbers per example (where its target starts, how long it is).
``training_examples`` writes context and target of each example as a row of
its own. Contexts grow with the square of a conversation's turns, so a row is
made, used and left before the next one; they are neither shuffled nor
gathered by ``read_back``, which keeps a length and a digest of each.

Control strings inside texts are escaped reversibly: a backslash becomes
``\\b`` and ``<|`` becomes ``<\\p`` (in roles a line break becomes ``\\n``
too). Each escape starts with a backslash and no other backslash remains, so
replacing the escapes in the opposite order restores the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Template (fixed values).
START, END, TRAINED_ROLE = "<|im_start|>", "<|im_end|>\n", "assistant"


def _replace(text: Column, *pairs: tuple[str, str]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def escape_text(text: Column) -> Column:
    return _replace(text, ("\\", "\\b"), ("<|", "<\\p"))


def unescape_text(text: Column) -> Column:
    return _replace(text, ("<\\p", "<|"), ("\\b", "\\"))


def escape_role(role: Column) -> Column:
    return _replace(escape_text(role), ("\n", "\\n"))


def unescape_role(role: Column) -> Column:
    return unescape_text(_replace(role, ("\\n", "\n")))


def format_conversations(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``formatted`` and ``examples``: for every assistant turn
    in order ``turn_start`` and ``target_start`` (code points before the turn
    and before its text) and ``target_chars``.

    Null roles and texts are empty. Turns stand by ``turn`` (null first),
    ties by role and text; repeated rows are turns of their own. A null
    conv_id is a conversation like any other. One conversation is one text
    and so one row. Other columns are not read. An empty table gives no rows."""
    written = turns.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    written = written.select(
        "conv_id", "turn", "role", "text", head.alias("head"), escape_text(F.col("text")).alias("body")
    ).withColumn("chars", F.length("head") + F.length("body") + len(END))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = written.select(
        "conv_id",
        F.row_number().over(order).alias("pos"),
        F.concat("head", "body", F.lit(END)).alias("piece"),
        (F.col("role") == TRAINED_ROLE).alias("trained"),
        (F.sum(F.col("chars").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("chars")).alias("turn_start"),
        F.length("head").alias("head_chars"),
        F.length("body").cast("long").alias("target_chars"),
    )
    in_order = placed.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("pos", "piece", "trained", "turn_start", "head_chars", "target_chars"))).alias("turns")
    )

    def span(turn: Column) -> Column:
        start = turn["turn_start"]
        return F.struct(start.alias("turn_start"), (start + turn["head_chars"]).alias("target_start"), turn["target_chars"].alias("target_chars"))

    return in_order.select(
        "conv_id",
        F.array_join(F.col("turns.piece"), "").alias("formatted"),
        F.transform(F.filter("turns", lambda t: t["trained"]), span).alias("examples"),
    )


def written_turns(formatted: Column) -> Column:
    """The turns of a formatted text as they stand there, without the end marks."""
    pieces = F.split(formatted, END.replace("|", "\\|"))
    return F.slice(pieces, 1, F.size(pieces) - 1)  # nothing follows the last end


def expand(formatted: DataFrame, *keep: Column | str) -> DataFrame:
    """One row per example: ``conv_id``, ``keep``, ``example`` (from 0),
    ``context`` (all that precedes the reply) and ``target``, both as they
    stand in the formatted text. A conversation without assistant turns has
    one row with null example, context and target.

    The text is cut into its turns once per conversation, and each example
    takes its target out of its own turn."""
    trained = F.filter(written_turns(F.col("formatted")), lambda p: F.startswith(p, F.lit(f"{START}{TRAINED_ROLE}\n")))
    cut = F.zip_with(
        trained,
        "examples",
        lambda p, e: F.struct(
            e["target_start"].alias("target_start"),
            F.substring(p, (e["target_start"] - e["turn_start"]).cast("int") + 1, e["target_chars"].cast("int")).alias("target"),
        ),
    )
    rows = formatted.select("conv_id", F.col("formatted").alias("__text"), *keep, F.posexplode_outer(cut).alias("example", "e"))
    context = F.substring("__text", F.lit(1), F.col("e.target_start").cast("int"))
    return rows.select("conv_id", *rows.columns[2:-2], "example", context.alias("context"), F.col("e.target").alias("target"))


def training_examples(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``example``, ``context`` (all that precedes the reply, as
    formatted) and ``target``: the examples with their contexts written out.
    Odd rows as in ``format_conversations``; a conversation without assistant
    turns has no example."""
    return expand(format_conversations(turns)).where(F.col("example").isNotNull())


def parse(formatted: Column) -> Column:
    """The turns of a formatted text: array of (role, text), unescaped."""

    def turn(piece: Column) -> Column:
        role = F.substring_index(F.substring(piece, F.lit(len(START) + 1), F.length(piece)), "\n", 1)
        text = F.substring(piece, F.length(role) + len(START) + 2, F.length(piece))
        return F.struct(unescape_role(role).alias("role"), unescape_text(text).alias("text"))

    return F.transform(written_turns(formatted), turn)


def read_back(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations and their examples say, read from
    them alone: ``conv_id``, ``n_turns``, ``turns_sha256``, ``loss_chars``,
    ``loss_sha256``, ``formatted_chars``, ``n_examples``, ``context_chars``
    (of all contexts) and ``contexts_sha256`` (of the contexts' SHA-256 in
    hex, one after the other).

    Every example is made with its whole context, which is reduced to its
    length and digest in the same task. An empty table gives no rows."""
    turns = formatted.select("*", parse(F.col("formatted")).alias("turns"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    examples = expand(
        turns,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    per_conversation = ["n_turns", "turns_sha256", "formatted_chars"]
    examples = examples.select(
        "conv_id", *per_conversation, "example", "target", F.length("context").alias("context_chars"), F.sha2("context", 256).alias("context_sha256")
    )
    in_order = F.sort_array(F.collect_list(F.when(F.col("example").isNotNull(), F.struct("example", "target", "context_sha256"))))
    by_conversation = examples.groupBy("conv_id").agg(
        *(F.first(c).alias(c) for c in per_conversation),
        F.coalesce(F.sum("context_chars"), F.lit(0)).alias("context_chars"),
        in_order.alias("examples"),
    )
    by_conversation = by_conversation.withColumn("loss", F.array_join(F.transform("examples", lambda e: unescape_text(e["target"])), ""))
    return by_conversation.select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
        F.size("examples").cast("long").alias("n_examples"),
        "context_chars",
        F.sha2(F.array_join(F.col("examples.context_sha256"), ""), 256).alias("contexts_sha256"),
    )


#: The formatter's result per conversation, from the turns alone.
ORACLE_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations
    UNION ALL
    SELECT -1, k, CASE k WHEN 0 THEN 'user' ELSE 'assistant' END, '<|im_end|><|im_start|>assistant ok' FROM range(2) AS two(k)
), formatted AS (
    SELECT *, '<|im_start|>' || replace(replace(replace(r, '\', '\b'), '<|', '<\p'), chr(10), '\n') || chr(10) AS head,
           replace(replace(t, '\', '\b'), '<|', '<\p') || '<|im_end|>' || chr(10) AS rest
    FROM turns
), contexts AS (
    SELECT *, coalesce(string_agg(head || rest, '') OVER (
        PARTITION BY conv_id ORDER BY turn, r, t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') || head AS context
    FROM formatted
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn, r, t)) AS turns_sha256,
       CAST(coalesce(sum(length(t)) FILTER (WHERE r = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(t, '' ORDER BY turn, r, t) FILTER (WHERE r = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(head) + length(rest)) AS BIGINT) AS formatted_chars,
       count(*) FILTER (WHERE r = 'assistant') AS n_examples,
       CAST(coalesce(sum(length(context)) FILTER (WHERE r = 'assistant'), 0) AS BIGINT) AS context_chars,
       sha256(coalesce(string_agg(sha256(context), '' ORDER BY turn, r, t) FILTER (WHERE r = 'assistant'), '')) AS contexts_sha256
FROM contexts GROUP BY conv_id
"""
