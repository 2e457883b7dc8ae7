"""Event-sourced chat formatting, with DataFrame functions only.

A log holds events of conversations: ``conv_id``, ``seq`` (their order), ``turn`` (the
message they belong to), ``kind``, ``role``, ``text``. Kinds:

* ``message``: the whole text of a message; what the message held before is gone.
* ``delta``: a piece that is appended.
* ``edit``: a new whole text of the message.
* ``regenerate``: the message starts again from its ``text`` (mostly empty, deltas follow),
  and messages of later turns that came before this event are gone.

Any other kind, or null, counts as ``message``. Events of equal ``seq`` go by kind, role and
text. A message's role is the last one named in it.

Folding first works per message: only events from the last whole text on are kept. Then a
conversation's messages are put together; that group is as large as the formatted
conversation itself, which is one string and must fit into one row (2 GB).

Rendering: each message is ``<|im_start|>role``, a line feed, its text, ``<|im_end|>``, a
line feed. Control strings inside texts get a backslash after their first character (one
more if they have some already), and roles escape backslash and line feed, so reading back
restores every text. ``segments`` is the formatted text in order, each segment with its
``loss`` flag; the assistant's texts, without marks, are the loss.

Nulls and edges: a null text is empty, a null role is the empty role, a null ``conv_id`` is
a conversation of its own, events without ``turn`` or ``seq`` come first. A conversation
without events has no row. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the template.
START, END = "<|im_start|>", "<|im_end|>"
TRAINED = "assistant"
# Strings that mean something to this or a common other template.
_CONTROL = r"([<\[])(\\*)(\|im_start\|>|\|im_end\|>|/?s>|/?INST\])"
_ESCAPED = r"([<\[])\\(\\*)(\|im_start\|>|\|im_end\|>|/?s>|/?INST\])"
DELTA = 256


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def escape(text: str) -> str:
    """SQL: ``text`` with its control strings made harmless."""
    return f"regexp_replace({text}, {_literal(_CONTROL)}, {_literal(r'$1\\$2$3')})"


def unescape(text: str) -> str:
    return f"regexp_replace({text}, {_literal(_ESCAPED)}, '$1$2$3')"


def escape_role(role: str) -> str:
    return f"replace(replace({escape(role)}, '%', '%25'), '\\n', '%0A')"


def unescape_role(role: str) -> str:
    return unescape(f"replace(replace({role}, '%0A', '\\n'), '%25', '%')")


def log_of_turns(conversations: DataFrame, delta: int = DELTA) -> DataFrame:
    """The log of finished turns: the assistant's are streamed in deltas, others come whole.
    Rows with equal ``turn`` follow each other by role and text."""
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("at"),
        F.col("role").cast("string").alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    # Rows of one turn number are messages of their own; few share one, so they are ranked together.
    listed = rows.groupBy("conv_id", "at").agg(F.sort_array(F.collect_list(F.struct("role", "text"))).alias("m"))
    told = listed.selectExpr("conv_id", "at", "posexplode(m) AS (again, m)").selectExpr(
        "conv_id", "named_struct('at', at, 'again', again) AS turn", "m.role AS role", "m.text AS text"
    )
    pieces = (
        f"CASE WHEN role <=> '{TRAINED}' AND text <> '' "
        f"THEN regexp_extract_all(text, '(?s).{{1,{delta}}}', 0) ELSE array(text) END"
    )
    told = told.selectExpr("conv_id", "turn", "role", f"posexplode({pieces}) AS (piece, text)")
    return told.selectExpr(
        "conv_id",
        "named_struct('at', turn.at, 'again', turn.again, 'piece', piece) AS seq",
        "turn",
        f"CASE WHEN role <=> '{TRAINED}' THEN 'delta' ELSE 'message' END AS kind",
        "role",
        "text",
    )


def fold(log: DataFrame) -> DataFrame:
    """``conv_id`` and ``messages`` (role and text, in order of turn) after all events."""
    rows = log.selectExpr(
        "conv_id", "turn", "seq",
        "CASE WHEN kind IN ('delta', 'edit', 'regenerate') THEN kind ELSE 'message' END AS kind",
        "role", "coalesce(text, '') AS text",
    )
    events = F.sort_array(F.collect_list(F.struct("seq", "kind", "role", "text")))
    messages = rows.groupBy("conv_id", "turn").agg(events.alias("e"))
    whole = "array_max(transform(e, (x, i) -> CASE WHEN x.kind <> 'delta' THEN i ELSE 0 END))"
    messages = messages.selectExpr(
        "conv_id",
        "turn",
        f"slice(e, {whole} + 1, size(e)) AS live",
        "try_element_at(filter(e, x -> x.role IS NOT NULL).role, -1) AS role",
        "try_element_at(filter(e, x -> x.kind = 'regenerate').seq, -1) AS renewed",
    )
    # Events not after the last regeneration of an earlier turn are gone.
    earlier = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    messages = messages.withColumn("cut", F.max("renewed").over(earlier)).selectExpr(
        "conv_id",
        "turn",
        "coalesce(role, '') AS role",
        "CASE WHEN cut IS NULL THEN live ELSE filter(live, x -> x.seq > cut) END AS live",
    )
    told = messages.where("size(live) > 0").selectExpr("conv_id", "turn", "role", "array_join(live.text, '') AS text")
    whole_conversation = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    return told.groupBy("conv_id").agg(whole_conversation.alias("m")).selectExpr(
        "conv_id", "transform(m, x -> named_struct('role', x.role, 'text', x.text)) AS messages"
    )


def render(folded: DataFrame) -> DataFrame:
    """``conv_id``, ``formatted`` and ``segments`` (text and loss flag, in order)."""
    head = f"named_struct('text', concat('{START}', {escape_role('x.role')}, '\\n'), 'loss', false)"
    body = f"named_struct('text', {escape('x.text')}, 'loss', x.role = '{TRAINED}')"
    tail = f"named_struct('text', '{END}\\n', 'loss', false)"
    segments = f"flatten(transform(messages, x -> array({head}, {body}, {tail})))"
    rows = folded.selectExpr("conv_id", f"{segments} AS segments")
    return rows.selectExpr("conv_id", "array_join(segments.text, '') AS formatted", "segments")


def read_back(rendered: DataFrame) -> DataFrame:
    """``conv_id``, ``messages`` as parsed from ``formatted``, and ``loss_text`` from the mask."""
    turns = f"split(formatted, {_literal(r'<\|im_end\|>\n')})"
    start = len(START) + 1
    parsed = (
        f"transform(filter({turns}, x -> x <> ''), x -> named_struct("
        f"'role', {unescape_role(f"substring(x, {start}, locate('\\n', x) - {start})")}, "
        f"'text', {unescape("substring(x, locate('\\n', x) + 1)")}))"
    )
    loss = f"array_join(transform(filter(segments, x -> x.loss), x -> {unescape('x.text')}), '')"
    return rendered.selectExpr("conv_id", f"{parsed} AS messages", f"{loss} AS loss_text", "formatted")
