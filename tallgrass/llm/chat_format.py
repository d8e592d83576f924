"""Chat formatting that can be read back: grammar, escapes and the loss mask.

A formatted conversation is a run of turns::

    <|im_start|>ROLE\\nTEXT<|im_end|>\\n

The parser is deterministic: it cuts at each start string, takes the role up to the first
newline and the text up to the end string, which must close the turn.  Then it unescapes.
Content that the parser would read differently is escaped: a control string ``<|x|>`` inside a
role or a text gets one backslash after its first bar, one that already has some gets one more,
and a newline in a role becomes ``<|nl|>``.  Unescaping takes one backslash away.

Everything is DataFrame functions.  A turn is rendered, parsed and escaped in its own row; one
shuffle by conversation orders the turns and joins them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# fixed values: the control strings of the template
START, END, LINE = "<|im_start|>", "<|im_end|>", "<|nl|>"
_CONTROL = r"<\|(\\*)(im_start|im_end|nl)\|>"
_ESCAPED = r"<\|\\(\\*)(im_start|im_end|nl)\|>"


def escape(text: Column) -> Column:
    """One backslash more in every control string; the result holds no bare one."""
    return F.regexp_replace(text, _CONTROL, r"<|\\$1$2|>")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, r"<|$1$2|>")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit(LINE))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit(LINE), F.lit("\n")))


def render(role: Column, text: Column) -> Column:
    """One turn of the template."""
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END + "\n"))


def parse(formatted: Column) -> Column:
    """The turns of a formatted text as an array of (role, text); NULL if it breaks the grammar."""
    pieces = F.split(formatted, r"<\|im_start\|>")
    tail = END + "\n"

    def turn(piece: Column) -> Column:
        newline = F.instr(piece, "\n")
        role = F.left(piece, newline - 1)
        text = F.substr(piece, newline + 1, F.length(piece) - newline - len(tail))
        # the first end string is the one that closes the piece, and a newline ends the role before it
        closed = F.instr(piece, END) == F.length(piece) - len(tail) + 1
        sound = F.endswith(piece, F.lit(tail)) & closed & (newline > 0) & (newline <= F.length(piece) - len(tail))
        return F.when(sound, F.struct(unescape_role(role).alias("role"), unescape(text).alias("text")))

    turns = F.transform(F.slice(pieces, F.lit(2), F.size(pieces) - 1), turn)
    sound = (F.element_at(pieces, 1) == "") & ~F.exists(turns, lambda t: t.isNull())
    return F.when(sound, turns)


def format_turns(rows: DataFrame, learned: str = "assistant") -> DataFrame:
    """One row per turn: (conv_id, turn, role, text, piece, loss_start, loss_length).

    ``piece`` is the rendered turn.  It is parsed again; where the parser does not give back the
    role and the text, both are escaped, and the escaped piece is parsed and compared as well.
    ``loss_start`` and ``loss_length`` are the bytes of the text inside ``piece`` (UTF-8, from
    0), NULL for roles other than ``learned``.  NULL role or text: empty.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    plain = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    same = F.array(F.struct("role", "text"))

    def differs(piece: Column) -> Column:
        return ~F.coalesce(parse(piece) == same, F.lit(False))

    raw = plain.withColumn("_raw", render(F.col("role"), F.col("text")))
    shown = raw.withColumn("_escape", differs(F.col("_raw"))).select(
        "conv_id", "turn", "role", "text",
        F.when(F.col("_escape"), escape_role(F.col("role"))).otherwise(F.col("role")).alias("_role"),
        F.when(F.col("_escape"), escape(F.col("text"))).otherwise(F.col("text")).alias("_text"),
    )
    learns = F.col("role") == learned
    start = F.octet_length("_role") + len(START) + 1
    return shown.select(
        "conv_id", "turn", "role", "text", render(F.col("_role"), F.col("_text")).alias("piece"),
        F.when(learns, start.cast("long")).alias("loss_start"),
        F.when(learns, F.octet_length("_text").cast("long")).alias("loss_length"),
    )


def format_conversations(rows: DataFrame, learned: str = "assistant") -> DataFrame:
    """One row per conversation: (conv_id, formatted, spans).

    Turns go by ``turn`` (NULL first), then role and text; rows that repeat all three stay, as
    turns of their own.  ``spans`` holds (start, length) of every learned text inside
    ``formatted``, in bytes of UTF-8 from 0, in order.  Rows with a NULL conv_id are one
    conversation.  The whole text is parsed once more and must give back all roles and texts.
    No rows give no conversations.  Extra columns are left out.

    A formatted conversation is one value, so one conversation is put together in one task
    whatever its length; its turns are rendered and checked before, each in its own row.
    """
    turns = format_turns(rows, learned)
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    before = F.sum(F.octet_length("piece").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    placed = turns.select(
        "*", F.row_number().over(order).alias("_at"), F.coalesce(before, F.lit(0)).alias("_before")
    )
    entry = F.struct("_at", "role", "text", "piece", (F.col("_before") + F.col("loss_start")).alias("start"), "loss_length")
    whole = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(entry)).alias("_turns"))
    joined = whole.withColumn("formatted", F.array_join(F.transform("_turns", lambda t: t["piece"]), ""))
    source = F.transform("_turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    same = F.coalesce(parse(F.col("formatted")) == source, F.lit(False))
    learned_turns = F.filter("_turns", lambda t: t["start"].isNotNull())
    spans = F.transform(learned_turns, lambda t: F.struct(t["start"].alias("start"), t["loss_length"].alias("length")))
    wrong = F.raise_error(F.lit("a formatted conversation does not read back"))
    return joined.select("conv_id", F.when(same, F.col("formatted")).otherwise(wrong).alias("formatted"), spans.alias("spans"))


def learned_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, cut out of the formatted text by its spans and unescaped."""
    data = formatted.cast("binary")

    def cut(span: Column) -> Column:
        return unescape(F.substr(data, (span["start"] + 1).cast("int"), span["length"].cast("int")).cast("string"))

    return F.array_join(F.transform(spans, cut), "")
