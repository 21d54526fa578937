r"""Chat formatting with a grammar round trip, by DataFrame functions only.

A conversation is rendered as turns ``### role: text</turn>\n``. The control strings are ``### ``, ``</turn>`` and the escape
character ``\``. Turns are first rendered as they are; the rendered turn is parsed again by a deterministic parser, and where the
result differs from the source, or the body holds a control string, the content is escaped, until it is identical. The escape breaks every
control string and is undone by the parser, so one step is enough; the conversation is then parsed as a whole and
``exact`` tells whether all its turns came back.

A conversation is one value, so the rows of one meet in one row, as they must; they are gathered in partial lists in the tasks
that read them first, so a task of the shuffle gets a row per conversation and task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


HEAD, END = "### ", "</turn>"
#: Control strings and what stands for them in an escaped text; the escape character is doubled before.
BROKEN = {END: r"<\s/turn>", HEAD: r"#\s## "}
TURN = "\n"


def _replace(text: Column, old: str, new: str) -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def escape(text: Column) -> Column:
    r"""No control string stands in the result: ``\`` is doubled, and each control string gets ``\s`` after its first character.
    Runs of ``\`` in an escaped text are even but for those marks, so ``unescape`` cannot mistake one for the other."""
    out = _replace(text, "\\", "\\\\")
    for control, broken in BROKEN.items():
        out = _replace(out, control, broken)
    return out


def unescape(body: Column) -> Column:
    out = body
    for control, broken in BROKEN.items():
        out = _replace(out, broken, control)
    return _replace(out, "\\\\", "\\")


def escape_role(role: Column) -> Column:
    """A role without control strings and without the colon and space that end it."""
    return _replace(escape(role), ": ", r":\s ")


def unescape_role(head: Column) -> Column:
    return unescape(_replace(head, r":\s ", ": "))


def _comes_back(text: Column, body: Column) -> Column:
    """Whether the parser makes ``text`` of ``body`` wherever it stands."""
    free = ~F.contains(body, F.lit(HEAD)) & ~F.contains(body, F.lit(END)) & ~F.startswith(F.reverse(body), F.lit(" ###"))
    return free & (unescape(body) == text)


def safe(text: Column, escaped) -> Column:
    return F.when(_comes_back(text, text), text).otherwise(escaped(text))


def render(turns: Column) -> Column:
    """Text of an array of (role, text)."""
    one = lambda t: F.concat(F.lit(HEAD), safe_role(t["role"]), F.lit(": "), safe(t["text"], escape), F.lit(END + TURN))
    return F.array_join(F.transform(turns, one), "")


def safe_role(role: Column) -> Column:
    fits = _comes_back(role, role) & ~F.contains(role, F.lit(": ")) & (unescape_role(role) == role)
    return F.when(fits, role).otherwise(escape_role(role))


def parse(formatted: Column) -> Column:
    """Array of (role, text, body) from a rendered conversation: turns end at the end mark, a role at the first colon and space."""
    pieces = F.split(formatted, r"\Q" + END + TURN + r"\E")
    turns = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        colon = F.instr(piece, ": ")
        body = F.substr(piece, colon + 2)
        return F.struct(unescape_role(F.substr(piece, F.lit(len(HEAD) + 1), colon - len(HEAD) - 1)).alias("role"), unescape(body).alias("text"), body.alias("body"))

    return F.transform(turns, turn)


def format_chats(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                 learn_role: str = "assistant") -> DataFrame:
    """(id, formatted, turns, spans, exact) per conversation. ``turns`` (role, text, body) and ``spans`` (start, length: code points of the bodies
    of ``learn_role``, from 0) are read back from ``formatted``; ``exact`` tells that turns equal the source.

    Turns come in the order of ``turn`` (null first), then role and text, so ties and repeated rows have an order. Null texts and roles
    are empty. Rows without id make one conversation. Other columns are not looked at. No rows give no rows."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turn = F.struct(F.col(turn_col).alias("turn"), empty(role_col).alias("role"), empty(text_col).alias("text"))
    chats = rows.select(F.col(id_col).alias("id"), turn.alias("t")).groupBy("id").agg(F.sort_array(F.collect_list("t")).alias("source"))
    chats = chats.withColumn("formatted", render(F.col("source"))).withColumn("turns", parse(F.col("formatted")))
    plain = lambda c: F.transform(F.col(c), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return chats.select("id", "formatted", "turns", _spans(F.col("turns"), learn_role).alias("spans"), (plain("source") == plain("turns")).alias("exact"))


def _spans(turns: Column, learn_role: str) -> Column:
    """Places of the bodies to learn from, by a running length over the turns."""
    size = lambda t: F.char_length(F.concat(F.lit(HEAD), safe_role(t["role"]), F.lit(": "), t["body"], F.lit(END + TURN)))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(state: Column, t: Column) -> Column:
        body = F.char_length(t["body"])
        span = F.struct((state["at"] + size(t) - len(END + TURN) - body).alias("start"), body.alias("length"))
        spans = F.when(t["role"] == learn_role, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((state["at"] + size(t)).alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, step)["spans"]
