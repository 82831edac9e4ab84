"""Chat formatting (6): prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it as
context, and only that reply's text trainable.  Turns after the last assistant
turn (or a conversation without one) close with one example whose loss span is
empty, so that no turn is lost.

Template: an assistant turn is ``<s>`` text ``</s>``; any other turn is
``[INST]`` role, line end, text ``[/INST]``.  Inside roles and texts a
backslash is doubled, a control string gets a backslash after its first
character, and a line end in a role becomes backslash n; :func:`parse_turns`
and :func:`unescape` undo that exactly.

The turns of one conversation are gathered (a conversation is one training
unit and its longest example holds it whole); an example is a prefix of the
conversation's rendering, so it costs a substring.  The examples of a
conversation of T turns hold O(T^2) text: that is the method's output.

Defined cases: a null text or role counts as empty; an empty table gives no
example; turns are ordered by turn, then role and text (so ties and repeated
rows are kept, in a fixed order), null turns first; rows of a null conv_id
form one conversation; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"
#: Fixed values of the template.
OPEN_REPLY, CLOSE_REPLY, OPEN_TURN, CLOSE_TURN = "<s>", "</s>", "[INST]", "[/INST]"

_CONTROL = r"([<\[])(?=/?s>|/?INST\])"
_ESCAPED = r"\\(\\)|([<\[])\\(?=/?s>|/?INST\])"
_TURN = r"(?s)<s>.*?</s>|\[INST\].*?\[/INST\]"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, _CONTROL, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2")


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def _unescape_role(role: Column) -> Column:
    # a lone backslash before n is a line end: mark it before the pairs are undone
    return unescape(F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n"))


def render(role: Column, text: Column) -> Column:
    """One turn in the template (escaped)."""
    return F.when(role == ASSISTANT, F.concat(F.lit(OPEN_REPLY), escape(text), F.lit(CLOSE_REPLY))) \
        .otherwise(F.concat(F.lit(OPEN_TURN), _escape_role(role), F.lit("\n"), escape(text),
                            F.lit(CLOSE_TURN)))


def examples(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
             role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, example (0, 1, ...), text, loss_start and loss_end (code point
    offsets of the trainable part, the reply's escaped text)."""
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rendered = turns.select(F.col(conv_col).alias("conv_id"), F.struct(
        F.col(turn_col).alias("turn"), role.alias("role"), text.alias("raw"),
        render(role, text).alias("text")).alias("t"))
    convs = rendered.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    pieces = convs.select(
        "conv_id", F.array_join(F.transform("turns", lambda t: t["text"]), "").alias("whole"),
        F.transform("turns", lambda t: F.char_length(t["text"]).cast("long")).alias("sizes"),
        F.transform("turns", lambda t: t["role"] == ASSISTANT).alias("replies"))
    ends = F.aggregate(
        "sizes", F.array().cast("array<bigint>"),
        lambda acc, n: F.concat(acc, F.array(F.coalesce(F.get(acc, F.size(acc) - 1),
                                                        F.lit(0).cast("long")) + n)))
    placed = pieces.select("conv_id", "whole", "replies", ends.alias("ends"))
    last = F.size("replies") - 1
    # turns that end an example: every reply, and the last turn
    cuts = F.filter(F.transform("replies", lambda r, i: F.when(r | (i == last), i)),
                    lambda i: i.isNotNull())
    out = placed.select("conv_id", "whole", "replies", "ends", F.posexplode(cuts).alias("example", "at"))
    end, reply = F.get("ends", "at"), F.get("replies", "at")
    start = F.coalesce(F.get("ends", F.col("at") - 1), F.lit(0).cast("long"))
    return out.select(
        "conv_id", F.col("example").cast("long").alias("example"),
        F.substring("whole", F.lit(1), end.cast("int")).alias("text"),
        F.when(reply, start + len(OPEN_REPLY)).otherwise(end).alias("loss_start"),
        F.when(reply, end - len(CLOSE_REPLY)).otherwise(end).alias("loss_end"))


def loss_text(text: Column, start: Column, end: Column) -> Column:
    """The text under the loss mask, unescaped."""
    return unescape(F.substring(text, (start + 1).cast("int"), (end - start).cast("int")))


def parse_turns(text: Column) -> Column:
    """array<struct<role, text>> read back from an example."""
    def one(piece):
        reply = piece.startswith(OPEN_REPLY)
        body = F.when(reply, F.substring(piece, F.lit(len(OPEN_REPLY) + 1), F.char_length(piece)
                                         - len(OPEN_REPLY) - len(CLOSE_REPLY))) \
            .otherwise(F.substring(piece, F.lit(len(OPEN_TURN) + 1), F.char_length(piece)
                                   - len(OPEN_TURN) - len(CLOSE_TURN)))
        line = F.instr(body, "\n")
        return F.struct(
            F.when(reply, F.lit(ASSISTANT)).otherwise(
                _unescape_role(F.substring(body, F.lit(1), line - 1))).alias("role"),
            unescape(F.when(reply, body).otherwise(
                F.substring(body, line + 1, F.char_length(body)))).alias("text"))

    return F.transform(F.regexp_extract_all(text, F.lit(_TURN), F.lit(0)), one)
