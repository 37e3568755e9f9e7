"""Chat formatting with a grammar round trip, in DataFrame functions only.

A turn is rendered as

    ### <role>/<level>: <text> </turn>\\n

and turns follow each other. The parser is deterministic: it cuts after every ` </turn>\\n`, takes
the head up to the first `: ` and the text up to the end mark; a text at level 0 may hold no control
string. Escaping has levels. At level 0 a text stands as it is; at level 1 its `\\`, `#` and `<` become
`\\b`, `\\h` and `\\l`, after which no control string is left. Every rendered turn is parsed again, and
where the turns found are not exactly the source turn, the next level is taken. Roles are always escaped, with `/` as `\\s`, `:` as
`\\c` and a line break as `\\n`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, END = "### ", " </turn>\n"
LEVELS = (0, 1)
CONTROL = ("###", "</turn>")

# Fixed values of this grammar; the backslash's own pair is first and is undone last.
_TEXT_PAIRS = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"))
_ROLE_PAIRS = (*_TEXT_PAIRS, ("/", "\\s"), (":", "\\c"), ("\n", "\\n"))


def escaped(text: Column, pairs: tuple[tuple[str, str], ...] = _TEXT_PAIRS) -> Column:
    for plain, code in pairs:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column, pairs: tuple[tuple[str, str], ...] = _TEXT_PAIRS) -> Column:
    for plain, code in reversed(pairs):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def rendered(role: Column, text: Column, level: int) -> Column:
    body = escaped(text) if level else text
    return F.concat(F.lit(HEAD), escaped(role, _ROLE_PAIRS), F.lit(f"/{level}: "), body, F.lit(END))


def parsed(output: Column) -> Column:
    """Array of (role, level, text) of the turns in an output; what is no turn is (null, null, piece)."""

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, ": ", 1)
        name = F.substring(head, len(HEAD) + 1, F.length(head))
        role, level = F.substring_index(name, "/", 1), F.substring_index(name, "/", -1)
        body = F.substring(piece, F.length(head) + 3, F.length(piece))
        sound = (F.substring(piece, 1, len(HEAD)) == HEAD) & (F.length(head) < F.length(piece)) & level.isin(*map(str, LEVELS))
        for control in CONTROL:
            sound &= ~F.contains(body, F.lit(control))
        return F.struct(
            F.when(sound, unescaped(role, _ROLE_PAIRS)).alias("role"),
            F.when(sound, level.cast("int")).alias("level"),
            F.when(sound & (level == "1"), unescaped(body)).when(sound, body).otherwise(piece).alias("text"),
        )

    pieces = F.split(output, END, -1)
    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), turn)


def _survives(output: Column, role: Column, text: Column) -> Column:
    """The output ends where a turn ends and holds just this turn."""
    turns = parsed(output)
    return (F.size(turns) == 1) & F.endswith(output, F.lit(END)) & turns[0]["role"].eqNullSafe(role) & (turns[0]["text"] == text)


def format_turns(turns: DataFrame) -> DataFrame:
    """Adds column formatted to rows (role, text); null roles and texts become empty."""
    turns = turns.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text")})
    choices = [rendered(F.col("role"), F.col("text"), level) for level in LEVELS]
    return turns.withColumn(
        "formatted", F.when(_survives(choices[0], F.col("role"), F.col("text")), choices[0]).otherwise(choices[1])
    )


def format_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, formatted: the rows (conv_id, turn, role, text) of each conversation, by turn.

    Null turns come first; rows of the same turn are ordered by role and text, and repeated rows stay.
    Null conv_ids are one conversation. Null roles and texts are empty. Other columns are ignored. The output of a
    conversation is one value, so its turns meet in one task.
    """
    rows = format_turns(turns.select("conv_id", "turn", "role", "text"))
    ordered = F.sort_array(F.collect_list(F.struct("turn", "role", "text", "formatted")))
    return rows.groupBy("conv_id").agg(F.array_join(ordered["formatted"], "").alias("formatted"))


def read_turns(formatted: DataFrame) -> DataFrame:
    """Adds column turns: (role, level, text) as read back from column formatted."""
    return formatted.withColumn("turns", parsed(F.col("formatted")))


def loss_text(turns: Column, role: str = "assistant") -> Column:
    """All text under the loss mask, which covers the texts of one role, unescaped, in order."""
    return F.array_join(F.filter(turns, lambda t: t["role"] == role)["text"], "")
