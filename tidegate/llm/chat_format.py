"""Chat formatting by grammar round trip, with built-in functions only.

A turn is ``OPEN text CLOSE`` and a line break, with one space on each side of the text.  A turn of a
role without marks of its own is ``[ROLE] role [/ROLE][AS] text [/AS]``.  A control string with a backslash
directly before it is content, and the backslash is not part of it; every other one is a mark.

Marks hold no white space and the template puts some on both sides of a text, so no mark can arise
where text and template meet, and no two marks overlap: what a turn parses to does not depend on its
neighbours.  One backslash before each control string of a text therefore always makes it parse to itself.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks of the known roles and of any other one.
MARKS = {
    "system": ("<<SYS>>", "<</SYS>>"),
    "user": ("[INST]", "[/INST]"),
    "assistant": ("<s>", "</s>"),
}
ROLE, AS = ("[ROLE]", "[/ROLE]"), ("[AS]", "[/AS]")
LOSS = "assistant"

_PAIRS = [*MARKS.values(), ROLE, AS]
CONTROL = "|".join(re.escape(mark) for pair in _PAIRS for mark in pair)
_MARK = rf"(?=[<\[])(?<!\\)({CONTROL})"


def escape(text: Column) -> Column:
    """A backslash before each control string."""
    return F.regexp_replace(text, f"({CONTROL})", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"\\({CONTROL})", "$1")


def render(role: Column, body: Column) -> Column:
    """One turn of the template."""
    def framed(marks: tuple[str, str], inside: Column) -> Column:
        return F.concat(F.lit(marks[0] + " "), inside, F.lit(" " + marks[1]))

    turn = F.concat(framed(ROLE, escape(role)), framed(AS, body))
    for name, marks in MARKS.items():
        turn = F.when(role == name, framed(marks, body)).otherwise(turn)
    return F.concat(turn, F.lit("\n"))


def parse(df: DataFrame, formatted: str, turns: str = "turns", pieces: str | None = None) -> DataFrame:
    """Add the turns, array of (role, text), that the grammar finds in the column ``formatted``.

    A text outside the grammar has null turns; the empty text has none.  ``pieces`` names a second new
    column: the text cut into (text, loss), where loss marks the assistants' texts, still escaped.
    Every step works through the text once.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    whole = F.col(f"`{formatted}`")
    cut = df.select(
        *columns,
        F.regexp_extract_all(whole, F.lit(_MARK), F.lit(1)).alias("_marks"),
        F.split(whole, _MARK, -1).alias("_parts"),
    )
    marks, parts = F.col("_marks"), F.col("_parts")
    n = F.floor(F.size(marks) / 2).cast("int")
    numbers = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    def pair(i: Column) -> Column:
        return F.struct(
            F.get(marks, 2 * i).alias("open"), F.get(marks, 2 * i + 1).alias("close"),
            F.get(marks, 2 * i - 1).alias("before"), F.get(marks, 2 * i + 2).alias("after"),
            F.get(parts, 2 * i).alias("lead"), F.get(parts, 2 * i + 1).alias("inside"),
            # A role stands in the pair before the text it belongs to.
            F.get(parts, 2 * i - 1).alias("role"),
        )

    paired = cut.select(*columns, marks, parts, F.transform(numbers, pair).alias("_pairs"))

    def text(inside: Column) -> Column:
        return inside.substr(F.lit(2), F.length(inside) - 2)

    def sound(p: Column) -> Column:
        closed = F.lit(False)
        for opening, closing in _PAIRS:
            closed = closed | ((p["open"] == opening) & (p["close"] == closing))
        spaced = (F.length(p["inside"]) >= 2) & p["inside"].startswith(" ") & p["inside"].endswith(" ")
        lead = F.when(p["before"].isNull() | (p["before"] == ROLE[1]), "").otherwise("\n")
        role_first = (p["open"] == AS[0]) == F.coalesce(p["before"] == ROLE[1], F.lit(False))
        text_next = (p["open"] != ROLE[0]) | F.coalesce(p["after"] == AS[0], F.lit(False))
        return closed & spaced & (p["lead"] == lead) & role_first & text_next

    def turn(p: Column) -> Column:
        role = unescape(text(p["role"]))
        for name, (opening, _) in MARKS.items():
            role = F.when(p["open"] == opening, name).otherwise(role)
        return F.struct(role.alias("role"), unescape(text(p["inside"])).alias("text"))

    pairs = F.col("_pairs")
    end = F.when(F.size(marks) == 0, "").otherwise("\n")
    last = F.get(parts, F.size(marks))
    good = (F.size(marks) % 2 == 0) & F.forall(pairs, sound) & (last == end)
    found = [F.when(good, F.transform(F.filter(pairs, lambda p: p["open"] != ROLE[0]), turn)).alias(turns)]
    if pieces is not None:
        def piece(value: Column, loss: Column) -> Column:
            return F.struct(value.alias("text"), loss.alias("loss"))

        cuts = F.flatten(F.transform(pairs, lambda p: F.array(
            piece(F.concat(p["lead"], p["open"], F.lit(" ")), F.lit(False)),
            piece(text(p["inside"]), p["open"] == MARKS[LOSS][0]),
            piece(F.concat(F.lit(" "), p["close"]), F.lit(False)),
        )))
        found.append(F.when(good, F.concat(cuts, F.array(piece(last, F.lit(False))))).alias(pieces))
    return paired.select(*columns, *found)


def format_chats(
    df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """One formatted text per conversation, which parses back to exactly its turns.

    Each turn is rendered as it is and parsed; only a turn that does not come back as it was has its
    control strings escaped.  The conversation is then parsed as a whole and compared with its
    source once more; a difference, which the grammar rules out, ends the query with an error.

    Turns are in the order of ``turn_col``, role and text, nulls first, so repeated turn numbers and repeated
    rows have a fixed place.  Null texts and roles are empty ones; rows with a null id are one conversation.
    An empty table has no conversations, other columns play no part.  Escaping and the first parse are
    done turn by turn; a conversation is one training example and so one row, of at most 2 GB.

    Returns id, n_turns, n_escaped (turns with an escape), formatted, and mask: runs (chars, loss) in code
    points whose lengths add up to the formatted text and whose loss runs are the assistants' texts, as escaped.
    """
    rows = df.select(
        F.col(f"`{id_col}`").alias("conv"), F.col(f"`{turn_col}`").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )
    tried = parse(rows.select("*", render(F.col("role"), F.col("text")).alias("plain")), "plain", "back")
    source = F.struct("role", "text")
    same = F.coalesce(F.col("back") == F.array(source), F.lit(False))
    judged = tried.select("conv", F.struct("turn", "role", "text", (~same).alias("escaped")).alias("row"))
    rendered = F.transform("rows", lambda r: render(r["role"], F.when(r["escaped"], escape(r["text"])).otherwise(r["text"])))
    grouped = judged.groupBy("conv").agg(F.sort_array(F.collect_list("row")).alias("rows")).select(
        "conv", "rows", F.array_join(rendered, "").alias("formatted"))
    parsed = parse(grouped, "formatted", "turns", "pieces")
    wanted = F.transform("rows", lambda r: F.struct(r["role"], r["text"]))
    checked = F.when(F.coalesce(F.col("turns") == wanted, F.lit(False)), F.col("formatted")).otherwise(
        F.raise_error(F.lit("a formatted conversation does not parse back to its turns")))
    return parsed.select(
        F.col("conv").alias(id_col),
        F.size("turns").cast("long").alias("n_turns"),
        F.size(F.filter("rows", lambda r: r["escaped"])).cast("long").alias("n_escaped"),
        checked.alias("formatted"),
        F.transform("pieces", lambda p: F.struct(F.length(p["text"]).alias("chars"), p["loss"].alias("loss"))).alias("mask"),
    )


def chat_digests(formatted: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """What the formatted texts say: turns and the text under the loss mask, both read back by the parser."""
    read = parse(formatted.select(id_col, "formatted"), "formatted", "turns", "pieces")
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join(F.transform(F.filter("pieces", lambda p: p["loss"]), lambda p: unescape(p["text"])), "")
    read = read.select("*", learned.alias("_loss"))
    return read.select(
        id_col,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spoken, 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
