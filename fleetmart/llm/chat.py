"""Chat formatting with Spark expressions only: turns to one marked string, and back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Control strings of the template; inside texts each is written as ~ and a digit.
ESCAPES = [
    ("~", "~0"),
    ("</s>", "~1"),
    ("<s>", "~2"),
    ("[INST]", "~3"),
    ("[/INST]", "~4"),
    ("[SYS]", "~5"),
    ("[/SYS]", "~6"),
    ("[ROLE]", "~7"),
    ("[/ROLE]", "~8"),
    ("[AND]", "~9"),
    ("[TEXT]", "~a"),
]
# Opening and closing marks of a block, by role; any other role is written out.
MARKS = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("[SYS]", "[/SYS]")}
_OTHER = ("[ROLE]", "[/ROLE]")
_JOIN, _TEXT = "[AND]", "[TEXT]"
_CLOSED = r"(?<=\[/INST\]|</s>|\[/SYS\]|\[/ROLE\])"


def escape(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _by_role(role: Column, side: int, other: Column) -> Column:
    for name, marks in MARKS.items():
        other = F.when(role == name, F.lit(marks[side])).otherwise(other)
    return other


def _opening(role: Column) -> Column:
    return _by_role(role, 0, F.concat(F.lit(_OTHER[0]), escape(role), F.lit(_TEXT)))


def _closing(role: Column) -> Column:
    return _by_role(role, 1, F.lit(_OTHER[1]))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _merged(blocks: Column) -> Column:
    """Adjacent blocks of one role as one block.

    Blocks whose role differs from the one before are starts; what lies between two starts is
    sliced out, so each block is copied once.
    """

    def cut(all_: Column, starts: Column) -> Column:
        def one(start: Column, number: Column) -> Column:
            end = F.coalesce(F.get(starts, number + 1), F.size(all_) + 1)
            part = F.slice(all_, start, end - start)
            return F.struct(
                F.get(part, F.lit(0))["role"].alias("role"),
                F.flatten(F.transform(part, lambda block: block["texts"])).alias("texts"),
            )

        return F.transform(starts, one)

    def starts(all_: Column) -> Column:
        numbers = F.sequence(F.lit(1), F.size(all_))
        role = lambda number: F.get(all_, number)["role"]
        return F.filter(numbers, lambda n: (n == 1) | (role(n - 1) != role(n - 2)))

    return _let(blocks, lambda all_: _let(starts(all_), lambda found: cut(all_, found)))


_SPANS = "array<struct<block:int,start:int,chars:int>>"
_PIECE = 128


def _spans(texts: Column, number: Column) -> Column:
    """(block, start, chars) of each text of an assistant block, after its opening.

    Starts are added up over pieces of ``_PIECE`` texts, then inside each, since an array that
    grows by one element at a time is copied each time.
    """
    joint = F.lit(len(_JOIN))

    def base(pieces: Column) -> Column:
        chars = lambda piece: F.aggregate(
            piece, F.lit(0), lambda sum_, text: sum_ + F.char_length(text) + joint
        )
        return F.aggregate(
            pieces,
            F.array(F.lit(len(MARKS["assistant"][0]))),
            lambda done, piece: F.concat(
                done, F.array(F.get(done, F.size(done) - 1) + chars(piece))
            ),
        )

    def inside(piece: Column, start: Column) -> Column:
        return F.aggregate(
            piece,
            F.expr(f"cast(array() as {_SPANS})"),
            lambda done, text: F.concat(
                done,
                F.array(
                    F.struct(
                        number.cast("int").alias("block"),
                        F.when(F.size(done) == 0, start)
                        .otherwise(
                            F.get(done, F.size(done) - 1)["start"]
                            + F.get(done, F.size(done) - 1)["chars"]
                            + joint
                        )
                        .alias("start"),
                        F.char_length(text).alias("chars"),
                    )
                ),
            ),
        )

    cuts = F.sequence(F.lit(0), F.floor((F.size(texts) - 1) / _PIECE).cast("int"))
    pieces = F.transform(cuts, lambda cut: F.slice(texts, cut * _PIECE + 1, F.lit(_PIECE)))
    return _let(
        pieces,
        lambda parts: _let(
            base(parts),
            lambda starts: F.flatten(
                F.transform(parts, lambda piece, at: inside(piece, F.get(starts, at)))
            ),
        ),
    )


def format_conversations(turns: DataFrame, *, run: int = 256) -> DataFrame:
    """(conv_id, formatted, loss) for rows (conv_id, turn, role, text).

    Turns are sorted by turn, then role and text. Adjacent turns of one role share a
    block: their escaped texts, parted by a mark. ``loss`` is the loss mask: spans
    (block, start, chars) of ``formatted``, one for the escaped text of each assistant
    turn; block counts the blocks from 0, start the characters of that block from 0.

    Null texts and roles count as empty, null turns come first, rows of a null conv_id
    form one conversation, repeated rows are turns of their own, and an empty table gives
    no rows. Other columns are ignored.

    A conversation is collected in runs of ``run`` turn numbers, merged within each run,
    and its runs are joined afterwards, so that no task sorts a long conversation whole.
    """
    flat = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("part", F.coalesce(F.expr(f"turn div {run}"), F.lit(-(1 << 62))))
    runs = (
        flat.groupBy("conv_id", "part")
        .agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("rows"))
        .select(
            "conv_id",
            "part",
            _merged(
                F.transform(
                    "rows",
                    lambda row: F.struct(
                        row["role"].alias("role"), F.array(escape(row["text"])).alias("texts")
                    ),
                )
            ).alias("blocks"),
        )
    )
    whole = (
        runs.groupBy("conv_id")
        .agg(F.array_sort(F.collect_list(F.struct("part", "blocks"))).alias("runs"))
        .select(
            "conv_id",
            _merged(F.flatten(F.transform("runs", lambda part: part["blocks"]))).alias("blocks"),
        )
    )
    written = F.transform(
        "blocks",
        lambda block: F.concat(
            _opening(block["role"]),
            F.array_join(block["texts"], _JOIN),
            _closing(block["role"]),
        ),
    )
    loss = F.flatten(
        F.transform(
            "blocks",
            lambda block, number: F.when(
                block["role"] == "assistant", _spans(block["texts"], number)
            ).otherwise(F.expr(f"cast(array() as {_SPANS})")),
        )
    )
    return whole.select("conv_id", F.array_join(written, "").alias("formatted"), loss.alias("loss"))


def blocks_of(formatted: Column) -> Column:
    """The marked blocks of a formatted string, in order."""
    return F.filter(F.split(formatted, _CLOSED), lambda block: block != "")


def _turns_of(block: Column) -> Column:
    """Turns (role, text) of one block."""

    def parsed(role: Column, opening: int, closing: str) -> Column:
        inner = F.substring(
            block, F.lit(opening + 1), F.char_length(block) - opening - len(closing)
        )
        return F.transform(
            F.split(inner, r"\[AND\]"),
            lambda text: F.struct(role.alias("role"), unescape(text).alias("text")),
        )

    name = F.substring_index(block, _TEXT, 1)
    rest = F.substring(
        block,
        F.char_length(name) + len(_TEXT) + 1,
        F.char_length(block) - F.char_length(name) - len(_TEXT) - len(_OTHER[1]),
    )
    role = unescape(F.substring(name, F.lit(len(_OTHER[0]) + 1), F.char_length(name)))
    out = F.transform(
        F.split(rest, r"\[AND\]"),
        lambda text: F.struct(role.alias("role"), unescape(text).alias("text")),
    )
    for known, (opening, closing) in MARKS.items():
        out = F.when(
            block.startswith(opening), parsed(F.lit(known), len(opening), closing)
        ).otherwise(out)
    return out


def read_back(chats: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns, trained): what the formatted strings say.

    ``turns`` holds the (role, text) of every turn; ``trained`` the unescaped texts under
    the loss mask, in order.
    """
    split = chats.withColumn("_blocks", blocks_of(F.col("formatted")))
    return split.select(
        "conv_id",
        "formatted",
        F.flatten(F.transform("_blocks", _turns_of)).alias("turns"),
        F.transform(
            "loss",
            lambda span: unescape(
                F.substring(F.get("_blocks", span["block"]), span["start"] + 1, span["chars"])
            ),
        ).alias("trained"),
    )


def digest(chats: DataFrame) -> DataFrame:
    """Counts and digests of what ``read_back`` finds in each conversation."""
    back = read_back(chats)
    trained = F.array_join("trained", "")
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length(trained).cast("long").alias("loss_chars"),
        F.sha2(trained, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
