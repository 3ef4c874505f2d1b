"""Operators over the turn table (conv_id, turn, role, text); (conv_id, turn) is its key."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialoom.families import TEMPLATES, by_family
from dialoom.functions.chatlog import DEFAULT_SYSTEM_MESSAGE
from dialoom.functions.text import folds_system, render_turn, strip
from dialoom.operators.ordered import Running, part_of, with_next, with_running, written


def drop_blank(df: DataFrame, column: str) -> DataFrame:
    """Rows whose text is not empty after stripping."""
    return df.where(strip(F.col(column)) != "")


def only_role(turns: DataFrame, role: str) -> DataFrame:
    return turns.where(F.col("role") == role)


def first_system(turns: DataFrame) -> DataFrame:
    """First system message of each conversation that has one."""
    return only_role(turns, "system").groupBy("conv_id").agg(F.min_by("text", "turn").alias("system_message"))


def missing_system(turns: DataFrame) -> DataFrame:
    """Conversations without a system turn, with their first turn number. One pass, combined map-side."""
    return (
        turns.groupBy("conv_id")
        .agg(F.min("turn").alias("first_turn"), F.bool_or(F.col("role") == "system").alias("_has"))
        .where(~F.col("_has"))
        .drop("_has")
    )


def ensure_system(turns: DataFrame, default: str | None = DEFAULT_SYSTEM_MESSAGE) -> DataFrame:
    """A system turn put in front of conversations without one; nothing is added for an empty default."""
    if not default:
        return turns
    added = missing_system(turns).select(
        "conv_id",
        (F.col("first_turn") - 1).alias("turn"),
        F.lit("system").alias("role"),
        F.lit(default).alias("text"),
    )
    return turns.unionByName(added)


def replace_system(turns: DataFrame, text: str) -> DataFrame:
    """The first system turn overwritten, or one added in front.

    Only system turns can be overwritten, so only they take part in the anti join; no other text is moved.
    """
    heads = turns.groupBy("conv_id").agg(
        F.min(F.when(F.col("role") == "system", F.col("turn"))).alias("_system"), F.min("turn").alias("_first")
    )
    new = heads.select(
        "conv_id",
        F.coalesce("_system", F.col("_first") - 1).alias("turn"),
        F.lit("system").alias("role"),
        F.lit(text.strip()).alias("text"),
    )
    other = turns.where(~F.col("role").eqNullSafe("system"))
    later = only_role(turns, "system").join(new.select("conv_id", "turn"), ["conv_id", "turn"], "left_anti")
    return other.unionByName(later).unionByName(new)


def turn_pairs(turns: DataFrame) -> DataFrame:
    """Each user turn directly followed by an assistant turn, as (conv_id, turn, user, assistant)."""
    following = with_next(turns.select("conv_id", "turn", "role", "text"), "conv_id", "turn", ["role", "text"])
    return following.where((F.col("role") == "user") & (F.col("next_role") == "assistant")).select(
        "conv_id", "turn", F.col("text").alias("user"), F.col("next_text").alias("assistant")
    )


def collect_chat(turns: DataFrame, size: int | None = None) -> DataFrame:
    """Message arrays as (conv_id, part, messages), each message with its turn.

    A part holds the turns of one range of turn numbers, at most `size`, so no row grows without bound. It is a
    layout to store and read back (`explode_messages`); all parts of a conversation together are its messages.
    """
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
    return (
        turns.groupBy("conv_id", part_of(F.col("turn"), size).alias("part"))
        .agg(ordered.alias("_m"))
        .select("conv_id", "part", F.col("_m").alias("messages"))
    )


def explode_messages(chats: DataFrame) -> DataFrame:
    """Message arrays (conv_id, messages) as a turn table. A message without a turn has its place in the list."""
    place = F.col("place").cast("bigint")
    numbered = "turn" in chats.schema["messages"].dataType.elementType.names
    return chats.select("conv_id", F.posexplode("messages").alias("place", "m")).select(
        "conv_id",
        (F.coalesce("m.turn", place) if numbered else place).alias("turn"),
        F.col("m.role").alias("role"),
        F.col("m.content").alias("text"),
    )


SIGNATURE_BASE = (1 << 31) - 1


def signed(turn: Column, message: Column) -> Column:
    """A number of a message and its turn, for sums that tell other messages and another order."""
    number = F.conv(F.left(F.md5(message), F.lit(7)), 16, 10).cast("bigint")
    return F.pmod((turn + 1) * number, F.lit(SIGNATURE_BASE))


def prompt_history(turns: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """For each user turn its prompt, all messages of the conversation up to it, in numbers.

    (conv_id, turn, the columns to `keep`, n_messages, prompt_chars, signature). The signature is the sum over
    the messages of the turn times a number made of role and text, so it tells other messages and another
    order. Linear in the input for a conversation of any length; `prompts_for` gives the messages themselves.
    """
    message = F.concat("role", F.lit(">"), "text")
    values = [
        Running("n_messages", "sum", F.lit(1).cast("bigint")),
        Running("prompt_chars", "sum", F.length(message).cast("bigint")),
        Running("signature", "sum", signed(F.col("turn"), message)),
    ]
    return (
        with_running(turns, ["conv_id"], part_of(F.col("turn")), ["turn"], values)
        .where(F.col("role") == "user")
        .select("conv_id", "turn", *keep, "n_messages", "prompt_chars", "signature")
    )


def prompts_for(turns: DataFrame, targets: DataFrame) -> DataFrame:
    """The complete prompt of each of `targets` (conv_id, turn), as (conv_id, turn, messages): every message up
    to and with that turn, however many. The result is as large as what is asked for."""
    asked = targets.select("conv_id", F.col("turn").alias("_asked")).distinct()
    message = F.struct("turn", "role", F.col("text").alias("content"))
    return (
        turns.join(asked, "conv_id")
        .where(F.col("turn") <= F.col("_asked"))
        .groupBy("conv_id", "_asked")
        .agg(F.array_sort(F.collect_list(message)).alias("messages"))
        .withColumnRenamed("_asked", "turn")
    )


def prompt_spans(turns: DataFrame, family: str | Column) -> DataFrame:
    """For each user turn where its prompt ends in the rendered conversation: the prompt as a pointer.

    Linear in the input for a conversation of any length.
    """
    return (
        _positions(turns, family)
        .where(F.col("role") == "user")
        .select("conv_id", "turn", "n_messages", F.col("end_pos").alias("prompt_chars"))
    )


def fold_system(turns: DataFrame, family: str | Column) -> DataFrame:
    """First system text moved in front of the first user text, for families without a system turn.

    A conversation without a user turn keeps its system turn.
    """
    return _folded(turns, family).drop("_part")


def _folded(turns: DataFrame, family: str | Column, column: str = "text") -> DataFrame:
    """`fold_system` with the `_part` of each turn, over the text or over its length as `chars`.

    The changes are joined on (conv_id, part), so that what follows on the same keys needs no further shuffle.
    """
    parted = turns.withColumn("_part", part_of(F.col("turn")))
    if isinstance(family, str) and TEMPLATES[family].system_open is not None:
        return parted
    is_system, is_user = F.col("role") == "system", F.col("role") == "user"
    heads = (
        turns.where(is_system | is_user)
        .select(
            "conv_id",
            F.when(is_system, F.col("turn")).alias("_at"),
            F.when(is_user, F.col("turn")).alias("_user_at"),
            F.when(is_system, F.col(column)).alias("_said"),
        )
        .groupBy("conv_id")
        .agg(F.min("_at").alias("_system"), F.min("_user_at").alias("_user"), F.min_by("_said", "_at").alias("_moved"))
        .where(F.col("_system").isNotNull() & F.col("_user").isNotNull())
    )
    touched = F.array_distinct(F.array(part_of(F.col("_system")), part_of(F.col("_user"))))
    changes = heads.select("conv_id", F.explode(touched).alias("_part"), "_system", "_user", "_moved")
    folds = folds_system(family)
    moved = F.coalesce(folds & (F.col("turn") == F.col("_system")), F.lit(False))
    led = folds & (F.col("turn") == F.col("_user"))
    gap = "\n\n"
    longer = (
        F.concat("_moved", F.lit(gap), column) if column == "text" else F.col("_moved") + len(gap) + F.col(column)
    )
    folded = F.when(led, longer).otherwise(F.col(column)).alias(column)
    joined = parted.join(changes, ["conv_id", "_part"], "left")
    return joined.where(~moved).select(*[folded if c == column else F.col(c) for c in parted.columns])


def render_turns(turns: DataFrame, family: str | Column) -> DataFrame:
    """Adds `rendered`, each turn's share of the conversation text, after folding."""
    return _rendered(turns, family).drop("_part")


def _rendered(turns: DataFrame, family: str | Column) -> DataFrame:
    return _folded(turns, family).withColumn("rendered", render_turn(F.col("role"), F.col("text"), family))


def _part_texts(turns: DataFrame, family: str | Column) -> DataFrame:
    pieces = F.array_sort(F.collect_list(F.struct("turn", "rendered")))
    text = F.array_join(F.transform(pieces, lambda p: p["rendered"]), "").alias("text")
    return _rendered(turns, family).groupBy("conv_id", "_part").agg(text)


def render_texts(turns: DataFrame, family: str | Column) -> DataFrame:
    """(conv_id, text): each conversation rendered as one text, without the places of its parts."""
    return whole_texts(_part_texts(turns, family).withColumnRenamed("_part", "part"))


def render_conversations(turns: DataFrame, family: str | Column) -> DataFrame:
    """Rendered text as (conv_id, part, start_pos, text): one row for each part of a conversation, with the place
    in the whole text at which it starts. `whole_texts` puts the parts together."""
    parts = _part_texts(turns, family)
    ends = _positions(turns, family).groupBy("conv_id", "_part").agg(F.max("end_pos").alias("_end"))
    start = F.col("_end") - F.length("text")
    return parts.join(ends, ["conv_id", "_part"]).select(
        "conv_id", F.col("_part").alias("part"), start.alias("start_pos"), "text"
    )


def whole_texts(parts: DataFrame) -> DataFrame:
    """(conv_id, text): the parts of each conversation put together."""
    in_order = F.array_sort(F.collect_list(F.struct("part", "text")))
    return parts.groupBy("conv_id").agg(F.array_join(F.transform(in_order, lambda p: p["text"]), "").alias("text"))


def _positions(turns: DataFrame, family: str | Column) -> DataFrame:
    """Every turn's `chars` with its end offset in the rendered conversation and the number of messages so far.

    Only lengths are shuffled, no texts.
    """
    lengths = turns.select("conv_id", "turn", "role", F.length("text").cast("bigint").alias("chars"))
    markers = F.length(render_turn(F.col("role"), F.lit(""), family))
    return with_running(
        _folded(lengths, family, "chars"),
        ["conv_id"],
        F.col("_part"),
        ["turn"],
        [
            Running("end_pos", "sum", F.col("chars") + markers),
            Running("n_messages", "sum", F.lit(1).cast("bigint")),
        ],
    )


def response_spans(turns: DataFrame, family: str | Column) -> DataFrame:
    """Character range [start_pos, end_pos) of each assistant answer in the rendered conversation."""
    answers = _positions(turns, family).where(F.col("role") == "assistant")
    closing = by_family(family, lambda name: F.lit(len(TEMPLATES[name].assistant_close)))
    end = (F.col("end_pos") - closing).cast("bigint")
    return answers.select("conv_id", "turn", (end - F.col("chars")).alias("start_pos"), end.alias("end_pos"))


def answer_tokens(
    turns: DataFrame, family: str | Column, offsets: Callable[[Column], Column] | None = None
) -> DataFrame:
    """Tokens first_token to last_token, both included, of each assistant answer among those of the rendered
    conversation: the part of a token sequence that counts for the loss.

    Each message is tokenised by itself, with its markers. `offsets` gives the (start, end) of a text's tokens, as
    `python_functions.token_offsets` does; without it tokens are the whitespace pieces. A token that reaches into
    the answer is one of its own. An answer without a token has a last token one below its first, a null text no
    tokens and a null range. Texts are reduced to three numbers, which are written once; only those are shuffled.
    """
    opening = by_family(family, lambda name: F.lit(len(TEMPLATES[name].assistant_open)))
    until = opening + F.length("text")
    rendered = _rendered(turns, family)
    if offsets is None:
        n = F.regexp_count("rendered", F.lit(r"\S+"))
        ahead = F.regexp_count(F.substring("rendered", F.lit(1), opening + 1), F.lit(r"\S+\s"))
        begun = F.regexp_count(F.substring("rendered", F.lit(1), until), F.lit(r"\S+"))
    else:
        rendered = rendered.withColumn("_spans", offsets(F.col("rendered")))
        n = F.when(F.col("rendered").isNotNull(), F.size("_spans"))
        ahead = F.size(F.filter("_spans", lambda s: s["end"] <= opening))
        begun = F.size(F.filter("_spans", lambda s: s["start"] < until))
    is_answer = F.col("role") == "assistant"
    inside = F.when(F.length("text") > 0, F.greatest(begun - ahead, F.lit(0))).otherwise(F.length("text"))
    counted = rendered.select(
        "conv_id",
        "turn",
        "_part",
        n.cast("bigint").alias("_n"),
        F.when(is_answer, F.when(F.col("text").isNotNull(), ahead)).cast("bigint").alias("_ahead"),
        F.when(is_answer, inside).cast("bigint").alias("_inside"),
        F.coalesce(is_answer, F.lit(False)).alias("_answer"),
    )
    total = Running("_end", "sum", F.col("_n"))
    placed = with_running(written(counted, "tokens"), ["conv_id"], F.col("_part"), ["turn"], [total]).where("_answer")
    first = F.col("_end") - F.col("_n") + F.col("_ahead")
    return placed.select("conv_id", "turn", first.alias("first_token"), (first + F.col("_inside") - 1).alias("last_token"))


def assemble(chunks: DataFrame, size: int | None = None, blanks: bool = False) -> DataFrame:
    """Chunks joined in order to one response per `rid`, null chunks left out, blank ones too unless `blanks` are
    asked for, repeated ones taken once.

    A reply of blank chunks alone is an empty text. Ranges of chunks are joined first and the few range texts after
    that, so a long reply is put together by several tasks and only its text, which is the result, meets in one row.
    """
    spoken = F.col("chunk").isNotNull() if blanks else strip(F.col("chunk")) != ""
    said = F.when(spoken, F.col("chunk")).otherwise("")
    ranges = (
        chunks.groupBy("rid", part_of(F.col("seq"), size).alias("_part"))
        .agg(F.array_sort(F.array_distinct(F.collect_list(F.struct("seq", said.alias("chunk"))))).alias("_c"))
        .select("rid", "_part", F.array_join(F.transform("_c", lambda c: c["chunk"]), "").alias("_text"))
    )
    return (
        ranges.groupBy("rid")
        .agg(F.array_sort(F.collect_list(F.struct("_part", "_text"))).alias("_r"))
        .select("rid", F.array_join(F.transform("_r", lambda r: r["_text"]), "").alias("response"))
    )
