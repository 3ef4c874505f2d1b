"""Replay of chat logs (user_id, event_id, ts, input): a session is a user, ordered by (ts, event_id)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialoom.functions.chatlog import (
    DEFAULT_SYSTEM_MESSAGE,
    DEFAULT_TEMPERATURE,
    clean_input,
    command_argument,
    command_kind,
    parse_temperature,
)
from dialoom.functions.text import extract_response
from dialoom.operators.ordered import Running, in_ranges, with_running
from dialoom.operators.prepare import keep_extracted

ORDER = ["ts", "event_id"]


def parse_log(log: DataFrame) -> DataFrame:
    """Each input cleaned and read as (kind, argument)."""
    cleaned = log.withColumn("line", clean_input(F.col("input")))
    return (
        cleaned.withColumn("kind", command_kind(F.col("line")))
        .withColumn("argument", command_argument(F.col("line")))
        .drop("input")
    )


def parse_answers(outputs: DataFrame, family: str | Column) -> DataFrame:
    """Raw model outputs (user_id, event_id, ts, output) as rows to put among those of `parse_log`.

    An answer has the event and the time of the message it answers and stands right behind it. Output that the
    family's pattern cannot read, or reads as empty, is left out: its message stays without an answer.
    """
    answers = outputs.select(
        "user_id",
        "event_id",
        "ts",
        extract_response(F.col("output"), family).alias("line"),
        F.lit("answer").alias("kind"),
        F.lit(None).cast("string").alias("argument"),
    )
    return keep_extracted(answers, "line")


def _one() -> Column:
    return F.lit(1).cast("bigint")


def _on(kind: str, value: Column) -> Column:
    return F.when(F.col("kind") == kind, value)


def _system() -> Column:
    return _on("system", F.col("argument"))


def _temperature() -> Column:
    return _on("temp", parse_temperature(F.col("argument")))


def _in_order(rows: DataFrame) -> DataFrame:
    """Rows in ranges of the order of sessions and times: a long session, or a burst in one, has several."""
    return in_ranges(rows, ["user_id", *ORDER])


def replayed(rows: DataFrame, *extra: Running) -> DataFrame:
    """Rows (`_in_order`) of the session up to its first exit, with `conversation`, counted up by each /new, and `extra`."""
    counted = [Running("_exits", "sum", _on("exit", _one())), Running("conversation", "sum", _on("new", _one())), *extra]
    running = with_running(rows, ["user_id"], F.col("_range"), ORDER, counted)
    return running.where((F.col("_exits") == 0) | ((F.col("_exits") == 1) & (F.col("kind") == "exit")))


def segment_log(parsed: DataFrame) -> DataFrame:
    """Conversation number of each row; rows after the first exit are gone."""
    return replayed(_in_order(parsed)).select("user_id", "event_id", "ts", "kind", "conversation")


def setting_as_of(parsed: DataFrame, kind: str, default=None) -> DataFrame:
    """The value of a setting in force at each message; it outlives /new."""
    if kind == "system":
        extra, name, fallback = Running("_system", "last", _system()), "system_message", DEFAULT_SYSTEM_MESSAGE
    elif kind == "temperature":
        extra, name, fallback = Running("_temperature", "last", _temperature()), "temperature", DEFAULT_TEMPERATURE
    else:
        raise ValueError(f"unknown setting: {kind}")
    value = F.coalesce(extra.name, F.lit(fallback if default is None else default))
    messages = replayed(_in_order(parsed), extra).where(F.col("kind") == "message")
    return messages.select("user_id", "event_id", "conversation", value.alias(name))


# --- whole replay ------------------------------------------------------------------------------------------
#
# A range is replayed by itself (`located`), its last row tells what it leaves behind (`closings`), and what all
# ranges of a session before it leave behind is where it starts (`openings`): one row for each session and range.
# The same three steps serve a whole log and the micro-batches of a stream.

LEFT = ["exits", "news", "system", "temperature", "said", "chars"]


def _place() -> list[Column]:
    return [F.col("ts"), F.col("event_id"), (F.col("kind") == "answer").alias("after")]


def located(ranged: DataFrame) -> DataFrame:
    """Rows (`_in_order`) up to the first exit of their range, with what the range tells of each row: exits, /new
    lines and settings so far, and the messages said and their characters since the last /new."""
    so_far = Window.partitionBy("user_id", "_range").orderBy(*_place()).rowsBetween(Window.unboundedPreceding, 0)
    said = F.col("kind").isin("message", "answer")
    role = F.when(F.col("kind") == "answer", "assistant").otherwise("user")
    settled = ranged.withColumn("role", role).select(
        "*",
        F.sum((F.col("kind") == "exit").cast("bigint")).over(so_far).alias("_exits"),
        F.sum((F.col("kind") == "new").cast("bigint")).over(so_far).alias("_news"),
        F.last(_system(), ignorenulls=True).over(so_far).alias("_system"),
        F.last(_temperature(), ignorenulls=True).over(so_far).alias("_temperature"),
    )
    live = settled.where((F.col("_exits") == 0) | ((F.col("_exits") == 1) & (F.col("kind") == "exit")))
    talk = Window.partitionBy("user_id", "_range", "_news").orderBy(*_place()).rowsBetween(Window.unboundedPreceding, 0)
    chars = F.length(F.concat("role", F.lit(">"), "line")).cast("bigint")
    return live.select(
        "*",
        F.sum(said.cast("bigint")).over(talk).alias("_said"),
        F.sum(F.when(said, chars).otherwise(0)).over(talk).alias("_chars"),
    )


def closings(rows: DataFrame, *keys: str) -> DataFrame:
    """What each range (of `located`) leaves behind: the values of its last row."""
    last = F.max_by(F.struct(*[F.col(f"_{c}").alias(c) for c in LEFT], "ts"), F.struct(*_place()))
    return rows.groupBy(*keys, "user_id", "_range").agg(last.alias("_last")).select(*keys, "user_id", "_range", "_last.*")


def openings(closed: DataFrame) -> DataFrame:
    """(user_id, _range, start): where each range starts, from what the session's ranges before it left behind."""
    session = Window.partitionBy("user_id").orderBy("_range")
    before = session.rowsBetween(Window.unboundedPreceding, -1)
    carried = closed.select(
        "*",
        F.coalesce(F.sum("news").over(before), F.lit(0)).cast("bigint").alias("conversation"),
        F.last("system", ignorenulls=True).over(before).alias("_system"),
        F.last("temperature", ignorenulls=True).over(before).alias("_temperature"),
        (F.coalesce(F.max("exits").over(before), F.lit(0)) > 0).alias("ended"),
    )
    left_open = Window.partitionBy("user_id", F.col("conversation") + F.col("news")).orderBy("_range")
    talk = left_open.rowsBetween(Window.unboundedPreceding, 0)
    summed = carried.select("*", F.sum("said").over(talk).alias("_m"), F.sum("chars").over(talk).alias("_c"))
    start = F.struct(
        "conversation",
        F.lag("_m", 1, 0).over(session).alias("messages"),
        F.lag("_c", 1, 0).over(session).alias("chars"),
        F.col("_system").alias("system"),
        F.col("_temperature").alias("temperature"),
        "ended",
    )
    return summed.select("user_id", "_range", start.alias("start"))


def settle(rows: DataFrame, starts: DataFrame, *keys: str) -> DataFrame:
    """Messages and answers of `located` rows with their conversation, their number in it, the settings in force
    and `prompt_chars`, the characters of the conversation up to and with them."""
    fresh = F.col("_news") > 0
    said = rows.where(F.col("kind").isin("message", "answer")).join(starts, [*keys, "user_id", "_range"])
    return said.where(~F.col("start.ended")).select(
        "user_id",
        "_range",
        (F.col("start.conversation") + F.col("_news")).alias("conversation"),
        (F.when(fresh, 0).otherwise(F.col("start.messages")) + F.col("_said") - 1).alias("message_no"),
        "event_id",
        "role",
        F.col("line").alias("text"),
        F.coalesce("_system", "start.system", F.lit(DEFAULT_SYSTEM_MESSAGE)).alias("system_message"),
        F.coalesce("_temperature", "start.temperature", F.lit(DEFAULT_TEMPERATURE)).alias("temperature"),
        (F.when(fresh, 0).otherwise(F.col("start.chars")) + F.col("_chars")).alias("prompt_chars"),
    )


def replay_turns(parsed: DataFrame) -> DataFrame:
    """Every message and answer of a parsed log, as `settle` gives them."""
    rows = located(_in_order(parsed))
    return settle(rows, openings(closings(rows)))


def replay(parsed: DataFrame) -> DataFrame:
    """Every message of the user with its conversation, its number in it and the settings in force."""
    turns = replay_turns(parsed).where(F.col("role") == "user")
    return turns.drop("_range", "role", "prompt_chars")
