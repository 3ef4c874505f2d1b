"""Streaming jobs: the same column functions on streams, and keyed state where order matters."""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialoom.functions.chatlog import DEFAULT_SYSTEM_MESSAGE, DEFAULT_TEMPERATURE
from dialoom.operators.ordered import in_ranges
from dialoom.operators.prepare import keep_text, training_text
from dialoom.operators.replay import ORDER, closings, located, parse_answers, parse_log, settle
from dialoom.operators.scoring import exact_match_mean, score
from dialoom.operators.turns import assemble
from dialoom.session import exists, make_folder, publish
from dialoom.sources.files import stream_sink
from dialoom.streaming.state import AssembleReplies, ReplaySessions, TagSections, read_sections

# Sent to the workers by value, so that they need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def stream_prepare(pairs: DataFrame, family: str, eos: str | None = None) -> DataFrame:
    """Pairs to training text. Stateless."""
    return keep_text(training_text(pairs, family, eos))


REPLY = "rid string, response string"
PIECE = "rid string, piece_no bigint, section string, text string"
CHUNK = ["rid", "seq", "chunk", "is_last"]


def _by_reply(chunks: DataFrame, processor: type, result: str, ttl_ms: int | None, forget_after: str | None) -> DataFrame:
    mode, columns = "None" if ttl_ms is None else "ProcessingTime", CHUNK
    if forget_after:
        chunks, mode, columns = chunks.withWatermark("ts", forget_after), "EventTime", [*CHUNK, "ts"]
    state = processor(ttl_ms, bool(forget_after))
    return chunks.select(*columns).groupBy("rid").transformWithStateInPandas(state, result, "Append", mode)


def stream_assemble(chunks: DataFrame, ttl_ms: int | None = None, forget_after: str | None = None) -> DataFrame:
    """Chunks of each reply to its full text, emitted when the last missing chunk has come, in any order.

    What is kept of replies, told ones too, goes after `forget_after`, such as "1 hour", without a chunk by the
    chunks' own `ts`, when later chunks of others have come. `ttl_ms` does so by the clock instead, for streams
    that stay up: with it a batch runs at every trigger and an availableNow run never ends.
    """
    return _by_reply(chunks, AssembleReplies, REPLY, ttl_ms, forget_after)


def stream_tags(chunks: DataFrame, ttl_ms: int | None = None, forget_after: str | None = None) -> DataFrame:
    """Chunks of each reply to pieces (rid, piece_no, section, text); how it was cut makes no difference."""
    return _by_reply(chunks, TagSections, PIECE, ttl_ms, forget_after)


def _split_whole(chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chunks of the replies that are all there, and the other chunks."""
    ended = F.max(F.when(F.col("is_last"), F.col("seq"))).alias("last")
    marks = chunks.groupBy("rid").agg(F.count_distinct("seq").alias("n"), ended)
    whole = marks.where(F.col("n") > F.col("last")).select("rid")
    return chunks.join(whole, "rid", "left_semi"), chunks.join(whole, "rid", "left_anti")


def _tagged_pieces(replies: DataFrame) -> DataFrame:
    """Whole replies (rid, response) to pieces, in Arrow batches and without state."""

    @F.pandas_udf("array<struct<section string, text string>>")
    def cut(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: [{"section": s, "text": t} for s, t in read_sections("text", text, True)[0]])

    pieces = replies.select("rid", F.posexplode(cut("response")).alias("at", "piece"))
    return pieces.select("rid", F.col("at").cast("bigint").alias("piece_no"), "piece.section", "piece.text")


def stream_replies(
    chunks: DataFrame,
    folder: str,
    checkpoint: str,
    trigger: dict | None = None,
    tags: bool = False,
    forget_after: str | None = None,
):
    """Replies put together, or with `tags` cut into pieces, where only replies that a micro-batch leaves open meet
    keyed state, in two queries.

    The first joins the chunks of replies that are all there with the batch operators, into `<folder>/whole`, and
    passes the others on to the second, `stream_assemble` or `stream_tags`, which writes to `<folder>/joined`.
    `told_replies` reads both. Without a `trigger` the run ends with what is available; with one both queries are
    the caller's to stop. Both are returned.
    """
    spark = chunks.sparkSession
    columns = [*CHUNK, "ts"] if forget_after else CHUNK

    def join_whole(batch: DataFrame, batch_id: int) -> None:
        left = f"{folder}/open/batch={batch_id}"
        if exists(spark, left):  # the whole batch was done before its end was noted
            return
        whole, rest = _split_whole(batch.select(*columns))
        replies = assemble(whole, blanks=tags)
        told = _tagged_pieces(replies) if tags else replies
        told.write.mode("overwrite").parquet(f"{folder}/whole/batch={batch_id}")
        rest.write.mode("overwrite").parquet(f"{folder}/_open/batch={batch_id}")
        publish(spark, f"{folder}/_open/batch={batch_id}", left)

    joining = (
        chunks.writeStream.foreachBatch(join_whole)
        .option("checkpointLocation", f"{checkpoint}/whole")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    _finished(joining, trigger)
    make_folder(spark, f"{folder}/open")
    schema = T.StructType([chunks.schema[c] for c in columns])
    keyed = (stream_tags if tags else stream_assemble)(
        spark.readStream.schema(schema).parquet(f"{folder}/open"), forget_after=forget_after
    )
    return joining, stream_sink(keyed, f"{folder}/joined", f"{checkpoint}/open", trigger)


def told_replies(spark: SparkSession, folder: str, tags: bool = False) -> DataFrame:
    """The replies of `stream_replies` so far, or their pieces, each reply once: one that came whole, in whatever
    batch, is told as it came whole."""
    schema = PIECE if tags else REPLY
    whole = spark.read.schema(f"{schema}, batch bigint").parquet(f"{folder}/whole").drop("batch")
    whole = whole.dropDuplicates(["rid", "piece_no"] if tags else ["rid"])
    joined = spark.read.schema(schema).parquet(f"{folder}/joined")
    return whole.unionByName(joined.join(whole.select("rid"), "rid", "left_anti"))


def _finished(query, trigger: dict | None):
    if trigger is None:
        query.awaitTermination()
    return query


CLOSED = (
    "user_id bigint, range_no int, exits bigint, news bigint, system string, temperature double, said bigint, "
    "chars bigint, ts timestamp, batch bigint"
)
STARTS = (
    "user_id bigint, batch bigint, range_no int, conversation bigint, messages bigint, chars bigint, system string, "
    "temperature double, ended boolean"
)
SAID = ["user_id", "_range", "event_id", "kind", "role", "line", "_news", "_said", "_chars", "_system", "_temperature"]


def stream_replay(
    log: DataFrame,
    folder: str,
    checkpoint: str,
    trigger: dict | None = None,
    outputs: DataFrame | None = None,
    family: str | Column = "qwen-2.5",
    forget_after: str | None = None,
):
    """Live replay of a log, with the raw answers to its messages if there are any, in two queries.

    The first replays the ranges of each micro-batch by themselves, so that a busy session is several tasks, and
    writes what was said to `<folder>/said` and one row for each session and range to `<folder>/ranges`. The
    second keeps the sessions in keyed state, reads those rows only, and writes to `<folder>/starts` where each
    range starts. `replayed_messages` joins the two, `live_sessions` reads the state. A session's rows must
    follow the rows of earlier micro-batches, and an answer comes in the micro-batch of its message or later.

    A session without rows is not touched. With `forget_after`, such as "30 days", sessions without rows for that
    long in the log's own time are dropped, and rows that come later than that are not taken. Without a `trigger`
    the run ends with what is available; with one both queries are the caller's to stop. Both are returned.
    """
    spark = log.sparkSession
    parsed = parse_log(log)
    if outputs is not None:
        parsed = parsed.unionByName(parse_answers(outputs, family))

    def reduce_batch(batch: DataFrame, batch_id: int) -> None:
        ranges = f"{folder}/ranges/batch={batch_id}"
        if exists(spark, ranges):  # the whole batch was done before its end was noted
            return
        rows = located(in_ranges(batch, ["user_id", *ORDER]))
        said = rows.where(F.col("kind").isin("message", "answer")).select(*SAID)
        said.write.mode("overwrite").parquet(f"{folder}/said/batch={batch_id}")
        closings(rows).withColumnRenamed("_range", "range_no").write.mode("overwrite").parquet(f"{folder}/_ranges/batch={batch_id}")
        publish(spark, f"{folder}/_ranges/batch={batch_id}", ranges)

    reducing = (
        parsed.writeStream.foreachBatch(reduce_batch)
        .option("checkpointLocation", f"{checkpoint}/reduce")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    _finished(reducing, trigger)
    make_folder(spark, f"{folder}/ranges")
    closed = spark.readStream.schema(CLOSED).parquet(f"{folder}/ranges")
    if forget_after:
        closed = closed.withWatermark("ts", forget_after)
    starts = closed.groupBy("user_id").transformWithState(
        ReplaySessions(bool(forget_after)), STARTS, "Append", "EventTime" if forget_after else "None"
    )
    return reducing, stream_sink(starts, f"{folder}/starts", f"{checkpoint}/carry", trigger)


def replayed_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Messages and answers of a live replay so far, as `replay_turns` has them."""
    said = spark.read.parquet(f"{folder}/said")
    start = F.struct("conversation", "messages", "chars", "system", "temperature", "ended").alias("start")
    starts = spark.read.parquet(f"{folder}/starts").select("user_id", "batch", F.col("range_no").alias("_range"), start)
    return settle(said, starts, "batch")


def live_sessions(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The state of each session of a live replay, read from its state store: the open conversation, its messages
    so far and their characters, the settings in force and whether the session has ended."""
    state = spark.read.format("statestore").option("path", f"{checkpoint}/carry").option("stateVarName", "session")
    return state.load().select(
        "key.user_id",
        "value.conversation",
        "value.messages",
        "value.chars",
        F.coalesce("value.system", F.lit(DEFAULT_SYSTEM_MESSAGE)).alias("system_message"),
        F.coalesce("value.temperature", F.lit(DEFAULT_TEMPERATURE)).alias("temperature"),
        "value.ended",
    )


def live_history(spark: SparkSession, folder: str, checkpoint: str) -> DataFrame:
    """The messages of the open conversations (user_id, message_no, role, text): the history that state keeps as the
    ranges in which they were said."""
    state = spark.read.format("statestore").option("path", f"{checkpoint}/carry").option("stateVarName", "history")
    parts = state.option("flattenCollectionTypes", "true").load().select(
        "key.user_id", "list_element.batch", F.col("list_element.range_no").alias("_range"), "list_element.first", "list_element.news"
    )
    said = spark.read.parquet(f"{folder}/said").join(parts, ["user_id", "batch", "_range"])
    return said.where(F.col("_news") == F.col("news")).select(
        "user_id", (F.col("first") + F.col("_said") - 1).alias("message_no"), "role", F.col("line").alias("text")
    )


def stream_score(samples: DataFrame) -> DataFrame:
    """Running mean match of each model, variant, task and filter; a few rows, whatever the stream's length."""
    return exact_match_mean(score(samples), ["model", "variant", "task"])


def run_totals(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Writes the running totals after each micro-batch to `path`, replacing the previous ones."""

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    query = (
        df.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(keep)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    return _finished(query, trigger)
