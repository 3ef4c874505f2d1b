"""Composite jobs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialoom.functions.evaluation import eval_prompt
from dialoom.functions.text import conforms, extract_response, token_count
from dialoom.operators.ordered import Running, with_running, written
from dialoom.operators.packing import BATCH_SIZE, SEQUENCE_LIMIT, turn_shard
from dialoom.operators.prepare import keep_text, training_text
from dialoom.operators.python_functions import generate_responses
from dialoom.operators.replay import parse_answers, parse_log, replay_turns
from dialoom.operators.scoring import exact_match_mean, judge_runs, score
from dialoom.operators.turns import signed, turn_pairs
from dialoom.sources.files import write_prepared


def prepare_dataset(
    turns: DataFrame, family: str, root: str, config_name: str, eos: str | None = None, output_dir: str | None = None
) -> str:
    """Turn table to training text on disk; returns the folder."""
    text = keep_text(training_text(turn_pairs(turns), family, eos))
    return write_prepared(text, root, config_name, output_dir)


def dataset_metrics(
    pairs: DataFrame, family: str, block: int = SEQUENCE_LIMIT, limit: int = SEQUENCE_LIMIT, batch: int = BATCH_SIZE
) -> DataFrame:
    """One report (metric, value) over the pairs (conv_id, turn, user, assistant) of a dataset.

    One read and one wide step: texts are reduced to numbers before the shuffle by shard, where packing and
    batching share a window; batches, shards and the total are then added up in turn.
    """
    prepared = training_text(pairs, family)
    measured = prepared.select(
        "conv_id",
        "turn",
        turn_shard().alias("shard"),
        token_count(F.col("text")).alias("n"),
        conforms(F.col("assistant")).cast("bigint").alias("conforming"),
        extract_response(F.col("text"), family).isNotNull().cast("bigint").alias("read"),
    )
    in_order = Window.partitionBy("shard").orderBy("conv_id", "turn")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    placed = measured.withColumn("end_token", F.sum("n").over(so_far)).withColumn(
        "batch", F.floor((F.row_number().over(in_order) - 1) / batch)
    )
    last_block = F.floor((F.col("end_token") - 1) / block)
    first_block = F.floor((F.col("end_token") - F.col("n")) / block)
    batches = placed.groupBy("shard", "batch").agg(
        F.count("*").alias("samples"),
        F.sum("n").alias("tokens"),
        F.min("n").alias("shortest"),
        F.max("n").alias("longest"),
        F.count_if(F.col("n") > limit).alias("over"),
        F.sum(F.greatest(F.col("n") - limit, F.lit(0))).alias("lost"),
        F.sum("conforming").alias("conforming"),
        F.sum("read").alias("read"),
        F.count_if(last_block > first_block).alias("cut"),
        (F.max(last_block) + 1).alias("blocks"),
        (F.max("n") * F.count("*") - F.sum("n")).alias("waste"),
    )

    added = ["samples", "tokens", "over", "lost", "conforming", "read", "cut", "waste"]
    extremes = [F.min("shortest").alias("shortest"), F.max("longest").alias("longest")]
    shards = batches.groupBy("shard").agg(*[F.sum(c).alias(c) for c in added], *extremes, F.max("blocks").alias("blocks"))
    total = shards.agg(*[F.sum(c).alias(c) for c in [*added, "blocks"]], *extremes)

    def share(part: str, whole: Column = F.col("samples")) -> Column:
        return F.col(part) / whole

    lines = {
        "samples": F.col("samples"),
        "tokens": F.col("tokens"),
        "min_tokens": F.col("shortest"),
        "max_tokens": F.col("longest"),
        "mean_tokens": share("tokens"),
        "over_limit_share": share("over"),
        "tokens_lost": F.col("lost"),
        "tag_conformance": share("conforming"),
        "extraction_rate": share("read"),
        "packed_blocks": F.col("blocks"),
        "packed_fill_ratio": share("tokens", F.col("blocks") * block),
        "cut_sequences": F.col("cut"),
        "padding_waste": F.col("waste"),
    }
    report = [F.struct(F.lit(k).alias("metric"), v.cast("double").alias("value")) for k, v in lines.items()]
    return total.select(F.inline(F.array(*report)))


def response_metrics(responses: DataFrame) -> DataFrame:
    """One row for each family over raw responses (model_family, text): how many can be read, are empty and keep to
    the tags, and exact percentiles of the readable answers' tokens (the smallest length that so many do not pass).

    One read: rows are reduced to a count for each family and length before any shuffle, and the percentiles come
    from the running sum of those counts.
    """
    answer = extract_response(F.col("text"), F.col("model_family"))
    marked = responses.select("model_family", answer.alias("answer")).select(
        "model_family",
        F.when(F.col("answer") != "", token_count(F.col("answer"))).alias("n"),
        (F.col("answer") == "").cast("bigint").alias("empty"),
        conforms(F.col("answer")).cast("bigint").alias("conforming"),
    )
    lengths = marked.groupBy("model_family", "n").agg(
        F.count("*").alias("rows"), F.sum("empty").alias("empty"), F.sum("conforming").alias("conforming")
    )
    read = F.when(F.col("n").isNotNull(), F.col("rows")).otherwise(0)
    family = Window.partitionBy("model_family")
    so_far = family.orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    summed = lengths.select("*", read.alias("read"), F.sum(read).over(so_far).alias("_sum"), F.sum(read).over(family).alias("_all"))

    def percentile(share: float) -> Column:
        return F.min(F.when(F.col("_sum") >= F.ceil(F.col("_all") * share), F.col("n")))

    return summed.groupBy("model_family").agg(
        F.sum("rows").alias("responses"),
        (F.sum("read") / F.sum("rows")).alias("extraction_rate"),
        F.coalesce(F.sum("empty"), F.lit(0)).alias("empty"),
        F.coalesce(F.sum("conforming"), F.lit(0)).alias("conforming"),
        F.min("n").alias("min_tokens"),
        percentile(0.5).alias("median_tokens"),
        percentile(0.95).alias("p95_tokens"),
        F.max("n").alias("max_tokens"),
    )


def evaluate_runs(items: DataFrame, load: Callable[[], Callable], params: dict | None = None) -> DataFrame:
    """First item of each sample to a prompt, a response by the caller's model, then filters and mean match.

    Later repeats go before the model sees them.
    """
    keys = ["model", "variant", "task", "doc_id"]
    first = items.groupBy(*keys).agg(F.min_by(F.struct("question", "answer"), "repeat_no").alias("_first"))
    prompts = first.select(*keys, F.col("_first.answer").alias("answer"), eval_prompt(F.col("_first.question")).alias("prompt"))
    return exact_match_mean(score(generate_responses(prompts, load, params)), ["model", "variant", "task"])


def compare_all(samples: DataFrame) -> DataFrame:
    """Base against tuned by model and task: means, difference and flips.

    The samples' marks are shuffled once, to pair the runs; both comparisons are then one small aggregation.
    """
    base, tuned = F.col("base_right"), F.col("tuned_right")
    judged = judge_runs(score(samples))
    table = judged.groupBy("model", "task").agg(
        F.count("*").alias("docs"),
        (F.sum(base.cast("bigint")) / F.count("*")).alias("base"),
        (F.sum(tuned.cast("bigint")) / F.count("*")).alias("fine_tune"),
        F.count_if(base & tuned).alias("both_right"),
        F.count_if(base & ~tuned).alias("only_base"),
        F.count_if(~base & tuned).alias("only_tuned"),
        F.count_if(~base & ~tuned).alias("neither"),
    )
    return table.withColumn("difference", F.col("fine_tune") - F.col("base"))


def replay_log(log: DataFrame, outputs: DataFrame | None = None, family: str | Column = "qwen-2.5") -> DataFrame:
    """Each message of a log with the settings in force and its prompt in numbers, as `prompt_history` has them.

    `outputs` are the raw answers to messages (`parse_answers`); those that can be read are part of the prompts
    after them. A system message that is not empty stands before the messages and counts as one.
    """
    parsed = parse_log(log)
    if outputs is not None:
        parsed = parsed.unionByName(parse_answers(outputs, family))
    message = F.concat("role", F.lit(">"), "text")
    turns = replay_turns(parsed).withColumn("number", signed(F.col("message_no"), message)).drop("text")
    signature = Running("signature", "sum", F.col("number"))
    keys, order = ["user_id", "conversation"], ["message_no"]
    history = with_running(written(turns, "settled"), keys, F.col("_range"), order, [signature])
    led = F.col("system_message") != ""
    system_chars = F.length("system_message") + len("system>")
    return history.where(F.col("role") == "user").select(
        *keys,
        "message_no",
        "event_id",
        "system_message",
        "temperature",
        (F.col("message_no") + 1 + led.cast("bigint")).alias("n_messages"),
        (F.col("prompt_chars") + F.when(led, system_chars).otherwise(0)).alias("prompt_chars"),
        "signature",
    )
