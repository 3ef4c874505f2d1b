"""Scoring of responses and comparison of runs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.functions.evaluation import (
    FLEXIBLE,
    STRICT,
    best_choice,
    cut_at_stop,
    eval_target,
    flexible_answer,
    normalise_answer,
    strict_answer,
)
from dialoom.functions.text import conforms, extract_response

BASE, TUNED = "base", "fine_tune"


def union_runs(runs: list[tuple[str, str, DataFrame]]) -> DataFrame:
    """Runs stacked, each labelled with its model and variant."""
    labelled = [df.withColumn("model", F.lit(m)).withColumn("variant", F.lit(v)) for m, v, df in runs]
    return reduce(DataFrame.unionByName, labelled)


def take_first(samples: DataFrame, keys: list[str], order: str = "repeat_no", value: str = "response") -> DataFrame:
    """The first response of each sample, combined map-side."""
    return samples.groupBy(*keys).agg(F.min_by(value, order).alias(value))


def score(samples: DataFrame) -> DataFrame:
    """Adds the two filters' predictions and whether each matches the target."""
    predicted = (
        samples.withColumn("_cut", cut_at_stop(F.col("response")))
        .withColumn("strict_answer", strict_answer(F.col("_cut")))
        .withColumn("flexible_answer", flexible_answer(F.col("_cut")))
        .withColumn("_target", normalise_answer(eval_target(F.col("answer"))))
    )

    def right(prediction: str) -> Column:
        return F.coalesce(normalise_answer(F.col(prediction)) == F.col("_target"), F.lit(False))

    return (
        predicted.withColumn("strict_right", right("strict_answer"))
        .withColumn("flexible_right", right("flexible_answer"))
        .drop("_cut", "_target")
    )


def exact_match_mean(scored: DataFrame, by: list[str]) -> DataFrame:
    """Mean match per group and filter. Both filters are averaged in one aggregation and unfolded after it."""

    def mean(flag: str) -> Column:
        return F.sum(F.col(flag).cast("bigint")) / F.count("*")

    def line(name: str, value: str) -> Column:
        return F.struct(F.lit(name).alias("filter"), F.col("n"), F.col(value).alias("exact_match"))

    means = scored.groupBy(*by).agg(
        F.count("*").alias("n"), mean("strict_right").alias("_s"), mean("flexible_right").alias("_f")
    )
    return means.select(*by, F.inline(F.array(line(STRICT, "_s"), line(FLEXIBLE, "_f"))))


def pair_runs(samples: DataFrame) -> DataFrame:
    """First base and first tuned response of each model, task and document side by side.

    A full outer join of the two variants would shuffle the table twice; one conditional aggregation gives
    the same rows, nulls where a variant is missing, and combines repeats map-side.
    """
    keys = ["model", "task", "doc_id"]

    def first(variant: str) -> Column:
        return F.min_by("response", F.when(F.col("variant") == variant, F.col("repeat_no")))

    return samples.groupBy(*keys).agg(
        F.min_by("answer", "repeat_no").alias("answer"),
        first(BASE).alias("base_response"),
        first(TUNED).alias("tuned_response"),
    )


def compare_runs(scored: DataFrame, flag: str = "flexible_right") -> DataFrame:
    """Base and tuned mean match of each model and task, and their difference."""
    table = (
        scored.groupBy("model", "task")
        .pivot("variant", [BASE, TUNED])
        .agg(F.sum(F.col(flag).cast("bigint")) / F.count(flag))
    )
    return table.withColumn("difference", F.col(TUNED) - F.col(BASE))


def first_scores(scored: DataFrame, keys: list[str]) -> DataFrame:
    """Both filters' marks of the first response of each sample.

    Scoring before taking the first marks some repeats in vain, but only marks are shuffled, never texts.
    """
    return scored.groupBy(*keys).agg(
        *[F.min_by(mark, "repeat_no").alias(mark) for mark in ("strict_right", "flexible_right")]
    )


def judge_runs(scored: DataFrame, mark: str = "flexible_right") -> DataFrame:
    """First base and first tuned mark of each document, as (model, task, doc_id, base_right, tuned_right).

    `pair_runs` without the texts; a missing response is wrong.
    """

    def first(variant: str) -> Column:
        return F.coalesce(F.min_by(mark, F.when(F.col("variant") == variant, F.col("repeat_no"))), F.lit(False))

    return scored.groupBy("model", "task", "doc_id").agg(
        first(BASE).alias("base_right"), first(TUNED).alias("tuned_right")
    )


def flip_counts(judged: DataFrame) -> DataFrame:
    """Documents both runs got right, only one of them, or neither."""
    base, tuned = F.col("base_right"), F.col("tuned_right")
    return judged.groupBy("model", "task").agg(
        F.count_if(base & tuned).alias("both_right"),
        F.count_if(base & ~tuned).alias("only_base"),
        F.count_if(~base & tuned).alias("only_tuned"),
        F.count_if(~base & ~tuned).alias("neither"),
    )


def choice_accuracy(choices: DataFrame, scores: list[str], by: str = "subject") -> DataFrame:
    """Share of questions whose best-scored choice is the answer, by subject and over all questions."""
    right = best_choice(F.array(*scores)) == F.col("answer_idx")
    per_subject = choices.groupBy(by).agg(F.count("*").alias("n"), F.count_if(right).alias("_right"))
    overall = per_subject.agg(F.sum("n").alias("n"), F.sum("_right").alias("_right")).withColumn(by, F.lit("all"))
    return per_subject.unionByName(overall).select(by, "n", (F.col("_right") / F.col("n")).alias("accuracy"))


def tag_conformance(df: DataFrame, text: str = "text") -> DataFrame:
    """Share of texts with exactly one reasoning part followed by exactly one output part."""
    return df.agg(
        F.count("*").alias("n"),
        F.count_if(conforms(F.col(text))).alias("conforming"),
        (F.count_if(conforms(F.col(text))) / F.count("*")).alias("share"),
    )


def extraction_rate(raw: DataFrame, text: str = "text") -> DataFrame:
    """Share of raw outputs each family's pattern could read."""
    found = extract_response(F.col(text), F.col("model_family")).isNotNull()
    return raw.groupBy("model_family").agg(
        F.count("*").alias("n"), F.count_if(found).alias("read"), (F.count_if(found) / F.count("*")).alias("rate")
    )
