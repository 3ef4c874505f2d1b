"""File sources and sinks, batch and streaming. Every read has an explicit schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from dialoom import schemas
from dialoom.operators.turns import explode_messages


def read_pairs(spark: SparkSession, path: str, extra_schema: T.StructType | None = None) -> DataFrame:
    """JSON lines with `user` and `assistant`, plus the fields of `extra_schema`. A bad line fails the read."""
    fields = [*schemas.PAIR.fields, *(extra_schema.fields if extra_schema else [])]
    return spark.read.schema(T.StructType(fields)).option("mode", "FAILFAST").json(path)


def read_turns(spark: SparkSession, path: str, layout: str = "turns") -> DataFrame:
    """The turn table, from Parquet turns or from JSON lines with one message list each.

    A list may be a part of a conversation if its messages have their turns; without turns it is numbered from 0.
    """
    if layout == "turns":
        return spark.read.schema(schemas.TURN).parquet(path)
    if layout == "messages":
        return explode_messages(spark.read.schema(schemas.MESSAGE_LIST).option("mode", "FAILFAST").json(path))
    raise ValueError(f"unknown layout: {layout}")


def write_prepared(
    df: DataFrame, root: str, config_name: str, output_dir: str | None = None, layout: str = "json"
) -> str:
    """Writes below `<root>/<config name>`, or to `output_dir`; returns the folder."""
    folder = output_dir or f"{root.rstrip('/')}/{config_name}"
    df.write.mode("overwrite").format(layout).save(folder)
    return folder


SAMPLE_LAYOUT = ["model", "variant", "task"]


def write_samples(samples: DataFrame, root: str) -> str:
    """Per-sample logs in one folder for each model, variant and task. Only the folders of the given samples are
    replaced, so that the logs of several runs stand side by side below one root."""
    samples.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*SAMPLE_LAYOUT).json(root)
    return root


def read_samples(spark: SparkSession, root: str) -> DataFrame:
    """Per-sample logs; a filter on model, variant or task opens only those folders."""
    return spark.read.schema(schemas.SAMPLE).option("mode", "FAILFAST").json(root)


def stream_turns(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    return _stream(spark, path, "parquet", schemas.TURN, files_per_batch)


def stream_pairs(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    return _stream(spark, path, "json", schemas.PAIR, files_per_batch)


def stream_chunks(
    spark: SparkSession, path: str, layout: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    return _stream(spark, path, layout, schemas.CHUNK, files_per_batch)


def _stream(spark, path: str, layout: str, schema: T.StructType, files_per_batch: int | None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.format(layout).load(path)


def stream_sink(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Appends a stream to Parquet and returns its query.

    Without a `trigger` what is available now is taken and waited for. With one, as `writeStream.trigger` takes
    it, such as {"processingTime": "10 seconds"}, the query stays up and is the caller's to stop.
    """
    query = (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    if trigger is None:
        query.awaitTermination()
    return query
