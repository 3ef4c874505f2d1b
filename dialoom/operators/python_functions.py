"""Operators that run a caller's Python function, in Arrow batches."""

from __future__ import annotations

import hashlib
import pickle
import sys
from collections.abc import Callable, Iterator
from types import ModuleType

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Sent to the workers by value, so that they need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def with_tokens(
    df: DataFrame, tokenize: Callable[[list[str]], list[list[int]]] | None = None, text: str = "text"
) -> DataFrame:
    """Adds `tokens`: the caller's token ids, or the whitespace pieces, which stay on the JVM.

    `tokenize` gets a list of texts and returns a list of ids for each; null texts are kept from it.
    """
    if tokenize is None:
        return df.withColumn("tokens", F.regexp_extract_all(F.col(text), F.lit(r"\S+"), F.lit(0)))

    @F.pandas_udf("array<int>")
    def encode(texts: pd.Series) -> pd.Series:
        known = texts.notna()
        out = pd.Series([None] * len(texts), dtype=object)
        out[known.to_numpy()] = pd.Series(tokenize(texts[known].tolist()), dtype=object).to_numpy()
        return out

    return df.withColumn("tokens", encode(F.col(text)))


def token_offsets(offsets: Callable[[list[str]], list[list[tuple[int, int]]]]) -> Callable[[Column], Column]:
    """A column function with the (start, end) characters of the tokens of a text, by the caller's tokenizer.

    `offsets` gets a list of texts and returns a list of pairs for each; null texts are kept from it.
    """

    @F.pandas_udf("array<struct<start:int,end:int>>")
    def spans(texts: pd.Series) -> pd.Series:
        known = texts.notna()
        found = [[{"start": a, "end": b} for a, b in pairs] for pairs in offsets(texts[known].tolist())]
        out = pd.Series([None] * len(texts), dtype=object)
        out[known.to_numpy()] = pd.Series(found, dtype=object).to_numpy()
        return out

    return spans


def _kept(loader: bytes) -> Callable:
    """What the loader makes, kept in the worker process under the loader's own bytes."""
    models = sys.modules.setdefault("_dialoom_models", ModuleType("_dialoom_models")).__dict__
    key = hashlib.sha256(loader).hexdigest()
    if key not in models:
        models[key] = pickle.loads(loader)()
    return models[key]


def generate_responses(
    prompts: DataFrame, load: Callable[[], Callable], params: dict | None = None, batch_size: int = 64
) -> DataFrame:
    """Adds `response` by a model of the caller's.

    `load` returns `generate(list of prompts, params) -> list of responses`, which is called with at most
    `batch_size` prompts. A Python worker process loads a model once and keeps it for all its tasks.
    """
    settings = dict(params or {})
    loader = cloudpickle.dumps(load)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        generate = _kept(loader)
        for frame in frames:
            texts = frame["prompt"].tolist()
            answers: list[str] = []
            for at in range(0, len(texts), batch_size):
                answers.extend(generate(texts[at : at + batch_size], settings))
            yield frame.assign(response=answers)

    schema = T.StructType([*prompts.schema.fields, T.StructField("response", T.StringType())])
    return prompts.mapInPandas(run, schema)


def map_records(df: DataFrame, fn: Callable[[dict], dict], schema: T.StructType | str) -> DataFrame:
    """Every record replaced by what `fn` makes of it; only the columns of `schema` remain."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                yield pd.DataFrame([fn(record) for record in frame.to_dict("records")])

    return df.mapInPandas(run, schema)
