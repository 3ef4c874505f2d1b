"""Preparation operators: pairs to training text, settings lookups, splits."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.families import FAMILY_NAMES, families_table
from dialoom.functions.settings import setting_or
from dialoom.functions.text import append_eos, render_pair, to_chat
from dialoom.operators.ordered import written


def with_chat(pairs: DataFrame) -> DataFrame:
    """Adds `messages`, the pair as a message list."""
    return pairs.withColumn("messages", to_chat(F.col("user"), F.col("assistant")))


def keep_text(df: DataFrame) -> DataFrame:
    """Only the `text` column."""
    return df.select("text")


def training_text(pairs: DataFrame, family: str | Column, eos: str | None = None) -> DataFrame:
    """Pairs with their templated `text`; `eos` appends an end token."""
    text = render_pair(F.col("user"), F.col("assistant"), family)
    return pairs.withColumn("text", append_eos(text, eos) if eos else text)


def keep_extracted(df: DataFrame, column: str = "answer") -> DataFrame:
    """Rows whose extraction is neither null nor empty."""
    return df.where(F.col(column).isNotNull() & (F.col(column) != ""))


def with_family(configs: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    """Family settings added by key. The dimension is the fixed five-row table, hence the broadcast."""
    if dim is None:
        dim = F.broadcast(families_table(configs.sparkSession))
    return configs.join(dim, "model_family")


def with_override(configs: DataFrame, key: str = "attn_implementation") -> DataFrame:
    """The config's own value of `key` if present, null included, else the family's."""
    return configs.withColumn(key, setting_or(F.col("settings"), key, F.col(key)))


def family_rejects(configs: DataFrame) -> DataFrame:
    """Configs whose family is missing or unknown."""
    family = F.col("settings")["model_family"]
    return configs.where(family.isNull() | ~family.isin(FAMILY_NAMES))


def require_family(configs: DataFrame) -> DataFrame:
    """Adds `model_family`; a missing or unknown family fails the query."""
    family = F.col("settings")["model_family"]
    known = F.coalesce(family.isin(FAMILY_NAMES), F.lit(False))
    problem = F.raise_error(F.concat(F.lit("unsupported or missing model family: "), F.coalesce(family, F.lit("null"))))
    return configs.withColumn("model_family", F.when(known, family).otherwise(problem.cast("string")))


def per_config(pairs: DataFrame, configs: list[tuple[str, str]]) -> DataFrame:
    """Every pair once for each (config, family) of the caller's list, with its templated text.

    The list is part of the plan, so the rows fan out inside the scan stage: no join and no shuffle.
    """
    user, assistant = F.col("user"), F.col("assistant")
    renderings = F.array(
        *[
            F.struct(F.lit(name).alias("config"), render_pair(user, assistant, family).alias("text"))
            for name, family in configs
        ]
    )
    keys = [c for c in pairs.columns if c not in ("user", "assistant")]
    return pairs.select(*keys, F.inline(renderings))


CONFIGS_A_TASK = 10_000


def _formed(configs: DataFrame) -> DataFrame:
    """(config, _family, _ends) of the configs with a known family: all that their texts depend on."""
    ends = F.lower(setting_or(F.col("settings"), "format_with_eos_token", F.lit("false"))) == "true"
    return configs.select(
        "config",
        F.col("settings")["model_family"].alias("_family"),
        F.coalesce(ends, F.lit(False)).alias("_ends"),
    ).where(F.col("_family").isin(FAMILY_NAMES))


TEXT_CLASSES = {f"{family}{end}": (family, bool(end)) for family in FAMILY_NAMES for end in ("", "+end")}


def text_classes(configs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Configs by the texts they lead to: (config, class), a row for each config with a known family, and one config
    (config, settings) to stand for each class that occurs, named after it. TEXT_CLASSES has all there are.
    """
    family, ends = F.col("_family"), F.col("_ends")
    name = F.concat(family, F.when(ends, F.lit("+end")).otherwise(F.lit("")))
    formed = _formed(configs)
    settings = F.create_map(F.lit("model_family"), family, F.lit("format_with_eos_token"), ends.cast("string"))
    standing = formed.select("_family", "_ends").distinct().select(name.alias("config"), settings.alias("settings"))
    return formed.select("config", name.alias("class")), standing


def per_config_table(pairs: DataFrame, configs: DataFrame, end_tokens: dict[str, str]) -> DataFrame:
    """Every pair once for each config of a table (config, settings), with its templated text.

    The end token of the config's family is added where its settings ask for it. A text is rendered once for each
    family and form of end that some config has, at most two a family, and then meets the configs of that form.
    These are broadcast while there are few of them; more are dealt into blocks, so that no task meets them all.
    Configs without a known family have no texts.
    """
    named = _formed(configs)
    sizes = named.groupBy("_family", "_ends").count().collect()  # two rows for each family at most
    user, assistant = F.col("user"), F.col("assistant")

    def form(family: str, ends_: bool) -> Column:
        text = render_pair(user, assistant, family)
        text = append_eos(text, end_tokens[family]) if ends_ else text
        return F.struct(F.lit(family).alias("_family"), F.lit(ends_).alias("_ends"), text.alias("text"))

    keys = [c for c in pairs.columns if c not in ("user", "assistant")]
    if not sizes:
        return pairs.select(*keys, F.lit("").alias("config"), F.lit("").alias("text")).limit(0)
    rendered = pairs.select(*keys, F.inline(F.array(*[form(r["_family"], r["_ends"]) for r in sizes])))
    blocks = -(-max(r["count"] for r in sizes) // CONFIGS_A_TASK)
    if blocks == 1:
        met = rendered.join(F.broadcast(named), ["_family", "_ends"])
    else:
        dealt = named.withColumn("_block", F.pmod(F.xxhash64("config"), F.lit(blocks)).cast("int"))
        every = rendered.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        met = every.join(dealt, ["_family", "_ends", "_block"])
    return met.select(*keys, "config", "text")


HASH_BITS, HASH_STEP = 60, 12


def key_hash(key: Column, seed: str = "") -> Column:
    """A number of 60 bits for each key, the same in every run."""
    return F.conv(F.left(F.md5(F.concat(F.lit(seed), F.coalesce(key.cast("string"), F.lit("")))), F.lit(15)), 16, 10).cast("bigint")


def exact_split(df: DataFrame, key: str, share: float = 0.1, seed: str = "") -> DataFrame:
    """Adds `split` with exactly round(share * n) of the n distinct keys on the test side, halves rounded up.

    A key is on one side. The keys are those with the smallest hashes; the hash that bounds them is found by
    counting keys by ever finer ranges of hashes, 4096 counts at a time, and nothing is sorted.
    """
    keys = written(df.select(F.col(key).alias("_key")).distinct().withColumn("_hash", key_hash(F.col("_key"), seed)), "keys")
    left = math.floor(share * keys.count() + 0.5)
    if left <= 0:
        return df.withColumn("split", F.lit("train"))
    bound = 0
    for shift in range(HASH_BITS - HASH_STEP, -1, -HASH_STEP):
        inside = keys.where(F.shiftright("_hash", shift + HASH_STEP) == bound)
        counts = inside.groupBy(F.shiftright("_hash", shift).alias("range")).count().orderBy("range").collect()
        for row in counts:
            bound = row["range"]
            if left <= row["count"]:
                break
            left -= row["count"]
    last = keys.where(F.col("_hash") == bound).orderBy("_key").limit(left).agg(F.max("_key")).first()[0]
    hashed = key_hash(F.col(key), seed)
    test = (hashed < bound) | ((hashed == bound) & F.coalesce(F.col(key) <= F.lit(last), F.lit(True)))
    return df.withColumn("split", F.when(test, "test").otherwise("train"))


def holdout_split(df: DataFrame, key: Column, share: float = 0.1) -> DataFrame:
    """Adds `bucket` (0-999, from the key's hash) and `split`; the same key always lands on the same side."""
    bucket = F.conv(F.left(F.md5(key.cast("string")), F.lit(8)), 16, 10).cast("bigint") % 1000
    return df.withColumn("bucket", bucket).withColumn(
        "split", F.when(F.col("bucket") < round(share * 1000), "test").otherwise("train")
    )
