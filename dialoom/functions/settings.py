"""Column functions over run settings held as MAP<STRING, STRING>."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dialoom.functions.chatlog import NUMBER
from dialoom.functions.text import strip

# Default run settings; None is an explicit null.
DEFAULT_SETTINGS = {
    "max_seq_length": "2048",
    "load_in_4bit": "true",
    "bnb_4bit_compute_dtype": "bfloat16",
    "bnb_4bit_quant_type": "nf4",
    "bnb_4bit_use_double_quant": "true",
    "device_map": "auto",
    "system_message": "You are a helpful assistant.",
    "lora_rank": "256",
    "lora_alpha": "256",
    "lora_dropout": "0.1",
    "target_modules": "q_proj,k_proj,v_proj,o_proj,gate_proj,up_proj,down_proj",
    "per_device_train_batch_size": "4",
    "per_device_eval_batch_size": "4",
    "gradient_accumulation_steps": "1",
    "warmup_ratio": "0.03",
    "num_train_epochs": "3",
    "learning_rate": "2e-4",
    "weight_decay": "0.001",
    "logging_steps": "1",
    "optimizer_type": "paged_adamw_32bit",
    "scheduler_type": "cosine",
    "test_size": "0.1",
    "format_with_eos_token": "false",
    "enable_packing": "true",
    "max_grad_norm": "0.3",
    "group_by_length": "false",
    "gradient_checkpointing": "true",
    "save_steps": "0",
    "temperature": "0.8",
    "min_p": None,
    "max_new_tokens": "2048",
}

# The settings turned from text to number.
FLOAT_SETTINGS = ["lora_dropout", "warmup_ratio", "learning_rate", "weight_decay", "test_size", "max_grad_norm"]


def default_settings() -> Column:
    """The defaults as a map column."""
    entries = []
    for key, value in DEFAULT_SETTINGS.items():
        entries += [F.lit(key), F.lit(value).cast("string")]
    return F.create_map(*entries)


def merge_config(defaults: Column, overrides: Column) -> Column:
    """Key-wise merge: a key present in `overrides` wins, also with a null value; unknown keys are kept."""
    kept = F.filter(F.map_entries(defaults), lambda entry: ~F.map_contains_key(overrides, entry["key"]))
    return F.map_from_entries(F.concat(kept, F.map_entries(overrides)))


def setting_or(settings: Column, key: str, fallback: Column) -> Column:
    """The value under `key` if the key is there, null included, else the fallback."""
    return F.when(F.map_contains_key(settings, key), settings[key]).otherwise(fallback)


def cast_config(settings: Column) -> Column:
    """Struct of the numeric settings as doubles. Text that is no number fails the query."""

    def number(key: str) -> Column:
        text = settings[key]
        value = F.when(F.rlike(strip(text), F.lit(NUMBER)), strip(text).try_cast("double"))
        bad = text.isNotNull() & value.isNull()
        return F.when(bad, F.raise_error(F.concat(F.lit(f"{key} is not a number: "), text))).otherwise(value)

    return F.struct(*[number(key).alias(key) for key in FLOAT_SETTINGS])


def config_label(settings: Column) -> Column:
    """The label if given, else the model name."""
    return setting_or(settings, "label", settings["model_name"])


def family_stub(family: Column) -> Column:
    """Runs of characters that are not part of a word as one underscore."""
    return F.regexp_replace(family, r"(?U)\W+", "_")


def config_base_name(path: Column) -> Column:
    """Last part of a path without its last extension."""
    name = F.regexp_extract(path, r"([^/]+)(?:/+\.?)*\z", 1)
    stem = F.regexp_extract(name, r"(?s)\A(.+)\.[^.]+\z", 1)
    return F.when(stem != "", stem).otherwise(name)


def tag_from_time(at: Column) -> Column:
    """Time tag as YYYY_MM_DD_HH_MM."""
    return F.date_format(at, "yyyy_MM_dd_HH_mm")


def versioned_name(path: Column, tag: Column | None = None, at: Column | None = None) -> Column:
    """`<base name>-<tag>`; an absent or empty tag becomes the time tag."""
    stamp = tag_from_time(F.current_timestamp() if at is None else at)
    chosen = stamp if tag is None else F.coalesce(F.nullif(tag, F.lit("")), stamp)
    return F.concat_ws("-", config_base_name(path), chosen)


def output_folder(root: str, path: Column, settings: Column) -> Column:
    """Where a run's files go: its own `output_dir`, else a folder named after its config."""
    return setting_or(settings, "output_dir", F.concat(F.lit(root.rstrip("/") + "/"), config_base_name(path)))
