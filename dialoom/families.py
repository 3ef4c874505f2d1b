"""Model families: their fixed settings and the chat templates derived from them."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Family(NamedTuple):
    name: str
    attn_implementation: str
    instruction_part: str
    response_part: str
    response_extraction_pattern: str


# Family settings as published for these model families.
FAMILIES = [
    Family(
        "phi-4",
        "eager",
        "<|im_start|>user<|im_sep|>",
        "<|im_start|>assistant<|im_sep|>",
        r".*<\|im_start\|>assistant<\|im_sep\|>([\s\S]*?)<\|im_end\|>$",
    ),
    Family(
        "llama-3.1",
        "sdpa",
        "<|start_header_id|>user<|end_header_id|>\n\n",
        "<|start_header_id|>assistant<|end_header_id|>\n\n",
        r".*<\|start_header_id\|>assistant<\|end_header_id\|>\n\n([\s\S]*?)<\|eot_id\|>$",
    ),
    Family(
        "mistral",
        "eager",
        "<|im_start|>user\n",
        "<|im_start|>assistant\n",
        r"\[/INST\]\s*([\s\S]*?)</s>$",
    ),
    Family(
        "qwen-2.5",
        "sdpa",
        "<|im_start|>user\n",
        "<|im_start|>assistant\n",
        r".*<\|im_start\|>assistant\n([\s\S]*?)<\|im_end\|>$",
    ),
    Family(
        "gemma-3",
        "eager",
        "<start_of_turn>user\n",
        "<start_of_turn>model\n",
        r".*<start_of_turn>model\n([\s\S]*?)$",
    ),
]

FAMILY_NAMES = [family.name for family in FAMILIES]


class Template(NamedTuple):
    """Text put around a turn of each role. `system_open` is None where the family has no system turn."""

    system_open: str | None
    user_open: str
    user_close: str
    assistant_open: str
    assistant_close: str


def _marked(name: str, close: str, has_system: bool = True) -> Template:
    family = next(f for f in FAMILIES if f.name == name)
    system = family.instruction_part.replace("user", "system") if has_system else None
    return Template(system, family.instruction_part, close, family.response_part, close)


# The templates are this library's own choice: the real ones ship with each model's tokenizer.
TEMPLATES = {
    "phi-4": _marked("phi-4", "<|im_end|>"),
    "llama-3.1": _marked("llama-3.1", "<|eot_id|>"),
    "mistral": Template(None, "[INST] ", "[/INST]", " ", "</s>"),
    "qwen-2.5": _marked("qwen-2.5", "<|im_end|>\n"),
    "gemma-3": _marked("gemma-3", "<end_of_turn>\n", has_system=False),
}


def by_family(family: str | Column, choose) -> Column:
    """`choose(name)` for a family given by name, or a CASE over all families for a family column."""
    if isinstance(family, str):
        if family not in TEMPLATES:
            raise ValueError(f"unsupported model family: {family}")
        return choose(family)
    case = None
    for name in FAMILY_NAMES:
        case = F.when(family == name, choose(name)) if case is None else case.when(family == name, choose(name))
    return case


def families_table(spark: SparkSession) -> DataFrame:
    """The five families as a dimension table."""
    return spark.createDataFrame(
        [tuple(f) for f in FAMILIES],
        "model_family string, attn_implementation string, instruction_part string, response_part string, "
        "response_extraction_pattern string",
    )
