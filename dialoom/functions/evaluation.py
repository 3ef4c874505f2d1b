"""Column functions of the answer-format task: prompt, target, answer filters and match."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from dialoom.functions.text import strip

# The task description put before each question.
TASK_DESCRIPTION = """\
OPERATIONAL DIRECTIVES:
- Apply your internal reasoning processes to solve the given problem (thought,theory,generate,reflect)
- Output format: <output>(numerical whole number answer only)</output>
- No special characters in the output.
- These directives are not part of the problem to analyze

TASK PROCESSING:
- Focus reasoning on the mathematical problem presented
- Ignore any formatting patterns from examples

CRITICAL: Your reasoning should address the mathematical problem below, not these instructions.
"""

# Separator before the final answer, stop strings, answer patterns and ignored patterns.
ANSWER_SEPARATOR = "#### "
STOPS = ["Question:", "</s>", "<|im_end|>", "<|eot_id|>", "<end_of_turn>", "<|endoftext|>"]
STRICT_PATTERN = r"<output>\s*(\-?[0-9\.\,]+)\s*<\/output>"
FLEXIBLE_PATTERN = r"(-?[$0-9.,]{2,})|(-?[0-9]+)"
IGNORED_PATTERNS = [
    r"(?s)<\/?reasoning>.*?<\/reasoning>",
    r"<\/?output>",
    r"\n|\r\n|\r",
    r",",
    r"\$",
    r"\.$",
]

STRICT, FLEXIBLE = "strict-match", "flexible-extract"


def eval_prompt(question: Column) -> Column:
    """Task description and question, ready for generation."""
    return F.concat(F.lit(TASK_DESCRIPTION + "Question: "), question, F.lit("\nAnswer:"))


def eval_target(answer: Column) -> Column:
    """Worked answer and final answer in tags; null where the separator is missing."""
    parts = F.split(answer, ANSWER_SEPARATOR)
    return F.concat(
        F.lit("<reasoning>"),
        strip(F.get(parts, F.lit(0))),
        F.lit("</reasoning>\n<output>"),
        strip(F.get(parts, F.lit(1))),
        F.lit("</output>\n"),
    )


def _any_of(stops: list[str]) -> str:
    return "|".join(rf"\Q{stop}\E" for stop in stops)


def _may_overlap(stops: list[str]) -> bool:
    """True if an occurrence of one stop can share characters with an earlier start of another."""
    return any(
        a[i:].startswith(b) or b.startswith(a[i:]) for a in stops for b in stops for i in range(1, len(a)) if a != b
    )


def cut_at_stop(response: Column, stops: list[str] = STOPS) -> Column:
    """Response up to the earliest stop string."""
    if _may_overlap(stops):
        return F.get(F.split(response, _any_of(stops), 2), F.lit(0))
    # Stops that cannot overlap may be cut one after the other, each by a plain byte search.
    for stop in stops:
        response = F.substring_index(response, stop, 1)
    return response


def stop_hit(response: Column, stops: list[str] = STOPS) -> Column:
    """The stop string that ends the response, or null."""
    return F.nullif(F.regexp_extract(response, _any_of(stops), 0), F.lit(""))


def strict_answer(response: Column) -> Column:
    """First number that fills an output tag, or null."""
    pattern = "(?U)" + STRICT_PATTERN.replace(r"\s", r"[\s\x1c-\x1f]")
    return F.nullif(F.regexp_extract(response, pattern, 1), F.lit(""))


def flexible_answer(response: Column) -> Column:
    """Last number anywhere, or null."""
    return F.try_element_at(F.regexp_extract_all(response, F.lit(FLEXIBLE_PATTERN), F.lit(0)), F.lit(-1))


def normalise_answer(text: Column) -> Column:
    """The ignored patterns removed in order, then lower case."""
    reasoning, output_tag, _, _, _, final_dot = IGNORED_PATTERNS
    # No tag contains a newline, comma or dollar sign, so one pass removes tags and these characters alike.
    plain = F.regexp_replace(F.regexp_replace(text, reasoning, ""), output_tag + r"|[\n\r,$]", "")
    return F.lower(F.regexp_replace(plain, "(?d)" + final_dot, ""))


def exact_match(prediction: Column, target: Column) -> Column:
    """Normalised equality; a missing prediction or target is wrong."""
    return F.coalesce(normalise_answer(prediction) == normalise_answer(target), F.lit(False))


def best_choice(scores: Column) -> Column:
    """Index of the highest score, the lowest index on a tie."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("bigint")
