"""Column functions over text: stripping, templates, extraction and tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dialoom.families import TEMPLATES, by_family

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Whitespace removed from both ends, as Python's str.strip() does."""
    return F.trim(text, F.lit(WHITESPACE))


def token_count(text: Column) -> Column:
    """Number of whitespace-separated pieces."""
    return F.regexp_count(text, F.lit(r"\S+")).cast("bigint")


def append_eos(text: Column, eos: str, flag: Column | bool = True) -> Column:
    """End token added where `flag` holds."""
    return F.when(flag if isinstance(flag, Column) else F.lit(flag), F.concat(text, F.lit(eos))).otherwise(text)


def remove_eos(text: Column, eos: str) -> Column:
    """Every occurrence of the end token removed."""
    return F.replace(text, F.lit(eos), F.lit(""))


def to_chat(user: Column, assistant: Column) -> Column:
    """A user/assistant pair as an array of two messages, user first."""

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return F.array(message("user", user), message("assistant", assistant))


# --- templates -------------------------------------------------------------------------------------------


def render_turn(role: Column, content: Column, family: str | Column) -> Column:
    """One turn with its family's markers. A system turn of a family without one is rendered as a user turn."""

    def one(name: str) -> Column:
        t = TEMPLATES[name]
        opening = (
            F.when(role == "assistant", F.lit(t.assistant_open))
            .when((role == "system"), F.lit(t.system_open or t.user_open))
            .otherwise(F.lit(t.user_open))
        )
        closing = (
            F.lit(t.user_close)
            if t.user_close == t.assistant_close
            else F.when(role == "assistant", F.lit(t.assistant_close)).otherwise(F.lit(t.user_close))
        )
        return F.concat(opening, content, closing)

    return by_family(family, one)


def generation_prompt(family: str | Column) -> Column:
    """The open assistant marker."""
    return by_family(family, lambda name: F.lit(TEMPLATES[name].assistant_open))


def folds_system(family: str | Column) -> Column:
    """True for families that put the system text in front of the first user text."""
    return by_family(family, lambda name: F.lit(TEMPLATES[name].system_open is None))


def fold_messages(messages: Column) -> Column:
    """First system message moved in front of the first user text; unchanged without both. Other fields stay."""

    def position(role: str) -> Column:
        return F.array_position(F.transform(messages, lambda m: m["role"]), F.lit(role))

    system_at, user_at = position("system"), position("user")
    prefix = F.concat(F.get(messages, (system_at - 1).cast("int"))["content"], F.lit("\n\n"))
    led = F.transform(
        messages,
        lambda m, i: m.withField(
            "content", F.when(i + 1 == user_at, F.concat(prefix, m["content"])).otherwise(m["content"])
        ),
    )
    folded = F.filter(led, lambda m, i: i + 1 != system_at)
    return F.when((system_at > 0) & (user_at > 0), folded).otherwise(messages)


def render_chat(messages: Column, family: str | Column, add_generation_prompt: bool = False) -> Column:
    """A list of messages as one text, optionally ending in the open assistant marker."""

    def one(name: str) -> Column:
        source = fold_messages(messages) if TEMPLATES[name].system_open is None else messages
        text = F.array_join(F.transform(source, lambda m: render_turn(m["role"], m["content"], name)), "")
        return F.concat(text, F.lit(TEMPLATES[name].assistant_open)) if add_generation_prompt else text

    return by_family(family, one)


def render_pair(user: Column, assistant: Column, family: str | Column) -> Column:
    """A user/assistant pair as one text: `render_chat` of `to_chat`, as a plain concatenation."""

    def one(name: str) -> Column:
        t = TEMPLATES[name]
        between = F.lit(t.user_close + t.assistant_open)
        return F.concat(F.lit(t.user_open), user, between, assistant, F.lit(t.assistant_close))

    return by_family(family, one)


# --- extraction ------------------------------------------------------------------------------------------


def _drop_final_newline(text: Column) -> Column:
    return F.when(F.endswith(text, F.lit("\n")), F.left(text, F.length(text) - 1)).otherwise(text)


def _between(raw: Column, after: Column, end: str) -> Column:
    body = _drop_final_newline(after)
    return F.when(F.endswith(body, F.lit(end)), strip(F.left(body, F.length(body) - len(end))))


def extract_response(raw: Column, family: str | Column, clean: bool = False) -> Column:
    """The assistant's answer out of raw model output; null where the family's pattern finds none.

    Says with string functions what the family's extraction pattern says, so that a long output without a
    match costs one pass instead of one pass per start position. One newline after the end marker is allowed.
    By pattern, mistral takes everything after the *first* closed instruction, and gemma keeps a final
    turn-end marker; with `clean` mistral takes the last block and gemma drops the marker.
    """

    def one(name: str) -> Column:
        t = TEMPLATES[name]
        if name == "mistral":
            marker = t.user_close
            if clean:
                after = F.substring_index(raw, marker, -1)
            else:
                after = F.substr(raw, F.locate(marker, raw) + len(marker))
            return F.when(F.contains(raw, F.lit(marker)), _between(raw, after, t.assistant_close))
        after = F.substring_index(raw, t.assistant_open, -1)
        if name == "gemma-3":
            answer = strip(after)
            if clean:
                end = t.assistant_close.strip()
                answer = F.when(
                    F.endswith(answer, F.lit(end)), strip(F.left(answer, F.length(answer) - len(end)))
                ).otherwise(answer)
            return F.when(F.contains(raw, F.lit(t.assistant_open)), answer)
        return F.when(F.contains(raw, F.lit(t.assistant_open)), _between(raw, after, t.assistant_close.strip()))

    return by_family(family, one)


def extract_by_pattern(raw: Column, pattern: str | Column) -> Column:
    """Group 1 of a caller's pattern, stripped; null without a match. `$` means what it means in Python."""
    p = F.concat(F.lit("(?sd)"), pattern if isinstance(pattern, Column) else F.lit(pattern))
    return F.when(F.regexp_like(raw, p), strip(F.call_function("regexp_extract", raw, p, F.lit(1))))


# --- tags ------------------------------------------------------------------------------------------------

TAG_BLOCK = r"(?s)<reasoning>.*?(?:</reasoning>|\z)|<output>.*?(?:</output>|\z)"
ANY_TAG = r"</?(?:reasoning|output)>"
CONFORMING = r"(?s)\A\s*<reasoning>.*</reasoning>\s*<output>.*</output>\s*\z"


def _first_block(blocks: Column, tag: str) -> Column:
    opening, closing = f"<{tag}>", f"</{tag}>"
    block = F.get(F.filter(blocks, lambda b: F.startswith(b, F.lit(opening))), F.lit(0))
    body = F.substr(block, F.lit(len(opening) + 1))
    return F.when(F.endswith(body, F.lit(closing)), F.left(body, F.length(body) - len(closing))).otherwise(body)


def split_tags(text: Column) -> Column:
    """Struct (preamble, reasoning, output, rest) of a tagged text.

    Blocks are read from left to right, so a tag inside an open block is part of its content. An unclosed
    block runs to the end. `reasoning` and `output` come from the first block of their kind and are null
    without one; `preamble` is the text before the first block, `rest` all text outside blocks after it.
    """
    blocks = F.regexp_extract_all(text, F.lit(TAG_BLOCK), F.lit(0))
    opening = F.regexp_instr(text, F.lit("<reasoning>|<output>"))
    preamble = F.when(opening > 0, F.left(text, opening - 1)).otherwise(text)
    rest = F.when(opening > 0, F.regexp_replace(F.substr(text, opening), TAG_BLOCK, "")).otherwise(F.lit(""))
    return F.struct(
        preamble.alias("preamble"),
        _first_block(blocks, "reasoning").alias("reasoning"),
        _first_block(blocks, "output").alias("output"),
        rest.alias("rest"),
    )


def conforms(text: Column) -> Column:
    """True for exactly one closed reasoning part followed by exactly one closed output part."""
    return F.rlike(text, F.lit(CONFORMING)) & (F.regexp_count(text, F.lit(ANY_TAG)) == 4)
