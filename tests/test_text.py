import random
import re

import pytest
from pyspark.sql import functions as F

from dialoom.families import FAMILIES, FAMILY_NAMES, TEMPLATES
from dialoom.functions import text as tx


def test_strip_is_pythons(column_values):
    blanks = [chr(c) for c in range(0x3100) if chr(c).isspace()]
    texts = ["", "  a b\n", "\x1f\x85x　", "".join(blanks), "​x​", *[b + "x" + b for b in blanks]]
    assert column_values(tx.strip, texts) == [t.strip() for t in texts]


def raw_outputs(family):
    t = TEMPLATES[family]
    user, answer = t.user_open + "Q" + t.user_close, t.assistant_open + " A1 \n" + t.assistant_close
    second = t.assistant_open + "A2\nline" + t.assistant_close
    return [
        user + answer,
        user + answer + user + second,
        user + answer + user + second + "\n",
        (user + answer).rstrip("\n") + "\n\n",
        (user + answer).rstrip("\n") + "\r",
        (user + answer).rstrip("\n") + " ",
        user + answer + "tail",
        user,
        "",
        "plain",
        t.assistant_open,
        t.assistant_open + t.assistant_close + t.assistant_close,
        user + t.assistant_open + "open",
        answer + user,
        t.assistant_close + t.assistant_open,
    ]


@pytest.mark.parametrize("family", FAMILY_NAMES)
def test_extraction_equals_the_pattern(column_values, family):
    pattern = re.compile(next(f for f in FAMILIES if f.name == family).response_extraction_pattern, re.DOTALL)
    texts = raw_outputs(family)
    random.seed(7)
    pieces = [*TEMPLATES[family][1:], "x", "\n", " ", "<"]
    texts += ["".join(random.choices(pieces, k=random.randint(1, 8))) for _ in range(300)]
    found = [pattern.search(t) for t in texts]
    expected = [m.group(1).strip() if m else None for m in found]
    assert column_values(lambda c: tx.extract_response(c, family), texts) == expected
    assert column_values(lambda c: tx.extract_by_pattern(c, pattern.pattern), texts) == expected


def test_clean_extraction(column_values):
    mistral = "[INST] a[/INST] one</s>[INST] b[/INST] two</s>"
    assert column_values(lambda c: tx.extract_response(c, "mistral"), [mistral]) == ["one</s>[INST] b[/INST] two"]
    assert column_values(lambda c: tx.extract_response(c, "mistral", clean=True), [mistral]) == ["two"]
    gemma = "<start_of_turn>model\none<end_of_turn>\n"
    assert column_values(lambda c: tx.extract_response(c, "gemma-3"), [gemma]) == ["one<end_of_turn>"]
    assert column_values(lambda c: tx.extract_response(c, "gemma-3", clean=True), [gemma]) == ["one"]


def test_pattern_and_family_may_be_columns(spark):
    rows = [(f.name, f.response_extraction_pattern, raw_outputs(f.name)[0]) for f in FAMILIES]
    df = spark.createDataFrame(rows, "family string, pattern string, raw string").select(
        tx.extract_response(F.col("raw"), F.col("family")).alias("a"),
        tx.extract_by_pattern(F.col("raw"), F.col("pattern")).alias("b"),
    )
    for row in df.collect():
        assert row.a == row.b and row.a.startswith("A1")


def test_rendering(spark):
    chat = [("system", "S"), ("user", "U1"), ("assistant", "A1"), ("user", "U2")]
    df = spark.createDataFrame([(chat,)], "m array<struct<role:string,content:string>>")

    def text(family, prompt=False):
        return df.select(tx.render_chat(F.col("m"), family, prompt)).first()[0]

    assert text("qwen-2.5", True) == (
        "<|im_start|>system\nS<|im_end|>\n<|im_start|>user\nU1<|im_end|>\n<|im_start|>assistant\nA1<|im_end|>\n"
        "<|im_start|>user\nU2<|im_end|>\n<|im_start|>assistant\n"
    )
    assert text("mistral") == "[INST] S\n\nU1[/INST] A1</s>[INST] U2[/INST]"
    assert text("gemma-3").startswith("<start_of_turn>user\nS\n\nU1<end_of_turn>\n<start_of_turn>model\nA1")
    assert text("phi-4").startswith("<|im_start|>system<|im_sep|>S<|im_end|><|im_start|>user<|im_sep|>U1")
    with pytest.raises(ValueError):
        text("unknown")


def test_rendering_turns_equals_rendering_messages(spark):
    from dialoom.operators import turns as tn

    rows = [(0, 0, "system", "S"), (0, 1, "user", "U"), (0, 2, "assistant", "A"), (1, 0, "assistant", "B"),
            (1, 1, "system", "T"), (1, 2, "user", "V"), (1, 3, "system", "X"), (2, 0, "system", "only")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    chats = tn.collect_chat(turns)
    for family in FAMILY_NAMES:
        by_turn = {r.conv_id: r.text for r in tn.render_conversations(turns, family).collect()}
        by_list = {r.conv_id: r.t for r in chats.select("conv_id", tx.render_chat(F.col("messages"), family).alias("t")).collect()}
        assert by_turn == by_list


def test_a_pair_is_rendered_like_its_chat(spark):
    df = spark.createDataFrame([("U", "A", name) for name in FAMILY_NAMES], "u string, a string, f string")
    user, assistant = F.col("u"), F.col("a")
    for family in [F.col("f"), *FAMILY_NAMES]:
        both = df.select(
            tx.render_pair(user, assistant, family).alias("pair"),
            tx.render_chat(tx.to_chat(user, assistant), family).alias("chat"),
        )
        assert all(row.pair == row.chat for row in both.collect())


def read_tags(text):
    """Left-to-right reading of the blocks, for comparison."""
    out = {"preamble": "", "reasoning": None, "output": None, "rest": ""}
    place, at = "preamble", 0
    while at < len(text):
        tag = next((t for t in ("reasoning", "output") if text.startswith(f"<{t}>", at)), None)
        if tag is None:
            out[place] += text[at]
            at += 1
            continue
        start = at + len(tag) + 2
        end = text.find(f"</{tag}>", start)
        body = text[start:] if end < 0 else text[start:end]
        if out[tag] is None:
            out[tag] = body
        at = len(text) if end < 0 else end + len(tag) + 3
        place = "rest"
    return tuple(out.values())


def test_split_tags(column_values):
    texts = [
        "", "plain", "<reasoning>r</reasoning><output>o</output>", "a<output>o</output>b<reasoning>r",
        "a<reasoning>r<output>x</output>y</reasoning>z", "<output></output>", "</output>x<output>y",
        "p<reasoning>1</reasoning>q<reasoning>2</reasoning>r",
    ]
    random.seed(3)
    pieces = ["<reasoning>", "</reasoning>", "<output>", "</output>", "a", "\n", "<"]
    texts += ["".join(random.choices(pieces, k=random.randint(1, 9))) for _ in range(300)]
    assert [tuple(v) for v in column_values(tx.split_tags, texts)] == [read_tags(t) for t in texts]


def test_conforms(column_values):
    good = ["<reasoning>a</reasoning><output>b</output>", " <reasoning>a\n</reasoning>\n<output></output>\n"]
    bad = ["", "<output>b</output>", "<output>b</output><reasoning>a</reasoning>", good[0] + "x", good[0] * 2,
           "<reasoning><output>a</reasoning><output>b</output>"]
    assert column_values(tx.conforms, good + bad) == [True] * len(good) + [False] * len(bad)


def test_eos(column_values):
    assert column_values(lambda c: tx.remove_eos(c, "</s>"), ["a</s>b</s>", "a"]) == ["ab", "a"]
    assert column_values(lambda c: tx.append_eos(c, "</s>"), ["a"]) == ["a</s>"]
    assert column_values(lambda c: tx.append_eos(c, "</s>", False), ["a"]) == ["a"]
