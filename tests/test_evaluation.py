import random
import re

from pyspark.sql import functions as F

from dialoom.functions import evaluation as ev


def texts():
    random.seed(11)
    pieces = ["<output>", "</output>", "<reasoning>", "</reasoning>", "12", "-3", "$", ",", ".", " ", "\n", "\r", "x",
              "Question:", "</s>", "<|im_end|>", "</output>\n", "#### ", "A"]
    return ["", *["".join(random.choices(pieces, k=random.randint(1, 10))) for _ in range(500)]]


def normal(text):
    for pattern in ev.IGNORED_PATTERNS:
        text = re.sub(pattern, "", text)
    return text.lower()


def flexible(text):
    found = [m.group(0) for m in re.finditer(ev.FLEXIBLE_PATTERN, text)]
    return found[-1] if found else None


def strict(text):
    found = re.findall(ev.STRICT_PATTERN, text)
    return found[0] if found else None


def cut(text):
    found = re.search("|".join(map(re.escape, ev.STOPS)), text)
    return (text[: found.start()], found.group()) if found else (text, None)


def test_filters_equal_python(column_values):
    rows = texts()
    assert column_values(ev.normalise_answer, rows) == [normal(t) for t in rows]
    assert column_values(ev.flexible_answer, rows) == [flexible(t) for t in rows]
    assert column_values(ev.strict_answer, rows) == [strict(t) for t in rows]
    assert column_values(ev.cut_at_stop, rows) == [cut(t)[0] for t in rows]
    assert column_values(ev.stop_hit, rows) == [cut(t)[1] for t in rows]


def test_overlapping_stops(column_values):
    stops = ["ab", "bc", "b"]
    rows = ["xabc", "xbc", "ab", "aab", "none"]
    assert column_values(lambda c: ev.cut_at_stop(c, stops), rows) == ["x", "x", "", "a", "none"]


def test_target(column_values):
    assert column_values(ev.eval_target, ["work #### 7 #### 8", "none"]) == [
        "<reasoning>work</reasoning>\n<output>7</output>\n", None
    ]


def test_exact_match(spark):
    rows = [("1,234", "a #### 1234"), ("$5.", "a #### 5"), ("5", "a #### 6"), (None, "a #### 5"), ("5", "no separator")]
    df = spark.createDataFrame(rows, "p string, a string")
    found = df.select(ev.exact_match(F.col("p"), ev.eval_target(F.col("a")))).collect()
    assert [r[0] for r in found] == [True, True, False, False, False]


def test_prompt(column_values):
    (prompt,) = column_values(ev.eval_prompt, ["1+1?"])
    assert prompt.startswith("OPERATIONAL DIRECTIVES:\n- Apply") and prompt.endswith("instructions.\nQuestion: 1+1?\nAnswer:")
    assert "\n  " not in prompt and "\n\nTASK PROCESSING:" in prompt


def test_best_choice_takes_the_first_of_equals(spark):
    df = spark.createDataFrame([([1, 3, 3],), ([2, 1, 0],)], "s array<int>")
    assert [r[0] for r in df.select(ev.best_choice(F.col("s"))).collect()] == [1, 0]
