"""Operators on a table where one key holds most rows, against plain windows and plain Python."""

import os
import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from dialoom.families import TEMPLATES
from dialoom.operators import replay as rp
from dialoom.operators import turns as tn
from dialoom.operators import ordered as ordered_module
from dialoom.operators.ordered import Running, in_ranges, part_of, with_next, with_running
from dialoom.operators.python_functions import token_offsets

ROLES = ["user", "assistant", "user", "assistant", "system"]


@pytest.fixture(scope="module")
def turns(spark):
    """Conversation 0 has most turns; turn numbers have gaps, some wider than a part."""
    random.seed(2)
    rows = []
    for conv, count in [(0, 400), (1, 3), (2, 60), (3, 1), (4, 30)]:
        turn = random.choice([0, 0, 40])
        for _ in range(count):
            rows.append((conv, turn, random.choice(ROLES), f"{conv}-{turn}"))
            turn += random.choice([1, 1, 1, 2, 70])
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4).cache()


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_next_row_across_parts(turns):
    plain = turns.withColumn("next_role", F.lead("role").over(Window.partitionBy("conv_id").orderBy("turn")))
    cut = with_next(turns, "conv_id", "turn", ["role"], size=16)
    assert rows_of(cut) == rows_of(plain)


def test_running_values_across_blocks(turns):
    reset = F.when(F.col("role") == "system", F.col("text"))
    values = [
        Running("total", "sum", F.col("turn")),
        Running("peak", "max", F.pmod(F.hash("text"), F.lit(1000))),
        Running("latest", "last", reset),
    ]
    so_far = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    plain = turns.select(
        "*",
        F.sum("turn").over(so_far).alias("total"),
        F.max(F.pmod(F.hash("text"), F.lit(1000))).over(so_far).alias("peak"),
        F.last(reset, ignorenulls=True).over(so_far).alias("latest"),
    )
    everywhere = with_running(turns, ["conv_id"], part_of(F.col("turn"), 16), ["turn"], values)
    assert rows_of(everywhere) == rows_of(plain)
    ranged = in_ranges(turns, ["conv_id", "turn"])
    assert ranged.where("conv_id = 0").select("_range").distinct().count() > 1
    by_range = with_running(ranged, ["conv_id"], F.col("_range"), ["turn"], values).drop("_range")
    assert rows_of(by_range) == rows_of(plain)


def test_running_rejects_unknown_kinds(turns):
    with pytest.raises(ValueError):
        with_running(turns, ["conv_id"], part_of(F.col("turn")), ["turn"], [Running("x", "median", F.col("turn"))])


def test_parts_hold_the_whole_conversation(turns):
    chats = tn.collect_chat(turns, size=16).collect()
    assert max(len(c.messages) for c in chats) <= 16
    by_conv = {}
    for chat in sorted(chats, key=lambda c: (c.conv_id, c.part)):
        by_conv.setdefault(chat.conv_id, []).extend((m.role, m.content) for m in chat.messages)
    expected = {}
    for row in sorted(turns.collect(), key=lambda r: (r.conv_id, r.turn)):
        expected.setdefault(row.conv_id, []).append((row.role, row.text))
    assert by_conv == expected


def test_prompts_are_whole(turns, monkeypatch):
    ordered = sorted(turns.collect(), key=lambda r: (r.conv_id, r.turn))
    targets = turns.where("role = 'user'").select("conv_id", "turn")
    prompts = {(r.conv_id, r.turn): [m.content for m in r.messages] for r in tn.prompts_for(turns, targets).collect()}
    assert len(prompts) == sum(r.role == "user" for r in ordered)
    for (conv, turn), prompt in prompts.items():
        assert prompt == [r.text for r in ordered if r.conv_id == conv and r.turn <= turn]
    found = {}
    for size in (512, 2):
        monkeypatch.setattr(ordered_module, "TURNS_PER_PART", size)
        found[size] = rows_of(tn.prompt_history(turns))
    assert found[512] == found[2]
    assert {(c, t): n for c, t, n, _, _ in found[2]} == {key: len(p) for key, p in prompts.items()}
    swapped = turns.withColumn("text", F.when(F.col("conv_id") == 2, F.concat("text", F.lit("x"))).otherwise(F.col("text")))
    changed = {r[:2] for r in set(rows_of(tn.prompt_history(swapped))) - set(found[2])}
    assert changed == {key for key in prompts if key[0] == 2}


LONG = [(5, t, ["system", "user", "assistant"][0 if t == 0 else 1 + (t + 1) % 2], f"text {t}") for t in range(1100)]


@pytest.mark.parametrize("size", [512, 2])
def test_registered_paths_take_conversations_whole(spark, monkeypatch, tmp_path, size):
    """The queries over parts against their uncut twins, on one conversation of 1,100 turns and on small ones."""
    import shutil

    from compare import differences, duck

    from dialoom.plans.oracle import ORACLE
    from dialoom.plans.queries import QUERIES

    monkeypatch.setattr(ordered_module, "TURNS_PER_PART", size)
    folder = str(tmp_path / "sf")
    os.makedirs(folder)
    for name in os.listdir("/root/testdata/sf0.001"):
        if not name.startswith("conversations"):
            shutil.copyfile(f"/root/testdata/sf0.001/{name}", f"{folder}/{name}")
    small = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").where("conv_id > 5")
    long = spark.createDataFrame(LONG, small.schema)
    small.unionByName(long).coalesce(1).toPandas().to_parquet(f"{folder}/conversations.parquet", index=False)
    con = duck(folder)
    for name in ("prompt_history", "prompts_for", "collect_chat", "read_turns", "render_chat", "generation_prompt",
                 "extract_response", "keep_extracted", "extraction_rate", "response_spans", "answer_tokens",
                 "prompt_spans"):
        assert differences(con, QUERIES[name](spark, folder), ORACLE[name]) is None, name


def test_parts_say_where_they_start(turns):
    for family in ("qwen-2.5", "mistral"):
        whole = {r.conv_id: r.text for r in tn.whole_texts(tn.render_conversations(turns, family)).collect()}
        for part in tn.render_conversations(turns, family).collect():
            assert whole[part.conv_id][part.start_pos :].startswith(part.text)


def test_spans_point_at_the_answers(turns):
    for family in ("qwen-2.5", "gemma-3", "mistral"):
        texts = {}
        for row in sorted(tn.render_conversations(turns, family).collect(), key=lambda r: (r.conv_id, r.part)):
            texts[row.conv_id] = texts.get(row.conv_id, "") + row.text
        spans = tn.response_spans(turns, family).collect()
        answers = {(r.conv_id, r.turn): r.text for r in turns.collect() if r.role == "assistant"}
        assert {(s.conv_id, s.turn): texts[s.conv_id][s.start_pos : s.end_pos] for s in spans} == answers
        for span in tn.prompt_spans(turns, family).collect():
            assert texts[span.conv_id][: span.prompt_chars].endswith(
                {"qwen-2.5": "<|im_end|>\n", "gemma-3": "<end_of_turn>\n", "mistral": "[/INST]"}[family]
            )


@pytest.mark.parametrize("family", ["qwen-2.5", "gemma-3", "mistral"])
def test_answer_tokens_are_those_that_overlap_the_answer(spark, turns, family):
    """By whitespace and by a tokenizer of three characters a token, against all offsets of the rendered texts."""
    more = [(900, 0, "user", "q"), (900, 1, "assistant", ""), (900, 2, "user", "q r"), (900, 3, "assistant", None),
            (900, 4, "assistant", " \n"), (900, 5, "assistant", "a  b c")]
    every = turns.select("conv_id", "turn", "role", "text").unionByName(
        spark.createDataFrame(more, turns.select("conv_id", "turn", "role", "text").schema)
    )
    opening = len(TEMPLATES[family].assistant_open)

    def pieces(texts):
        return [[m.span() for m in re.finditer(r"\S+", t, re.A)] for t in texts]

    def threes(texts):
        return [[(i, min(i + 3, len(t))) for i in range(0, len(t), 3)] for t in texts]

    rows = sorted(tn.render_turns(every, family).collect(), key=lambda r: (r.conv_id, r.turn))
    for tokenizer, column in ((pieces, None), (pieces, token_offsets(pieces)), (threes, token_offsets(threes))):
        seen, expected = {}, set()
        for r in rows:
            spans = tokenizer([r.rendered])[0] if r.rendered is not None else []
            start = seen.get(r.conv_id, 0)
            seen[r.conv_id] = start + len(spans)
            if r.role == "assistant" and r.text is None:
                expected.add((r.conv_id, r.turn, None, None))
            elif r.role == "assistant":
                first = start + sum(b <= opening for _, b in spans)
                own = sum(b > opening and a < opening + len(r.text) for a, b in spans) if r.text else 0
                expected.add((r.conv_id, r.turn, first, first + own - 1))
        got = tn.answer_tokens(every, family, column).collect()
        assert len(got) == len(expected) and set(map(tuple, got)) == expected


def test_system_turns(turns):
    with_system = tn.ensure_system(turns)
    assert tn.missing_system(with_system).count() == 0
    assert with_system.count() == turns.count() + tn.missing_system(turns).count()
    assert tn.ensure_system(turns, "").count() == turns.count()
    replaced = tn.replace_system(turns, " new ")
    assert {r.system_message for r in tn.first_system(replaced).collect()} == {"new"}
    assert replaced.where("role <> 'system'").count() == turns.where("role <> 'system'").count()


def test_assemble_in_ranges(spark):
    rows = [("a", i, f"c{i}" if i % 7 else " \n") for i in range(100)] + [("b", 0, "x"), ("b", 0, "x")]
    rows += [("blank", 0, " "), ("blank", 1, None)]
    random.shuffle(rows)
    chunks = spark.createDataFrame(rows, "rid string, seq long, chunk string")
    found = {r.rid: r.response for r in tn.assemble(chunks, size=8).collect()}
    assert found == {"a": "".join(f"c{i}" for i in range(100) if i % 7), "b": "x", "blank": ""}


# --- log replay -------------------------------------------------------------------------------------------


def log_rows():
    random.seed(4)
    lines = ["hi", "more \\", "/new", "/system Be brief", "/system", "/temp 0.5", "/temp x", "/temperature", "", "/help"]
    rows = []
    for event in range(600):
        user = random.choice([1, 1, 1, 1, 2, 3])
        line = random.choice(lines)
        rows.append((user, event, event * 400, line if line != "/system Be brief" else f"/system Be brief {event}"))
    rows += [(3, 1000, 50_000, "/exit"), (2, 1001, 80_000, "/exit"), (2, 1002, 160_000, "/exit")]
    return rows


def replay_plainly(rows):
    out, state = [], {}
    for user, event, _, line in sorted(rows, key=lambda r: (r[2], r[1])):
        s = state.setdefault(user, {"conv": 0, "no": 0, "sys": "You are a helpful assistant.", "temp": 0.8, "end": False})
        text = line.rstrip("\\").strip()
        if s["end"]:
            continue
        if text == "/exit":
            s["end"] = True
        elif text == "/new":
            s["conv"], s["no"] = s["conv"] + 1, 0
        elif text.startswith("/temp"):
            try:
                s["temp"] = float(text[5:].strip())
            except ValueError:
                pass
        elif text.startswith("/system"):
            s["sys"] = text[7:].strip() or s["sys"]
        elif text and text != "/help":
            out.append((user, s["conv"], s["no"], event, text, s["sys"], s["temp"]))
            s["no"] += 1
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def log(spark):
    df = spark.createDataFrame(log_rows(), "user_id long, event_id long, at long, input string")
    return df.select("user_id", "event_id", F.timestamp_seconds("at").alias("ts"), "input").repartition(4).cache()


@pytest.mark.parametrize("ranges", ["1", "4", "40"])
def test_replay(spark, log, ranges):
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        assert rows_of(rp.replay(rp.parse_log(log))) == replay_plainly(log_rows())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_a_session_inside_one_second_is_split(spark):
    burst = spark.range(4000).select(
        F.lit(1).cast("bigint").alias("user_id"),
        F.col("id").alias("event_id"),
        F.timestamp_seconds(F.lit(5)).alias("ts"),
        F.when(F.col("id") % 1000 == 999, "/new").otherwise("hi").alias("input"),
    )
    ranged = in_ranges(rp.parse_log(burst), ["user_id", *rp.ORDER])
    assert ranged.groupBy("_range").count().agg(F.max("count")).first()[0] < 2500
    found = rp.replay(rp.parse_log(burst)).groupBy("conversation").agg(F.count("*"), F.max("message_no")).collect()
    assert sorted(map(tuple, found)) == [(c, 999, 998) for c in range(4)]


def raw_outputs(rows):
    """An output for each line: readable, unreadable and empty ones."""
    outputs = []
    for user, event, at, _ in rows:
        said = ["", f" a{event} "][event % 3 > 0]
        outputs.append((user, event, at, f"x{event}" if event % 4 == 0 else f"<|im_start|>assistant\n{said}<|im_end|>"))
    return outputs


def talk_plainly(rows, outputs):
    """(user, conversation, number, event, role, text, prompt characters) with answers behind their messages."""
    answers = {event: text[22:-10].strip() for _, event, _, text in outputs if text.startswith("<")}
    out, state = [], {}
    for user, event, _, line in sorted(rows, key=lambda r: (r[2], r[1])):
        s = state.setdefault(user, {"conv": 0, "no": 0, "chars": 0, "end": False})
        text = line.rstrip("\\").strip()
        said = not text.startswith("/") and text
        if s["end"]:
            continue
        if text == "/exit":
            s["end"] = True
        elif text == "/new":
            s.update(conv=s["conv"] + 1, no=0, chars=0)
        for role, words in [("user", text), ("assistant", answers.get(event))] if said else []:
            if words:
                s["chars"] += len(f"{role}>{words}")
                out.append((user, s["conv"], s["no"], event, role, words, s["chars"]))
                s["no"] += 1
    return sorted(out, key=repr), state


def outputs_of(spark, rows):
    messages = [r for r in rows if r[3].rstrip("\\").strip() and not r[3].startswith("/")]
    df = spark.createDataFrame(raw_outputs(messages), "user_id long, event_id long, at long, output string")
    return df.select("user_id", "event_id", F.timestamp_seconds("at").alias("ts"), "output")


@pytest.mark.parametrize("ranges", ["1", "5", "40"])
def test_answers_stand_behind_their_messages(spark, log, ranges):
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        parsed = rp.parse_log(log).unionByName(rp.parse_answers(outputs_of(spark, log_rows()), "qwen-2.5"))
        turns = rp.replay_turns(parsed)
        found = turns.select("user_id", "conversation", "message_no", "event_id", "role", "text", "prompt_chars")
        assert rows_of(found) == talk_plainly(log_rows(), raw_outputs(log_rows()))[0]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_a_replayed_log_reads_its_ranges_twice(spark, log):
    from compare import plan

    from dialoom.plans.jobs import replay_log

    text = plan(replay_log(log, outputs_of(spark, log_rows())), "simple")
    assert text.count("FileScan") <= 3
    assert sum("Exchange" in line for line in text.splitlines()) <= 6


def test_local_timestamps_are_cut_like_instants(spark, log):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        local = log.withColumn("ts", F.expr("timestamp_ntz'2024-03-09 12:00:00' + make_dt_interval(0, 0, 0, event_id * 400)"))
        assert local.schema["ts"].dataType.typeName() == "timestamp_ntz"
        found = rp.segment_log(rp.parse_log(local)).select("user_id", "event_id", "conversation")
        as_instants = local.withColumn("ts", F.col("ts").cast("timestamp"))
        plain = rp.segment_log(rp.parse_log(as_instants)).select("user_id", "event_id", "conversation")
        assert found.count() == plain.count() > 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
