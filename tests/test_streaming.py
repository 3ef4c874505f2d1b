import random

import pytest
from pyspark.sql import functions as F

from dialoom.functions.text import split_tags
from dialoom.operators import turns as tn
from dialoom.session import streaming_session, work_path
from dialoom.sources import files
from dialoom.streaming import jobs
from dialoom.streaming.state import read_sections


def cuts(text, rng):
    out, at = [], 0
    while at < len(text):
        size = rng.randint(1, 9)
        out.append(text[at : at + size])
        at += size
    return out or [""]


def replies():
    rng = random.Random(8)
    texts = ["plain text", "a<reasoning>b\n\nc</reasoning> d <output>e</output>f", "<output>only", "<reasoning>x", "", "<outp"]
    texts += ["x" * n + "<reasoning>r</reasoning><output>" + "o" * n + "</output>" for n in range(8)]
    return [(f"r{i}", text, cuts(text, rng)) for i, text in enumerate(texts)]


@pytest.fixture(scope="module")
def chunk_folder(spark):
    """Chunks spread over four files at random: late, early and repeated ones. Each file is a micro-batch."""
    rng = random.Random(9)
    rows = [(rid, seq, chunk, seq == len(chunks) - 1) for rid, _, chunks in replies() for seq, chunk in enumerate(chunks)]
    rng.shuffle(rows)
    folder = work_path(spark, "test_chunks")
    size = len(rows) // 4 + 1
    schema = "rid string, seq long, chunk string, is_last boolean"
    for i in range(4):
        spark.createDataFrame(rows[i * size : (i + 1) * size], schema).coalesce(1).write.mode("append").parquet(folder)
    return folder


def run(spark, build, folder):
    sibling = streaming_session(spark)
    out = work_path(spark, "test_out")
    stream = build(files.stream_chunks(sibling, folder, files_per_batch=1))
    query = files.stream_sink(stream, f"{out}/data", f"{out}/checkpoint")
    assert len(query.recentProgress) >= 4
    return spark.read.parquet(f"{out}/data")


def test_assembling_over_batches_equals_the_batch_operator(spark, chunk_folder):
    found = run(spark, jobs.stream_assemble, chunk_folder)
    batch = tn.assemble(spark.read.parquet(chunk_folder))
    streamed = {r.rid: r.response for r in found.collect()}
    assert streamed == {r.rid: r.response for r in batch.collect()}
    assert found.count() == len(replies())


def test_sections_over_batches_equal_the_text_split(spark, chunk_folder):
    found = {}
    for row in sorted(run(spark, jobs.stream_tags, chunk_folder).collect(), key=lambda r: (r.rid, r.piece_no)):
        found.setdefault((row.rid, row.section), []).append(row.text)
    texts = spark.createDataFrame([(rid, text) for rid, text, _ in replies()], "rid string, text string")
    expected = {}
    for row in texts.select("rid", split_tags(F.col("text")).alias("s")).collect():
        for section, text in (("text", row.s.preamble + row.s.rest), ("reasoning", row.s.reasoning), ("output", row.s.output)):
            if text:
                expected[(row.rid, section)] = text
    assert {k: "".join(v) for k, v in found.items()} == expected


def test_repeats_and_nulls_are_told_once(spark):
    rows = [("a", 0, "x<output>", False), ("a", 1, "y", True), ("n", 0, None, True)]
    folder = work_path(spark, "test_repeats")
    for _ in range(4):
        spark.createDataFrame(rows, "rid string, seq long, chunk string, is_last boolean").coalesce(1).write.mode(
            "append"
        ).parquet(folder)
    assert sorted(map(tuple, run(spark, jobs.stream_assemble, folder).collect())) == [("a", "x<output>y"), ("n", "")]
    pieces = run(spark, jobs.stream_tags, folder).select("rid", "piece_no", "section", "text").collect()
    assert sorted(map(tuple, pieces)) == [("a", 0, "text", "x"), ("a", 1, "output", "y")]


def replies_of(spark, folder, tags=False, **options):
    sibling = streaming_session(spark)
    out = work_path(spark, "test_replies")
    chunks = files.stream_chunks(sibling, folder, files_per_batch=1) if not options else options.pop("chunks")(sibling)
    jobs.stream_replies(chunks, out, f"{out}/checkpoint", tags=tags, **options)
    return jobs.told_replies(spark, out, tags), out


def sections_of(pieces):
    found = {}
    for row in sorted(pieces.collect(), key=lambda r: (r.rid, r.piece_no)):
        found.setdefault((row.rid, row.section), []).append(row.text)
    return {k: "".join(v) for k, v in found.items()}


def test_replies_that_are_all_there_need_no_state(spark, chunk_folder):
    found, out = replies_of(spark, chunk_folder)
    batch = tn.assemble(spark.read.parquet(chunk_folder))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, batch.collect()))
    keyed = {r.rid for r in spark.read.parquet(f"{out}/open").select("rid").distinct().collect()}
    whole = {r.rid for r in spark.read.parquet(f"{out}/whole").collect()}
    assert keyed and whole and not keyed & whole
    assert sections_of(replies_of(spark, chunk_folder, tags=True)[0]) == sections_of(run(spark, jobs.stream_tags, chunk_folder))


def test_replies_told_by_both_ways_are_told_once(spark):
    rows = [("a", 0, "x<output>", False), ("a", 1, " ", False), ("a", 2, "y", True), ("n", 0, None, True)]
    folder = work_path(spark, "test_ways")
    for part in (rows[:1], rows, rows[1:], rows):
        spark.createDataFrame(part, "rid string, seq long, chunk string, is_last boolean").coalesce(1).write.mode(
            "append"
        ).parquet(folder)
    assert sorted(map(tuple, replies_of(spark, folder)[0].collect())) == [("a", "x<output>y"), ("n", "")]
    pieces = replies_of(spark, folder, tags=True)[0].select("rid", "piece_no", "section", "text").collect()
    assert sorted(map(tuple, pieces)) == [("a", 0, "text", "x"), ("a", 1, "output", " y")]


@pytest.mark.parametrize("tags", [False, True])
def test_state_of_old_replies_is_dropped(spark, tags):
    """Two open chunks an hour for 30 hours, of replies that end two hours later; an hour of silence is too long."""
    folder = work_path(spark, "test_hours")
    schema = "rid string, seq long, chunk string, is_last boolean, at long"
    for hour in range(30):
        rows = [(f"r{hour}", 0, "a", False, hour * 3600), (f"lost{hour}", 0, "b", False, hour * 3600)]
        rows += [(f"r{hour - 1}", 1, "c", True, hour * 3600)] if hour else []
        df = spark.createDataFrame(rows, schema).withColumn("ts", F.timestamp_seconds("at")).drop("at")
        df.coalesce(1).write.mode("append").parquet(folder)
    schema = spark.read.parquet(folder).schema

    def stream(sibling):
        return sibling.readStream.schema(schema).option("maxFilesPerTrigger", 10).parquet(folder)

    found, out = replies_of(spark, folder, tags, chunks=stream, forget_after="2 hours")
    assert {f"r{hour}" for hour in range(29)} <= {r.rid for r in found.collect()}
    name = "place" if tags else "done"
    state = spark.read.format("statestore").option("path", f"{out}/checkpoint/open").option("stateVarName", name).load()
    assert state.count() < 10  # of 60 replies


def test_a_stream_with_a_trigger_stays_up_and_forgets(spark, chunk_folder):
    import time

    sibling = streaming_session(spark)
    out = work_path(spark, "test_up")
    stream = jobs.stream_assemble(files.stream_chunks(sibling, chunk_folder), ttl_ms=3_000)
    query = files.stream_sink(stream, f"{out}/data", f"{out}/checkpoint", {"processingTime": "1 second"})

    def kept():
        return [op["numRowsTotal"] for p in query.recentProgress[-1:] for op in p["stateOperators"]]

    try:
        waited, most = time.time() + 120, 0
        while time.time() < waited:  # a time to live keeps a batch running every second, so nothing is ever all done
            most = max([most, *kept()])
            if most and kept() == [0]:
                break
            time.sleep(0.3)
        assert query.isActive and most > 0 and kept() == [0]
    finally:
        query.stop()
    assert spark.read.parquet(f"{out}/data").count() == len(replies())


def test_sections_do_not_depend_on_the_cuts():
    rng = random.Random(10)
    pieces = ["<reasoning>", "</reasoning>", "<output>", "</output>", "a", "<", "</", "\n"]
    for _ in range(500):
        text = "".join(rng.choices(pieces, k=rng.randint(1, 10)))
        whole, _, _ = read_sections("text", text, True)
        section, buffer, found = "text", "", []
        chunks = cuts(text, rng)
        for i, chunk in enumerate(chunks):
            new, section, buffer = read_sections(section, buffer + chunk, i == len(chunks) - 1)
            found += new

        def joined(parts):
            out = []
            for name, body in parts:
                if out and out[-1][0] == name:
                    out[-1][1] += body
                else:
                    out.append([name, body])
            return out

        assert joined(found) == joined(whole)


def streamed_log(spark, rows, batches=4):
    """The log and its outputs as streams of a file a batch, and the folder of the replay."""
    from test_ordered import raw_outputs

    out = work_path(spark, "test_replay")
    streams = []
    said = [r for r in rows if r[3].rstrip("\\").strip() and not r[3].startswith("/")]
    every = {"input": sorted(rows, key=lambda r: (r[2], r[1])), "output": sorted(raw_outputs(said), key=lambda r: (r[2], r[1]))}
    cuts = [every["input"][len(rows) * i // batches][2] for i in range(batches)] + [1 << 40]
    sibling = streaming_session(spark)
    for name, part in every.items():
        for low, high in zip(cuts[:-1], cuts[1:]):
            some = [r for r in part if low <= r[2] < high]
            df = spark.createDataFrame(some, f"user_id long, event_id long, at long, {name} string")
            df = df.select("user_id", "event_id", F.timestamp_seconds("at").alias("ts"), name)
            df.coalesce(1).write.mode("append").parquet(f"{out}/{name}")
        schema = spark.read.parquet(f"{out}/{name}").schema
        streams.append(sibling.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{out}/{name}"))
    return *streams, out


def test_replay_over_batches_equals_the_batch_operator(spark):
    from test_ordered import log_rows, raw_outputs, replay_plainly, talk_plainly

    log, outputs, out = streamed_log(spark, log_rows())
    jobs.stream_replay(log, out, f"{out}/checkpoint", outputs=outputs)
    found = jobs.replayed_messages(spark, out)
    assert spark.read.parquet(f"{out}/said").select("batch").distinct().count() == 4
    talk, state = talk_plainly(log_rows(), raw_outputs(log_rows()))
    turns = found.select("user_id", "conversation", "message_no", "event_id", "role", "text", "prompt_chars")
    assert sorted(map(tuple, turns.collect()), key=repr) == talk
    settings = found.where("role = 'user'").select("user_id", "event_id", "system_message", "temperature").collect()
    assert sorted(map(tuple, settings)) == sorted((r[0], r[3], r[5], r[6]) for r in replay_plainly(log_rows()))

    live = {r.user_id: (r.conversation, r.messages, r.chars, r.ended) for r in jobs.live_sessions(spark, f"{out}/checkpoint").collect()}
    assert live == {user: (s["conv"], s["no"], s["chars"], s["end"]) for user, s in state.items()}
    history = sorted(map(tuple, jobs.live_history(spark, out, f"{out}/checkpoint").collect()))
    assert history == sorted((r[0], r[2], r[4], r[5]) for r in talk if r[1] == state[r[0]]["conv"])


def test_a_session_without_rows_is_not_touched_and_goes(spark):
    day = 86_400
    rows = [(1, 0, day, "hi"), (2, 1, day, "hi")] + [(2, 2 + i, day * (2 + i), f"m{i}") for i in range(20)]
    log, _, out = streamed_log(spark, rows)
    jobs.stream_replay(log, out, f"{out}/checkpoint", forget_after="5 days")
    found = jobs.replayed_messages(spark, out)
    assert found.count() == len(rows) and found.where("user_id = 2").agg(F.max("message_no")).first()[0] == 20
    assert [r.user_id for r in jobs.live_sessions(spark, f"{out}/checkpoint").collect()] == [2]

    log, _, out = streamed_log(spark, rows)
    jobs.stream_replay(log, out, f"{out}/checkpoint")
    assert {r.user_id for r in jobs.live_sessions(spark, f"{out}/checkpoint").collect()} == {1, 2}


def test_a_batch_done_twice_is_told_once(spark):
    from test_ordered import log_rows, replay_plainly

    log, _, out = streamed_log(spark, log_rows(), 2)
    jobs.stream_replay(log, out, f"{out}/checkpoint")
    jobs.stream_replay(log, out, f"{out}/again")  # as if the ends of the batches had not been noted
    found = jobs.replayed_messages(spark, out).where("role = 'user'").drop("_range", "role", "prompt_chars")
    assert found.distinct().count() == len(replay_plainly(log_rows()))
