"""Inputs of the registered queries, derived from the given tables. All work on batch and on stream tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.families import FAMILY_NAMES
from dialoom.operators.replay import parse_log
from dialoom.operators.turns import render_texts, turn_pairs

CHUNK_CHARS = 40
STOP_DECOY = "Question: 99"
PER_CONFIG = [
    ("gemma-4b-it", "gemma-3"),
    ("llama-3.1-8b", "llama-3.1"),
    ("llama-3.2-3b", "llama-3.1"),
    ("mistral-7b", "mistral"),
    ("phi-4", "phi-4"),
    ("qwen-2.5-7b", "qwen-2.5"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the orders, dealt out before each becomes several samples: files may be fewer than cores."""
    keys = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return keys.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "o_orderkey")


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations")


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_pairs(turns(spark, sf_dir))


def family_of(key: Column) -> Column:
    """A family for each key, all five in turn."""
    return F.get(F.array(*[F.lit(name) for name in FAMILY_NAMES]), (key % len(FAMILY_NAMES)).cast("int"))


def tagged(turns: DataFrame) -> DataFrame:
    """Assistant turns as well formed, unclosed, output-only and plain tagged text."""
    text, form = F.col("text"), F.col("turn") % 8
    well_formed = F.concat(
        F.lit("<reasoning>"),
        F.left(text, F.lit(20)),
        F.lit("</reasoning>\n<output>"),
        F.substr(text, F.lit(21)),
        F.lit("</output>"),
    )
    shaped = (
        F.when(form == 1, well_formed)
        .when(form == 3, F.concat(F.lit("pre <reasoning>"), text))
        .when(form == 5, F.concat(F.lit("<output>"), F.left(text, F.lit(30)), F.lit("</output> tail")))
        .otherwise(text)
    )
    return turns.where(F.col("role") == "assistant").select("conv_id", "turn", shaped.alias("text"))


def chunked(replies: DataFrame) -> DataFrame:
    """Replies (conv_id, turn, text) cut into pieces of the same length, over their whole text."""
    last = F.greatest(F.ceil(F.length("text") / CHUNK_CHARS), F.lit(1)) - 1
    return replies.select(
        F.concat_ws("-", "conv_id", "turn").alias("rid"),
        "text",
        last.alias("_last"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("seq"),
    ).select(
        "rid",
        "seq",
        F.substr("text", (F.col("seq") * CHUNK_CHARS + 1).cast("int"), F.lit(CHUNK_CHARS)).alias("chunk"),
        (F.col("seq") == F.col("_last")).alias("is_last"),
    )


def answers(turns: DataFrame) -> DataFrame:
    return turns.where(F.col("role") == "assistant").select("conv_id", "turn", "text")


def raw_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw model output (conv_id, model_family, text): rendered conversations of all families, some with a
    newline after the end marker and some with a blank, which no pattern but gemma's allows."""
    family = family_of(F.col("conv_id"))
    tail = F.get(F.array(F.lit(""), F.lit("\n"), F.lit(" ")), (F.col("conv_id") % 3).cast("int"))
    return render_texts(turns(spark, sf_dir), family).select(
        "conv_id", family.alias("model_family"), F.concat("text", tail).alias("text")
    )


def samples(orders: DataFrame) -> DataFrame:
    """Eval samples of two variants with two repeats each, in six forms of response."""
    total = (F.col("o_orderkey") + F.col("o_custkey")).cast("string")
    off_by_one = (F.col("o_orderkey") + F.col("o_custkey") + 1).cast("string")

    def run(variant: str, repeat_no: int, shift: int) -> Column:
        return F.struct(
            F.lit(variant).alias("variant"), F.lit(repeat_no).cast("bigint").alias("repeat_no"), F.lit(shift).alias("k")
        )

    runs = F.array(run("base", 0, 0), run("base", 1, 3), run("fine_tune", 0, 1), run("fine_tune", 1, 4))
    form = (F.col("doc_id") + F.col("k")) % 6
    return orders.select(
        F.concat(F.lit("m"), F.col("o_custkey") % 3).alias("model"),
        F.lit("arith").alias("task"),
        F.col("o_orderkey").alias("doc_id"),
        F.concat(
            F.lit("Order "),
            F.col("o_orderkey").cast("string"),
            F.lit(" belongs to customer "),
            F.col("o_custkey").cast("string"),
            F.lit(". What is the sum?"),
        ).alias("question"),
        F.concat(F.lit("Add them. #### "), total).alias("answer"),
        total.alias("_total"),
        off_by_one.alias("_wrong"),
        F.inline(runs),
    ).select(
        "model",
        "variant",
        "task",
        "doc_id",
        "repeat_no",
        "question",
        "answer",
        F.when(form == 0, F.concat(F.lit("<reasoning>1 + 2</reasoning><output>"), "_total", F.lit("</output>")))
        .when(form == 1, F.concat(F.lit("<reasoning>x</reasoning>\n<output> "), "_total", F.lit(". </output>")))
        .when(form == 2, F.concat(F.lit("<output>"), "_wrong", F.lit("</output>")))
        .when(form == 3, F.concat(F.lit("I think 12 then $"), "_total", F.lit(".")))
        .when(form == 4, F.lit("no idea"))
        .otherwise(F.concat(F.lit("<output>"), "_total", F.lit("</output>" + STOP_DECOY)))
        .alias("response"),
    )


def choices(orders: DataFrame) -> DataFrame:
    order, customer = F.col("o_orderkey"), F.col("o_custkey")
    return orders.select(
        F.col("o_orderpriority").alias("subject"),
        order.alias("doc_id"),
        (order % 7).alias("s0"),
        (customer % 7).alias("s1"),
        ((order + customer) % 7).alias("s2"),
        ((order * 3) % 7).alias("s3"),
        (customer % 4).alias("answer_idx"),
    )


def chatlog(events: DataFrame) -> DataFrame:
    """A chat log with all kinds of command, valid and invalid temperatures."""
    event, kind = F.col("event_id"), F.col("event_type")
    temperature = (F.col("value") - 20).cast("decimal(10,2)").cast("string")
    line = (
        F.when(event % 997 == 996, F.lit("/exit"))
        .when(event % 13 == 0, F.lit("/temperature"))
        .when(event % 17 == 0, F.lit("/help"))
        .when(kind == "signup", F.lit("/new"))
        .when(kind == "purchase", F.concat(F.lit("/system Be brief "), (event % 7).cast("string")))
        .when(kind == "error", F.concat(F.lit("/temp "), temperature))
        .when(kind == "view", F.lit(""))
        .otherwise(F.concat(F.lit("msg "), event.cast("string"), F.lit(" \\")))
    )
    return events.select("user_id", "event_id", "ts", line.alias("input"))


def outputs(events: DataFrame) -> DataFrame:
    """Raw answers to the messages of `chatlog`: some without the marker to read them by, some empty."""
    log = parse_log(chatlog(events)).where(F.col("kind") == "message")
    said = F.concat(F.lit("About "), F.col("line"))
    form = F.col("event_id") % 5
    body = F.when(form == 1, F.lit(" \n")).when(form == 2, F.concat(F.lit(" "), said, F.lit("\n"))).otherwise(said)
    marked = F.concat(F.lit("<|im_start|>assistant\n"), body, F.lit("<|im_end|>"))
    return log.select("user_id", "event_id", "ts", F.when(form == 0, said).otherwise(marked).alias("output"))


def configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run configs (k, config, settings), one for each part: own paths, families, explicit nulls, unknown keys."""
    k = F.col("p_partkey")
    key = k.cast("string")
    path = (
        F.when(k % 4 == 0, F.concat(F.lit("configs/llama-3.1-8b-"), key, F.lit(".yaml")))
        .when(k % 4 == 1, F.concat(F.lit("configs/run "), key, F.lit("/")))
        .when(k % 4 == 2, F.concat(F.lit("team.a/"), F.col("p_brand"), F.lit("-"), key, F.lit(".v2.yml")))
        .otherwise(F.concat(F.lit("configs/.hidden"), key))
    )

    def entry(condition: Column, name: str, value: Column) -> Column:
        return F.when(condition, F.struct(F.lit(name).alias("key"), value.alias("value")))

    null = F.lit(None).cast("string")
    entries = F.array(
        entry(F.lit(True), "model_name", F.concat(F.lit("org/model-"), key)),
        entry(k % 7 != 6, "model_family", F.when(k % 7 == 5, F.lit("none")).otherwise(family_of(k % 7))),
        entry(k % 2 == 0, "label", F.concat(F.lit("Model "), key)),
        entry(k % 3 == 0, "learning_rate", F.lit("1e-4")),
        entry(k % 3 == 1, "learning_rate", null),
        entry(k % 5 == 0, "system_message", null),
        entry(k % 5 == 1, "system_message", F.lit("")),
        entry(k % 4 == 0, "attn_implementation", F.lit("flash")),
        entry(k % 4 == 1, "attn_implementation", null),
        entry(k % 6 == 0, "format_with_eos_token", F.lit("true")),
        entry(k % 9 == 0, "warmup_steps", F.lit("5")),
        entry(k % 11 == 0, "output_dir", F.concat(F.lit("runs/"), key)),
    )
    settings = F.map_from_entries(F.filter(entries, lambda e: e.isNotNull()))
    return table(spark, sf_dir, "part").select(k.alias("k"), path.alias("config"), settings.alias("settings"))
