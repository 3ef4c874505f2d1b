import random
from pathlib import PurePosixPath

import pytest
from pyspark.sql import functions as F

from dialoom.functions import chatlog as cl
from dialoom.functions import settings as st


def test_base_name_is_the_path_stem(column_values):
    random.seed(5)
    paths = ["configs/phi-4.yaml", "gemma-4b-it", "llama-3.1-8b", "a/b.tar.gz", ".hidden", "a/.hidden.x", "a/b/", "a/./", "a."]
    paths += ["".join(random.choices("ab./", k=random.randint(1, 7))) for _ in range(300)]
    # A last part of dots alone is not a config's name.
    paths = [p for p in paths if PurePosixPath(p).name.strip(".")]

    def stem(path):
        name = PurePosixPath(path).name
        dot = name.rfind(".")
        return name[:dot] if 0 < dot < len(name) - 1 else name

    assert column_values(st.config_base_name, paths) == [stem(p) for p in paths]


def test_merge_keeps_explicit_nulls_and_unknown_keys(spark):
    df = spark.createDataFrame([({"system_message": None, "warmup_steps": "5", "learning_rate": "1e-4"},)], "s map<string,string>")
    merged = df.select(st.merge_config(st.default_settings(), F.col("s")).alias("m"))
    values = merged.first().m
    assert values["system_message"] is None and values["warmup_steps"] == "5" and values["lora_rank"] == "256"
    assert len(values) == len(st.DEFAULT_SETTINGS) + 1
    assert merged.select(st.cast_config(F.col("m")).alias("c")).select("c.learning_rate").first()[0] == 1e-4


def test_cast_fails_on_bad_text(spark):
    df = spark.createDataFrame([({"learning_rate": "fast"},)], "s map<string,string>")
    with pytest.raises(Exception, match="learning_rate is not a number: fast"):
        df.select(st.cast_config(F.col("s"))).collect()


def test_names(spark, column_values):
    assert column_values(st.family_stub, ["llama-3.1", "a--b", "é_1"]) == ["llama_3_1", "a_b", "é_1"]
    df = spark.sql("select 'configs/phi-4.yaml' p, timestamp'2025-05-11 17:34:59' t")
    assert df.select(st.versioned_name(F.col("p"), None, F.col("t"))).first()[0] == "phi-4-2025_05_11_17_34"
    assert df.select(st.versioned_name(F.col("p"), F.lit("001"))).first()[0] == "phi-4-001"


LINES = [" /exit \\", "/exit now", "/new", "/temperature", "/temp", "/temp  0.7 ", "/system", "/system  Be brief ", "/systemx",
         "", " \\\\ ", "hello\\", "a\\\nb", "/helpme", "/help", "/clear"]


def test_commands(column_values):
    assert column_values(lambda c: cl.command_kind(cl.clean_input(c)), LINES) == [
        "exit", "message", "new", "temp", "temp", "temp", "system", "system", "system",
        "blank", "message", "message", "message", "message", "help", "clear",
    ]
    assert column_values(lambda c: cl.command_argument(cl.clean_input(c)), LINES)[3:9] == [
        "erature", None, "0.7", None, "Be brief", "x"
    ]
    assert column_values(cl.clean_input, ["hello\\", "a\\\nb", "x \\\\ "]) == ["hello", "a\nb", "x \\\\"]


def test_temperature(column_values):
    texts = ["0.7", " 1 ", "0", "-1", "nan", "inf", "1d", "1_0", "1e-3", ".5", "5.", "1e999", "", "x"]
    assert column_values(cl.parse_temperature, texts) == [
        0.7, 1.0, None, None, None, None, None, None, 0.001, 0.5, 5.0, None, None, None
    ]
