"""Column functions over chat-log input lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dialoom.functions.text import strip

# Defaults of the chat settings.
DEFAULT_SYSTEM_MESSAGE = "You are a helpful assistant."
DEFAULT_TEMPERATURE = 0.8

NUMBER = r"\A[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\z"


def clean_input(line: Column) -> Column:
    """Continued lines joined, trailing backslashes dropped, then stripped."""
    joined = F.replace(line, F.lit("\\\n"), F.lit("\n"))
    return strip(F.rtrim(joined, F.lit("\\")))


def command_kind(line: Column) -> Column:
    """What a cleaned line is: a command, blank or a message. Settings commands match by prefix."""
    return (
        F.when(line == "/exit", "exit")
        .when(line == "/new", "new")
        .when(line == "/clear", "clear")
        .when(line == "/help", "help")
        .when(F.startswith(line, F.lit("/temp")), "temp")
        .when(F.startswith(line, F.lit("/system")), "system")
        .when(line == "", "blank")
        .otherwise("message")
    )


def command_argument(line: Column) -> Column:
    """Argument of a settings command, null when it is missing or blank."""
    text = F.when(F.startswith(line, F.lit("/temp")), F.substr(line, F.lit(len("/temp") + 1))).when(
        F.startswith(line, F.lit("/system")), F.substr(line, F.lit(len("/system") + 1))
    )
    return F.nullif(strip(text), F.lit(""))


def parse_temperature(text: Column) -> Column:
    """A finite positive number, else null."""
    value = F.when(F.rlike(strip(text), F.lit(NUMBER)), strip(text).try_cast("double"))
    return F.when((value > 0) & (value < float("inf")), value)
