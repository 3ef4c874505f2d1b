"""Caller's functions used by the registered queries."""

import re
import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def load_adder():
    """A stand-in for a model: adds the two numbers of the question, off by one on every `slip`-th sum."""

    def generate(prompts, params):
        out = []
        for prompt in prompts:
            question = prompt.rsplit("Question:", 1)[-1]
            total = sum(int(number) for number in re.findall(r"\d+", question))
            out.append(f"<output>{total + (total % params['slip'] == 0)}</output>")
        return out

    return generate


def piece_lengths(texts: list[str]) -> list[list[int]]:
    """A stand-in for a tokenizer: the length of each whitespace-separated piece."""
    return [[len(piece) for piece in text.split()] for text in texts]


def measure_pair(record: dict) -> dict:
    """A record function: the ids of a pair and the words of its answer that its question has too."""
    asked, said = record["user"].split(), record["assistant"].split()
    return {"conv_id": record["conv_id"], "turn": record["turn"], "words": len(said), "shared": len({*asked} & {*said})}
