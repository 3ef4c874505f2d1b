"""Personal data in documents, and the words that give it away.

Entities are found by their form: mail addresses, network addresses, card numbers, telephone numbers. Hiding
them is not enough where words of the text reveal which they were. How much a term t reveals of an entity c is
estimated from co-occurrence: p(c) is the share of all words of the corpus that stand within a few words of c,
p(c|t) that share among the occurrences of t, drawn towards p(c) by half an occurrence, as both may be rare. The
pointwise mutual information log p(c|t) / p(c) is at most the information content -log p(c) of the entity, which t
reaches if it occurs beside c only. Terms whose quotient of the two is above a threshold are generalised (to the
kind of word they are), those above a higher one are removed, wherever they stand in documents that hold the entity.

Every pair counts, also of an entity and a term that occur once. Counts cover all words of all texts. How
often a term occurs beside entities, and then in the documents that hold any, are lower bounds of its frequency and
rule out most common terms before the others are counted in the whole corpus. Values of entities leave the Python workers as hashes only.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.llm.common import free_names, limit_batches, row_keys, text_bytes, text_slices, written
from dialoom.llm.textbytes import LOWER, span_hashes, spans

KINDS = ("email", "ip", "card", "phone")
ALL_KINDS = (*KINDS, "generalise", "remove")
WINDOW = 6
DRAWN = 0.5
GENERALISE, REMOVE = 0.85, 0.95
SIEVE_BITS = 24
COUNTED = 1 << 20  # terms of which a task keeps counts before it tells them

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
ADDRESS = re.compile(r"(?<![0-9])[0-9]++\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
IN_TERM = np.zeros(256, bool)
IN_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


# ---- entities


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """An address has one @, and what may stand before it may not be one, so each @ is tried once."""
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at) if start < at else None
        if match:
            end = match.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def entities(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the entities in `text`, leftmost and not overlapping within a kind."""
    found = [("email", *span) for span in _emails(text)]
    for m in ADDRESS.finditer(text):
        if all(int(part[-4:]) <= 255 and not part[:-4].strip("0") for part in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = _digits(m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            found.append(("phone", *m.span()))
    return found


def _value(text: str, kind: str, start: int, end: int) -> str:
    value = f"{kind}:{text[start:end].lower() if kind == 'email' else _digits(text[start:end])}"
    return hashlib.sha256(value.encode()).hexdigest()[:24]


def _free_words(text: str, found: list[tuple[str, int, int]]) -> list[re.Match]:
    """The words of `text` that share no character with an entity."""
    merged: list[list[int]] = []
    for _, start, end in sorted(found, key=lambda f: f[1:]):
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    ends = [end for _, end in merged]
    out = []
    for m in TERM.finditer(text):
        at = bisect_right(ends, m.start())
        if at == len(merged) or merged[at][0] >= m.end():
            out.append(m)
    return out


def _contexts(text: str, found: list[tuple[str, int, int]], window: int) -> tuple[Counter, Counter, list[str]]:
    """How often each (entity, term) stands within `window` words of each other, how often each such term occurs in
    `text` at all, and the entities."""
    words = _free_words(text, found)
    starts, terms = [m.start() for m in words], [_ascii_lower(m[0]) for m in words]
    together, entities_ = Counter(), []
    for kind, start, end in found:
        entity = _value(text, kind, start, end)
        entities_.append(entity)
        middle = bisect_left(starts, start)
        together.update((entity, t) for t in terms[max(0, middle - window) : middle + window])
    near = {t for _, t in together}
    return together, Counter(t for t in terms if t in near), list(dict.fromkeys(entities_))


ASCII = {code: code + 32 for code in range(65, 91)}


def _ascii_lower(word: str) -> str:
    return word.translate(ASCII)


FOUND = (
    "base array<struct<kind string, start long, end long>>, near array<struct<entity string, hash long, n long>>, "
    "terms array<struct<hash long, n long>>, holds array<string>, n_words long, told string"
)


def _found(named: DataFrame, window: int) -> DataFrame:
    """For each row its entities, their pairs with terms, those terms' counts, its number of words, and its text if
    it has entities."""
    kind = named.schema["doc_id"].dataType.simpleString()
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    pair = pa.list_(pa.struct([("entity", pa.string()), ("hash", pa.int64()), ("n", pa.int64())]))
    term = pa.list_(pa.struct([("hash", pa.int64()), ("n", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                texts = part["text"].to_pylist()
                found = [entities(text or "") for text in texts]
                every = [_contexts(t, f, window) if f else ((), (), []) for t, f in zip(texts, found, strict=True)]
                listed = sorted({t for _, counts, _ in every for t in counts})
                hashes = dict(zip(listed, term_hashes(pa.array(listed, pa.string()))[0].view(np.int64).tolist(), strict=True))
                near = [[{"entity": c, "hash": hashes[t], "n": n} for (c, t), n in dict(p).items()] for p, _, _ in every]
                terms = [[{"hash": hashes[t], "n": n} for t, n in dict(counts).items()] for _, counts, _ in every]
                bases = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in f] for f in found]
                keys = [name for name in part.schema.names if name != "text"]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part[k] for k in keys),
                        pa.array(bases, span),
                        pa.array(near, pair),
                        pa.array(terms, term),
                        pa.array([holds for _, _, holds in every], pa.list_(pa.string())),
                        pa.array(term_hashes(part["text"])[1], pa.int64()),
                        pa.array([t if f else None for t, f in zip(texts, found, strict=True)], pa.string()),
                    ],
                    [*keys, "base", "near", "terms", "holds", "n_words", "told"],
                )

    extra = "".join(f", {c} long" for c in named.columns if c not in ("row", "doc_id", "text"))
    return named.mapInArrow(run, f"row long, doc_id {kind}{extra}, {FOUND}")


# ---- terms


def term_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of each text, and how many each text has."""
    data, offsets = text_bytes(column)
    data = LOWER[data]
    start, end = spans(IN_TERM[data], offsets)
    return span_hashes(data, start, end), np.diff(np.searchsorted(start, offsets))


def _sieve(terms: DataFrame) -> np.ndarray:
    """A table of fixed size with a bit set for each of `terms` (hash), whatever their number."""
    place = F.shiftrightunsigned("hash", 64 - SIEVE_BITS)
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(hash, {64 - SIEVE_BITS}) % 64 as int))")
    rows = terms.groupBy(F.shiftrightunsigned(place, 6).alias("at")).agg(F.bit_or(bit).alias("bits")).collect()
    table = np.zeros(1 << (SIEVE_BITS - 6), np.int64)
    for row in rows:
        table[row["at"]] = row["bits"]
    return table.view(np.uint64)


def _in_sieve(hashes: np.ndarray, sieve: np.ndarray) -> np.ndarray:
    """Which hashes have their bit set; few of those that were not listed do."""
    place = hashes >> np.uint64(64 - SIEVE_BITS)
    return ((sieve[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1)).astype(bool)


def _term_counts(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """(hash, n) of how often each of `terms` occurs in `texts`. A task adds up its own counts first."""
    sieve = _sieve(terms)

    def added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        hashes, place = np.unique(np.concatenate([h for h, _ in parts]), return_inverse=True)
        return hashes, np.bincount(place, np.concatenate([n for _, n in parts]), len(hashes)).astype(np.int64)

    def told(hashes: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(n)], ["hash", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))], 0
        for batch in batches:
            for part in text_slices(batch, "text"):
                hashes, _ = term_hashes(part["text"])
                parts.append(np.unique(hashes[_in_sieve(hashes, sieve)], return_counts=True))
                size += len(parts[-1][0])
                if size > 2 * COUNTED:
                    parts = [added(parts)]
                    size = len(parts[0][0])
                    if size > COUNTED:
                        yield told(*parts.pop())
                        parts, size = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))], 0
        yield told(*added(parts))

    counts = texts.mapInArrow(run, "hash long, n long")
    return counts.groupBy("hash").agg(F.sum("n").alias("n")).join(terms.select("hash").distinct(), "hash", "left_semi")


def _revealed(p: Column, together: Column, n: Column) -> Column:
    """The share of an entity's information that a term gives."""
    p = F.least(p, F.lit(1 - 1e-9))
    given = F.least((together + DRAWN * p) / (n + DRAWN), F.lit(1.0))
    return F.log2(given / p) / -F.log2(p)


def _disclosing(named: DataFrame, found: DataFrame) -> DataFrame:
    """(entity, hash, disclosure) of the terms above the lower threshold."""
    words = found.agg(F.sum("n_words")).first()[0] or 1
    near = found.select(F.explode("near").alias("c")).select("c.*")
    together = near.groupBy("entity", "hash").agg(F.sum("n").alias("together"))
    beside = near.groupBy("entity").agg((F.sum("n") / F.lit(float(words))).alias("p"))
    least = found.select(F.explode("terms").alias("t")).groupBy("t.hash").agg(F.sum("t.n").alias("n"))
    pairs = together.join(beside, "entity").join(least, "hash")
    told = found.where(F.col("told").isNotNull()).select(F.col("told").alias("text"))
    revealed = _revealed(F.col("p"), F.col("together"), F.col("n"))
    possible = pairs
    for texts in (told, named.select("text")):  # the longer list of terms is counted in the fewer texts
        possible = written(possible.where(revealed >= GENERALISE).drop("n"), "possible")
        possible = possible.join(_term_counts(texts, possible), "hash")
    scored = possible.withColumn("disclosure", revealed).where(F.col("disclosure") >= GENERALISE)
    return written(scored.select("entity", "hash", "disclosure"), "disclosing")


def _places(found: DataFrame, terms: DataFrame) -> DataFrame:
    """(row, hash, start, end) of the occurrences of `terms` (and of a few others) in texts that hold entities."""
    sieve = _sieve(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "told"):
                rows, words = [], []
                for row, text, base in zip(*(part[c].to_pylist() for c in ("row", "told", "base")), strict=True):
                    free = _free_words(text, [(s["kind"], s["start"], s["end"]) for s in base])
                    rows += [row] * len(free)
                    words += free
                hashes, _ = term_hashes(pa.array([m[0] for m in words], pa.string()))
                some = np.flatnonzero(_in_sieve(hashes, sieve)).tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([rows[i] for i in some], pa.int64()),
                        pa.array(hashes.view(np.int64)[some]),
                        pa.array([words[i].start() for i in some], pa.int64()),
                        pa.array([words[i].end() for i in some], pa.int64()),
                    ],
                    ["row", "hash", "start", "end"],
                )

    told = found.where(F.col("told").isNotNull()).select("row", "told", "base")
    return told.mapInArrow(run, "row long, hash long, start long, end long")


def _marked(docs: DataFrame, keys: list, id_col: str, text_col: str, window: int) -> DataFrame:
    """row, doc_id, the given keys, `base` and `spans` (kind, start, end) of every row."""
    limit_batches(docs)
    named = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("doc_id"),
        *keys,
        F.col(text_col).alias("text"),
    )
    found = written(_found(named, window), "entities")
    terms = _disclosing(named, found)
    kind = F.when(F.max("disclosure") >= REMOVE, "remove").otherwise("generalise").alias("kind")
    own = (
        found.select("row", F.explode("holds").alias("entity"))
        .join(terms, "entity")
        .groupBy("row", "hash")  # a word may reveal several entities
        .agg(kind)
        .join(_places(found, terms), ["row", "hash"])
        .groupBy("row")
        .agg(F.collect_list(F.struct("kind", "start", "end")).alias("terms"))
    )
    order = F.create_map(*[F.lit(x) for i, k in enumerate(ALL_KINDS) for x in (k, i)])

    def sorted_spans(column: str):
        ranked = F.transform(F.col(column), lambda s: F.struct(order[s["kind"]].alias("k"), s["start"], s["end"], s["kind"]))
        return F.transform(F.array_sort(ranked), lambda s: F.struct(s["kind"], s["start"], s["end"]))

    every = found.drop("near", "terms", "holds", "n_words", "told").join(own, "row", "left")
    spans_ = F.when(F.col("terms").isNull(), F.col("base")).otherwise(F.concat("base", "terms"))
    return every.withColumn("spans", spans_).select(
        *[c for c in every.columns if c not in ("base", "terms")],
        sorted_spans("base").alias("base"),
        sorted_spans("spans").alias("spans"),
    )


def find_private(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans of every row of `docs`.

    `spans` lists kind:start:end of all spans by kind (entities, then terms to generalise, then terms to remove)
    and start, in characters, the end not included; `base_sha256` is the hash of that list for entities alone.
    A term's occurrences count as far as none of their characters is part of an entity. Null and empty texts have
    no spans; texts are read whole, however long.
    Repeated rows are marked each, and count each; an empty table gives no rows; other columns are not read.
    """
    marked = _marked(docs, [], id_col, text_col, window)

    def listed(column: str):
        return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return marked.select(
        "doc_id", *map(count, KINDS), F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans")
    )


def sanitised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with entities replaced by their kind in brackets, terms to generalise by [year], [number], [name] or
    [word], and terms to remove by nothing; all other columns as they were. Rows that repeat come out once each."""
    first, second, marks = free_names(docs, "_first", "_second", "_marks")
    every = [F.col(f"`{c}`") for c in docs.columns]
    keys = row_keys(docs)
    named = [k.alias(name) for k, name in zip(keys, (first, second), strict=True)]
    marked = _marked(docs, named, id_col, text_col, WINDOW)
    spans_of = marked.where(F.size("spans") > 0).groupBy(first, second).agg(F.first("spans").alias(marks))

    @F.pandas_udf("string")
    def hide(text, spans_):
        import pandas as pd

        return pd.Series([_hidden(t, s) for t, s in zip(text, spans_, strict=True)], dtype=object)

    joined = docs.select("*", *named).join(spans_of, [first, second], "left")
    clean = F.when(F.col(marks).isNull(), F.col(text_col)).otherwise(hide(F.col(text_col), F.col(marks)))
    return joined.withColumn(text_col, clean).select(*every)


def _general(word: str) -> str:
    if word.isdigit():
        return "[year]" if len(word) == 4 and word[:2] in ("19", "20") else "[number]"
    return "[name]" if word[0].isupper() else "[word]"


def _hidden(text: str | None, marks) -> str | None:
    if marks is None or text is None:
        return text
    out, at = [], 0
    for kind, start, end in sorted(((m["kind"], m["start"], m["end"]) for m in marks), key=lambda m: (m[1], -m[2])):
        if start < at:
            at = max(at, end)
            continue
        hidden = {"remove": "", "generalise": _general(text[start:end])}
        out += [text[at:start], hidden.get(kind, f"[{kind}]")]
        at = end
    return "".join([*out, text[at:]])
