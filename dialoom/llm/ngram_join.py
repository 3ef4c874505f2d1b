"""Exact Jaccard join of documents on their sets of word n-grams, by groups of documents with equal prefixes.

1. Each text becomes the set of its n-gram hashes; texts of one set form a class, and only classes go on.
2. All n-grams are counted. They are ordered rare ones first, by a table of fixed size that holds the order of
   magnitude of the counts, and a table of bits, as large as the n-grams are many, that tells those of one text.
   Any fixed order gives the same links; this one keeps common passages out of the way.
3. In that order two linked sets share an n-gram of their prefixes and have sizes of a ratio of at least the
   threshold. Classes that meet so, directly or over others, form a cluster.
4. More texts meet by chance the more there are, so a cluster that is too large for one task is parted again: its
   n-grams are dealt out by hash to more parts than linked sets have differences, so that linked sets are equal in
   some part. Classes that meet in a part form the clusters within it.
5. The sets of a cluster are brought together once; a large cluster is dealt out as pairs of blocks of bounded
   size. In there, classes with identical prefixes and sizes are collapsed into a group, pairs of groups are
   filtered by size and by the positions of the prefix n-gram they share first, and the members of the
   remaining pairs are verified on their whole sets.
6. The verified links give the components.

Pairs live inside a task only; what leaves it is a spanning forest of its links, and counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialoom.llm.common import limit_batches, only_rows, text_bytes, text_slices, written
from dialoom.llm.components import components
from dialoom.llm.textbytes import LOWER, mixed, row_counts, span_hashes, words

WORDS = 3
PERCENT = 90
SLOT_BITS = 24
SINGLE_BITS = 30  # at most; 128 MB
MEMBER_BITS = 24
CELL_NGRAMS = 250_000


def ngram_sets(column: pa.Array, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of each text, in one array, and the offsets of the texts in it.

    Words are the longest runs without ASCII white space, after lower-casing A-Z. A text of fewer than n words,
    but at least one, has one hash for all of them.
    """
    data, offsets = text_bytes(column)
    data = LOWER[data]
    start, end = words(data, offsets)
    word = span_hashes(data, start, end)
    count = row_counts(start, offsets)
    first = np.cumsum(count) - count
    grams = np.maximum(count - n + 1, np.minimum(count, 1))
    of = np.repeat(np.arange(len(count)), grams)
    at = np.arange(len(of)) - np.repeat(np.cumsum(grams) - grams, grams) + first[of]
    size = np.minimum(count, n)[of]
    gram = mixed(size.astype(np.uint64))
    for i in range(n):
        within = i < size
        gram[within] = mixed(gram[within] * np.uint64(0x9FB21C651E98DF25) + word[at[within] + i])
    order = np.lexsort((gram, of))
    gram, of = gram[order], of[order]
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (of[1:] != of[:-1])
    sizes = np.bincount(of[new], minlength=len(count))
    return gram[new], np.concatenate([[0], np.cumsum(sizes)])


def set_keys(grams: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A key of 16 bytes for each set."""
    sizes = np.diff(offsets).astype(np.uint64)
    keys = np.zeros((len(sizes), 2), np.uint64)
    for i, salt in enumerate((0xA0761D6478BD642F, 0xE7037ED1A0B428DB)):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed(grams ^ np.uint64(salt)), dtype=np.uint64)])
        keys[:, i] = mixed(sums[offsets[1:]] - sums[offsets[:-1]] + sizes)
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(keys), [None, pa.py_buffer(keys.tobytes())])


def prefix_size(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """So many n-grams of a set of n are enough to meet those of any set that it links with."""
    return n - (percent * n + 99) // 100 + 1


def linked(inter: np.ndarray, n: int, m: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    return 100 * inter >= percent * (n + m - inter)


# ---- classes and counts


def _read(docs: DataFrame, n: int) -> DataFrame:
    """For each row its id, set size and set key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                grams, offsets = ngram_sets(part["text"], n)
                key = set_keys(grams, offsets).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["text_hash"], pa.array(np.diff(offsets)), key],
                    ["doc_id", "text_hash", "size", "cls"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, text_hash long, size long, cls binary")


def _counts(docs: DataFrame, n: int, shard_bits: int) -> DataFrame:
    """For each slice of rows the n-grams in it by shard: those it has once, and the others with how often."""

    def binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
        offsets = (ends * values.itemsize * (values.size // max(1, len(values)))).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values.tobytes())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.arange((1 << shard_bits) + 1)
        for batch in batches:
            for part in text_slices(batch, "text"):
                grams, _ = ngram_sets(part["text"], n)
                gram, times = np.unique(grams, return_counts=True)
                shard = gram >> np.uint64(64 - shard_bits)
                low = ((gram << np.uint64(shard_bits)) >> np.uint64(32)).astype(np.uint32)
                single = times == 1
                more = np.column_stack([low[~single], times[~single].astype(np.uint32)])
                out = [
                    pa.array(edges[:-1], pa.int32()),
                    binary(low[single], np.searchsorted(shard[single], edges)),
                    binary(more, np.searchsorted(shard[~single], edges)),
                ]
                some = pa.array(np.diff(np.searchsorted(shard, edges)) > 0)
                yield pa.RecordBatch.from_arrays(out, ["shard", "once", "more"]).filter(some)

    return docs.select("text").mapInArrow(run, "shard int, once binary, more binary")


def single_bits(ngrams: int) -> int:
    """The table of single n-grams has 2 to this power bits: some eight n-grams share one, up to SINGLE_BITS."""
    return max(SLOT_BITS, min(SINGLE_BITS, math.ceil(math.log2(ngrams / 8 + 1))))


def _magnitudes(counts: DataFrame, shard_bits: int, bits: int) -> tuple[bytes, bytes]:
    """For each slot of n-gram hashes, how often 2 goes into the count of its most frequent n-gram; for each of
    2 ** bits finer slots, one bit that tells whether any of its n-grams occurs more than once.

    The first has one byte for each of 2 ** SLOT_BITS slots, whatever the input.
    """
    inner, fine = 1 << (SLOT_BITS - shard_bits), 1 << (bits - shard_bits)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        once = np.frombuffer(b"".join(pdf["once"]), np.uint32)
        more = np.frombuffer(b"".join(pdf["more"]), np.uint32).reshape(-1, 2)
        gram = np.concatenate([once, more[:, 0]])
        times = np.concatenate([np.ones(len(once), np.int64), more[:, 1].astype(np.int64)])
        order = np.argsort(gram, kind="stable")
        gram, times = gram[order], times[order]
        start = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]])) if len(gram) else np.zeros(0, int)
        total = np.add.reduceat(times, start) if len(start) else np.zeros(0, np.int64)
        slots = np.zeros(inner, np.uint8)
        np.maximum.at(slots, gram[start] // (2**32 // inner), np.log2(total).astype(np.uint8))
        often = np.zeros(fine, bool)
        often[gram[start][total > 1] // (2**32 // fine)] = True
        shard, packed = [pdf["shard"].iloc[0]], [np.packbits(often, bitorder="little").tobytes()]
        return pd.DataFrame({"shard": shard, "slots": [slots.tobytes()], "often": packed})

    rows = counts.groupBy("shard").applyInPandas(run, "shard int, slots binary, often binary").collect()
    slots, often = bytearray(1 << SLOT_BITS), bytearray(1 << (bits - 3))
    for row in rows:
        slots[row.shard * inner : (row.shard + 1) * inner] = row.slots
        often[row.shard * fine // 8 : (row.shard + 1) * fine // 8] = row.often
    return bytes(slots), bytes(often)


def _prefixes(docs: DataFrame, n: int, percent: int, magnitudes: tuple[bytes, bytes], bits: int) -> DataFrame:
    """(cls, gram) of the prefix n-grams of each set that another text may have too."""
    sent = docs.sparkSession.sparkContext.broadcast(magnitudes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, more = (np.frombuffer(x, np.uint8) for x in sent.value)
        for batch in batches:
            for part in text_slices(batch, "text"):
                grams, offsets = ngram_sets(part["text"], n)
                size = np.diff(offsets)
                of = np.repeat(np.arange(len(size)), size)
                fine = (grams >> np.uint64(64 - bits)).astype(np.int64)
                often = slots[(grams >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]
                often = often * (more[fine >> 3] >> (fine & 7).astype(np.uint8) & 1)
                order = np.lexsort((grams, often, of))
                place = np.arange(len(grams)) - offsets[of]
                chosen = order[(place < prefix_size(size, percent)[of]) & (often[order] > 0)]
                yield pa.RecordBatch.from_arrays(
                    [
                        set_keys(grams, offsets).cast(pa.binary()).take(pa.array(of[chosen])),
                        pa.array(grams[chosen].view(np.int64)),
                    ],
                    ["cls", "gram"],
                )

    return docs.select("text").mapInArrow(run, "cls binary, gram long")


# ---- clusters


def _step_width(percent: int) -> float:
    return 100 / percent * 1.001


def _clusters(prefixes: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(node, label) of the classes that share a prefix n-gram with one of a fitting size.

    Sizes are put on a scale of steps a little wider than the ratio that links allow, so that two fitting sizes
    are at most one step apart; each class is entered under its own step and the next.
    """
    step = F.floor(F.log("size") / math.log(_step_width(percent)))
    met = prefixes.groupBy("gram").agg(F.min(F.xxhash64("cls")).alias("_one"), F.max(F.xxhash64("cls")).alias("_other"))
    shared = prefixes.join(met.where("_one <> _other").select("gram"), "gram").distinct()
    member = shared.join(classes.select("cls", "size", "node"), "cls").select(
        "gram", "node", F.explode(F.array(step, step + 1)).alias("step")
    )
    member = written(member, "members")
    centre = member.groupBy("gram", "step").agg(F.min("node").alias("b"), F.max("node").alias("_far"))
    star = member.join(centre.where("b <> _far").select("gram", "step", "b"), ["gram", "step"])
    return components(star.select(F.col("node").alias("a"), "b").where("a <> b").distinct())


def part_count(step: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """So many differences at most have two linked sets whose larger one is on the given step, and into so many
    parts are sets dealt there, some more, as parts may be empty."""
    largest = np.ceil(_step_width(percent) ** (step + 1.0) + 1)
    differences = np.floor(2 * largest * (100 - percent) / (100 + percent)).astype(np.int64)
    return differences, differences + differences // 8 + 3


def part_keys(
    grams: np.ndarray, offsets: np.ndarray, label: np.ndarray, step: np.ndarray, percent: int = PERCENT
) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the parts of each set, given its label and step, and the indices of the sets they belong to.

    Linked sets of one label, the larger one on the step, have a key in common: at least the parts that are more
    than the differences are equal. Those may all be empty only if both sets have so many empty parts; all such
    sets have one more key in common.
    """
    size = np.diff(offsets)
    differences, parts = part_count(step, percent)
    place = mixed(np.asarray(label).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + step.astype(np.uint64))
    of = np.repeat(np.arange(len(size)), size)
    hashed = mixed(grams ^ np.uint64(0x8CB92BA72F3D8DD7))
    part = (hashed >> np.uint64(32)) % parts[of].astype(np.uint64)
    at = of * (int(parts.max(initial=1)) + 1) + part.astype(np.int64)
    at, slot = np.unique(at, return_inverse=True)
    sums = np.zeros(len(at), np.uint64)
    np.add.at(sums, slot, mixed(hashed))
    owner, part = np.divmod(at, int(parts.max(initial=1)) + 1)
    keys = mixed(sums + mixed(place[owner] + part.astype(np.uint64)))
    weak = np.flatnonzero(parts - np.bincount(owner, minlength=len(size)) >= parts - differences)
    return np.concatenate([keys, mixed(place[weak])]), np.concatenate([owner, weak])


def _parted(docs: DataFrame, clusters: DataFrame, classes: DataFrame, n: int, percent: int) -> DataFrame:
    """`clusters`, those of more than CELL_NGRAMS n-grams parted into the classes that meet in a part of theirs."""
    sized = clusters.join(classes, "node")
    large = sized.groupBy("label").agg(F.sum("size").alias("_all")).where(F.col("_all") > CELL_NGRAMS).select("label")
    large = written(large, "large")
    if large.isEmpty():
        return clusters
    member = written(sized.join(large, "label").select("doc_id", "cls", "node", "label"), "large-members")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                grams, offsets = ngram_sets(part["text"], n)
                same = pc.equal(set_keys(grams, offsets).cast(pa.binary()), part["cls"])  # ids may repeat with other texts
                same = np.asarray(same) & (np.diff(offsets) > 0)
                node, label = np.asarray(part["node"]), np.asarray(part["label"])
                grams = grams[np.repeat(same, np.diff(offsets))]
                size = np.diff(offsets)[same]
                offsets = np.concatenate([[0], np.cumsum(size)])
                step = np.floor(np.log(size) / math.log(_step_width(percent))).astype(np.int64)
                for k in (0, 1):
                    keys, of = part_keys(grams, offsets, label[same], step + k, percent)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys.view(np.int64)), pa.array(node[same][of])], ["key", "node"]
                    )

    keys = _texts_of(docs, member).select("node", "label", "cls", "text").mapInArrow(run, "key long, node long")
    keys = written(keys, "keys")
    centre = keys.groupBy("key").agg(F.min("node").alias("b"), F.max("node").alias("_far"))
    star = keys.join(centre.where("b <> _far").select("key", "b"), "key")
    found = components(star.select(F.col("node").alias("a"), "b").where("a <> b").distinct())
    return written(clusters.join(large, "label", "left_anti").select("node", "label").unionByName(found), "clusters")


# ---- verification


def _texts_of(docs: DataFrame, member: DataFrame) -> DataFrame:
    """`member` with the texts of its `doc_id`, one row for each row of `docs` with that id.

    Most other texts go where they are read, by a bit map of the ids that has 2 ** MEMBER_BITS bits.
    """
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << MEMBER_BITS))
    word, place = F.shiftright(slot, 6), F.pmod(slot, F.lit(64)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place)
    bits = member.select(word.alias("_word"), bit.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    near = docs.select("doc_id", "text", word.alias("_word"), bit.alias("_bit")).join(F.broadcast(bits), "_word")
    near = near.where(F.col("_bits").bitwiseAND(F.col("_bit")) != 0).select(F.col("doc_id").alias("_id"), "text")
    return near.join(member, F.col("_id").eqNullSafe(F.col("doc_id")))


def verify(
    sets: list[np.ndarray], block: np.ndarray, across: bool, weight: np.ndarray, percent: int = PERCENT
) -> tuple[np.ndarray, np.ndarray]:
    """Links among `sets` (sorted hashes): for each set the smallest index it is joined to, and the weight of the
    sets it links with. With `across`, only pairs of different `block` count."""
    size = np.array([len(s) for s in sets])
    ends = np.cumsum(size)
    starts = ends - size
    _, token, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(times), np.int64)
    rank[np.argsort(times, kind="stable")] = np.arange(len(times))  # rare ones first
    token = rank[token]
    shared_from = int((times == 1).sum())  # the ranks below are those of tokens in one set

    groups: dict[tuple, list[int]] = {}
    for i in range(len(sets)):
        prefix = np.sort(token[starts[i] : ends[i]])[: prefix_size(size[i], percent)]
        groups.setdefault((size[i], prefix.tobytes()), []).append(i)
    order = sorted(groups, key=lambda g: g[0])
    group_size = np.array([g[0] for g in order])
    member_count = np.array([len(groups[g]) for g in order])
    member_start = np.cumsum(member_count) - member_count
    members = np.array([i for g in order for i in groups[g]])

    parent = list(range(len(sets)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links = np.zeros(len(sets), np.int64)
    inside = np.zeros(len(times), bool)
    index: dict[int, list[tuple[int, int]]] = {}
    for g, key in enumerate(order):
        n = int(key[0])
        prefix = np.frombuffer(key[1], np.int64)
        met: list[np.ndarray] = []
        for place, t in enumerate(prefix.tolist()):
            if t < shared_from:
                continue
            found = index.setdefault(t, [])
            if found:
                met.append(np.column_stack([np.array(found), np.full(len(found), place)]))
            found.append((g, place))
        own = np.array(groups[key])
        others = np.zeros(0, np.int64)
        if met:
            pairs = np.concatenate(met)
            _, first = np.unique(pairs[:, 0], return_index=True)  # the first shared n-gram of each pair of groups
            h, theirs, ours = pairs[first].T
            m = group_size[h]
            reach = np.minimum(n - ours, m - theirs)  # at most so many n-grams are shared
            h = h[(100 * m >= percent * n) & linked(reach, n, m, percent)]
            lengths = member_count[h]
            others = members[np.repeat(member_start[h] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())]
        for k, i in enumerate(own):
            against = np.concatenate([others, own[:k]]) if k else others
            if across:
                against = against[block[against] != block[i]]
            if not len(against):
                continue
            mine = token[starts[i] : ends[i]]
            inside[mine] = True
            lengths = size[against]
            offsets = np.cumsum(lengths) - lengths
            at = np.repeat(starts[against] - offsets, lengths) + np.arange(lengths.sum())
            inter = np.add.reduceat(inside[token[at]].astype(np.int64), offsets)
            inside[mine] = False
            for j in against[linked(inter, n, lengths, percent)].tolist():
                links[i] += weight[j]
                links[j] += weight[i]
                a, b = root(int(i)), root(j)
                parent[max(a, b)] = min(a, b)
    return np.array([root(i) for i in range(len(sets))]), links


def _verified(docs: DataFrame, clusters: DataFrame, classes: DataFrame, n: int, percent: int) -> DataFrame:
    """(node, up, links) of the classes that link: `up` is another class of their component or themselves."""
    sized = clusters.join(classes, "node")
    blocks = sized.groupBy("label").agg(F.ceil(F.sum("size") / CELL_NGRAMS).alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    member = (
        sized.join(blocks, "label")
        .withColumn("own", own)
        .select("doc_id", "cls", "node", "copies", "label", "blocks", "own")
    )

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                grams, offsets = ngram_sets(part["text"], n)
                keys = set_keys(grams, offsets).cast(pa.binary())
                same = pc.equal(keys, part["cls"])  # ids may repeat with other texts
                raw = pa.array([grams[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.binary())
                names = ["node", "copies", "label", "blocks", "own"]
                yield pa.RecordBatch.from_arrays([*(part[c] for c in names), raw], [*names, "grams"]).filter(same)

    brought = _texts_of(docs, written(member, "verified-members")).select("node", "copies", "label", "blocks", "own", "cls", "text").mapInArrow(
        sets, "node long, copies long, label long, blocks long, own long, grams binary"
    )
    every = F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)
    cells = brought.withColumn("other", F.explode(every)).select(
        "node",
        "copies",
        "own",
        "grams",
        "label",
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
    )

    def check(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("node").sort_values("node")
        node = pdf["node"].to_numpy()
        grams = [np.frombuffer(g, np.uint64) for g in pdf["grams"]]
        joined, links = verify(grams, pdf["own"].to_numpy(), key[1] != key[2], pdf["copies"].to_numpy(), percent)
        some = links > 0
        return pd.DataFrame({"node": node[some], "up": node[joined[some]], "links": links[some]})

    return cells.groupBy("label", "low", "high").applyInPandas(check, "node long, up long, links long")


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links and text_hash of every row of `docs`.

    Two rows link when 100 * intersection >= percent * union of their sets of n-grams; `component_id` is the
    smallest id reachable by links, and `n_links` the number of rows linked with. Rows without words link with
    nothing and have their own id. Rows that repeat link with each other; null ids are skipped when the
    smallest is taken. An empty table gives no rows; other columns are not read. Ids are numbers or texts.
    """
    limit_batches(docs)
    text = F.coalesce(F.col(text_col), F.lit(""))
    named = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    shard_bits = min(16, max(6, math.ceil(math.log2(named.count() / 4096 + 1))))
    rows = written(_read(named, n), "read")
    classes = rows.where("size > 0").groupBy("cls", "size").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "classes")

    bits = single_bits(rows.agg(F.sum("size")).first()[0] or 0)
    magnitudes = _magnitudes(_counts(named, n, shard_bits), shard_bits, bits)
    prefixes = written(_prefixes(named, n, percent, magnitudes, bits), "prefixes")
    clusters = _clusters(prefixes, classes, percent)
    clusters = _parted(named.select("doc_id", "text"), clusters, classes, n, percent)
    found = written(_verified(named.select("doc_id", "text"), clusters, classes, n, percent), "links")
    labels = components(found.select(F.col("node").alias("a"), F.col("up").alias("b")))

    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = joined.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    known = joined.join(smallest, "label").join(counts, "node", "left")
    known = known.select("cls", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    return rows.join(known, "cls", "left").select(
        "doc_id",
        F.col("size").alias("n_shingles"),
        F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("links", F.lit(0)).alias("n_links"),
        "text_hash",
    )


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """`docs` with the row of the smallest id of each component of `jaccard_components`, all columns as they were.

    Rows without words, among them null texts, stay each; of rows with the same id and text one stays; an empty
    table stays empty. Other columns may have any names.
    """
    marks = jaccard_components(docs, id_col, text_col, n, percent)
    first = marks.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    text = F.coalesce(F.col(text_col), F.lit(""))

    def key(doc_id, text_hash):
        return F.concat_ws(":", text_hash.cast("string"), doc_id.cast("string"))

    return only_rows(docs, key(F.col(id_col), F.xxhash64(text)), first.select(key(F.col("doc_id"), F.col("text_hash"))))
