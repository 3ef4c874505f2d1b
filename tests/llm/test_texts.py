"""Operators 2, 3, 4, 8 and 10 on small texts: nulls, empty and long ones, ties, repeats, clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from dialoom.llm import privacy
from dialoom.llm.byte_bpe import Codec, decode_ids, encode_texts, read_ranks, round_trip_digests
from dialoom.llm.exact_dedup import drop_copies, find_copies
from dialoom.llm.id_shards import _rows, look_up, perfect_hash, read_documents, slots_of, write_ids
from dialoom.llm.pieces import Encoder, pieces_of, read_file, split_column, tokenizer
from dialoom.llm.token_counts import count_tokens
from dialoom.session import work_path

PATTERN = public_tokenizers.PATTERN
ASCII = {code: code + 32 for code in range(65, 91)}
BYTE_BPE, WORD_BPE = map(public_tokenizers.path, ("byte_bpe_50k.json", "word_bpe_49k.json"))


def odd_texts(n=200, seed=3):
    rnd = random.Random(seed)
    parts = [*"abcXYZ'stre  \n\t 0123!?$éñß世界́\xa0\x1c\x85　ΣİŐ", "<|endoftext|>", "'re", "   ", "\n\n", "<|startoftext|>"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 300))) for _ in range(n)]
    return [None, "", "a", *texts, "a" * 300, " " * 300, "a " * 200]


@pytest.fixture(scope="module")
def ranks():
    return read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, 0, "x") for i, t in enumerate(odd_texts())]
    return spark.createDataFrame(rows, "doc_id long, text string, ids int, row string")


def test_chunked_ids_are_those_of_whole_texts(odd, ranks):
    own = Codec(ranks, PATTERN)
    expected = {i: own.encoding.encode_ordinary(t or "") for i, t in enumerate(odd_texts())}
    for chunk, overlap in ((40, 16), (32_768, 512)):
        got = {r.doc_id: r.ids for r in encode_texts(odd, ranks, PATTERN, chunk=chunk, overlap=overlap).collect()}
        assert got == expected
    encoded = encode_texts(odd, ranks, PATTERN, chunk=64, overlap=32)
    assert {r.doc_id: bytes(r.bytes).decode() for r in decode_ids(encoded, ranks, PATTERN).collect()} == {
        i: t or "" for i, t in enumerate(odd_texts())
    }
    for r in round_trip_digests(encoded, ranks, PATTERN, with_ids=True).collect():
        assert r.ids == expected[r.doc_id] and r.n_tokens == len(r.ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, r.ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((odd_texts()[r.doc_id] or "").encode()).hexdigest()


def test_no_ids_of_an_empty_table(odd, ranks):
    assert encode_texts(odd.limit(0), ranks, PATTERN).collect() == []


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
def test_pieces_give_the_ids_of_whole_texts(path):
    encoder = Encoder(read_file(path), list)
    for text in filter(None, odd_texts(600, 8)):
        pieces = pieces_of(text)
        assert "".join(pieces) == text
        known = encoder.results(pieces)
        ids = tokenizer(read_file(path)).encode(text, add_special_tokens=False).ids
        assert [i for piece in pieces for i in known[piece]] == ids


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
def test_pieces_beside_marks_and_special_tokens(path):
    rnd = random.Random(5)
    parts = [*"abZ'sd  \n\t09!\"#$%&()*+,-./:;=?@[\\]^_`{|}~<>é世̸́\xa0 \x85€", "<|endoftext|>", "<|startoftext|>", "'re", "'s"]
    encoder = Encoder(read_file(path), list)
    for _ in range(1500):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 200)))
        pieces = pieces_of(text)
        known = encoder.results(pieces)
        ids = tokenizer(read_file(path)).encode(text, add_special_tokens=False).ids
        assert "".join(pieces) == text and [i for piece in pieces for i in known[piece]] == ids
    assert pieces_of("it is 3.14, (so)\xa0 <|endoftext|>") == ["it", " is", " 3", ".14", ",", " (so", ")\xa0 <|endoftext|>"]


def test_words_are_encoded_many_at_a_time(monkeypatch):
    encoder = Encoder(read_file(WORD_BPE), list)
    rng = random.Random(4)
    some = ["strasse", "Straße", "ﬁsh", "İst", "n\u0303", "Ångström", "日本", "ǅ", "ª", "ΟΔΟΣ", "\U0001d400", "e\u0301", "K", "\u0149", "st"]
    words = [f"{rng.choice(' ' + chr(10))}{''.join(rng.choices(['a', 'th', 'Re', 'é', *some], k=rng.randint(1, 6)))}" for _ in range(1500)]
    pieces = list(dict.fromkeys([*words, " it's", " 3", ".", "<|endoftext|>", " <|startoftext|>", "\u00a0a", " ", " a1", " x\x1cy"]))
    plain, asked = encoder.tokenizer, []

    class Counted:
        def encode_batch_fast(self, texts, **options):
            asked.extend(texts)
            return plain.encode_batch_fast(texts, **options)

    monkeypatch.setattr(encoder, "tokenizer", Counted())
    known = encoder.results([*pieces, *(f" {a}{b}" for a in "abcdefgh" for b in map(chr, range(97, 123)))])
    assert {p: known[p] for p in pieces} == {p: plain.encode(p, add_special_tokens=False).ids for p in pieces}
    assert known[" ab"] == plain.encode(" ab", add_special_tokens=False).ids
    asked.clear()
    encoder.results([f" {a}{b}x" for a in "abcdefgh" for b in map(chr, range(97, 123))])
    assert len(asked) == 4  # 208 words


def test_rows_of_pieces():
    split = split_column(pa.array([None, "a a", "", " a", None], pa.string()))
    assert split.pieces == ["a", " a"] and split.numbers.tolist() == [0, 1, 1] and split.rows.tolist() == [0, 0, 2, 2, 3, 3]
    none = split_column(pa.array([None, ""], pa.string()))
    assert none.pieces == [] and none.rows.tolist() == [0, 0, 0]


def test_rows_of_wide_and_narrow_ids():
    raw = [np.array(x, np.uint32).tobytes() for x in ([1, 2], [70_000], [2])]
    for numbers, rows, expected in (
        ([0, 2, 2], [0, 2, 3], [(2, [1, 2, 2]), (2, [2])]),
        ([0, 1, 2, 2], [0, 3, 4], [(4, [1, 2, 70_000, 2]), (2, [2])]),
    ):
        width, ids = (x.to_pylist() for x in _rows(raw, np.array(numbers), np.array(rows)))
        assert [(w, np.frombuffer(x, f"<u{w}").tolist()) for w, x in zip(width, ids, strict=True)] == expected


def test_token_counts(odd):
    own = Tokenizer.from_file(BYTE_BPE)
    for r in count_tokens(odd, BYTE_BPE, limit=100).collect():
        text = odd_texts()[r.doc_id] or ""
        n = len(own.encode(text, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 100)
    assert count_tokens(odd.limit(0), BYTE_BPE).collect() == []


def test_perfect_hash_is_minimal():
    keys = np.arange(50_000, dtype=np.uint64)
    assert sorted(slots_of(perfect_hash(keys), keys)) == list(range(50_000))
    assert len(perfect_hash(keys[:0]).levels) == 0


@pytest.mark.parametrize("shard_docs", [8192, 20])
def test_ids_are_written_and_found_again(spark, shard_docs):
    own = Tokenizer.from_file(WORD_BPE)
    rows = [(i * 3 - 30, t) for i, t in enumerate(odd_texts(60))]
    rows += [(None, "hello there"), (None, "zz"), (6, "again six"), (6, "again six"), (9, None)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, shard int")
    path = work_path(spark, "ids")
    write_ids(df, path, WORD_BPE, shard_docs=shard_docs)
    ids = [(i, own.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in rows]
    got = sorted(read_documents(spark, path).collect(), key=lambda r: r.start)

    def order(doc_id):
        return doc_id is not None, doc_id or 0

    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=order)
    assert [r.start for r in got] == list(np.cumsum([0, *(r.n_tokens for r in got)])[:-1])

    def content(doc_id, n, crc):
        return (*order(doc_id), n, crc)

    assert sorted(content(r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == sorted(
        content(i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in ids
    )
    asked = spark.createDataFrame([(-30,), (0,), (9,), (1,), (99_999,), (None,), (0,)], "k long")
    found = {r.key: r.ids for r in look_up(asked, path).collect()}
    assert set(found) == {-30, 0, 9}
    assert all(found[k] in [x for i, x in ids if i == k] for k in found)


def test_no_documents_no_shards(spark):
    path = work_path(spark, "ids")
    write_ids(spark.createDataFrame([], "doc_id long, text string"), path, WORD_BPE)
    assert read_documents(spark, path).collect() == []


def test_of_equal_texts_the_largest_id_stays(spark):
    rows = [(i, "Hot TEXT") for i in range(300)] + [(900, "Éa"), (901, "éa"), (902, "ÉA"), (903, None), (904, "")]
    rows += [(905, "tie"), (905, "tie"), (None, "tie"), (None, "alone"), (906, "x" * 100_000)]
    df = spark.createDataFrame([(*r, i, "d") for i, r in enumerate(rows)], "doc_id long, text string, kept int, _row string")
    marks = find_copies(df, counters=8).marks.collect()
    groups: dict = {}
    for doc_id, text in rows:
        groups.setdefault((text or "").translate(ASCII), []).append(doc_id)
    assert len(marks) == len(rows)
    by_text = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in marks:
        ids = by_text[r.text_sha256]
        assert r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
        assert not r.kept or r.doc_id == r.keep_id
    assert sum(r.kept for r in marks) == len(groups)
    kept = drop_copies(df, counters=8)
    assert kept.columns == df.columns
    assert sorted((r.text or "").translate(ASCII) for r in kept.collect()) == sorted(groups)
    assert find_copies(df.limit(0)).marks.collect() == [] and drop_copies(df.limit(0)).collect() == []


FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_entities(text):
    out = []
    for kind, form in FORMS.items():
        for m in re.finditer(form, text):
            digits = re.sub("[^0-9]", "", m[0])
            fits = {
                "email": True,
                "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True,
                "card": 13 <= len(digits) <= 19 and privacy.luhn(digits) if kind == "card" else True,
                "phone": 9 <= len(digits) <= 15,
            }
            if fits[kind]:
                out.append((kind, *m.span()))
    return out


def test_entities_are_those_of_the_plain_forms():
    rnd = random.Random(1)
    for _ in range(20_000):
        text = "".join(rnd.choice("ab@.1230+- ()é") for _ in range(rnd.randint(0, 40)))
        assert privacy.entities(text) == plain_entities(text)
    fixed = "a.b@c.de, é 4111 1111 1111 1111; +1 (988) 555-2485 at 10.0.0.256 or 10.0.0.25 or 0010.1.2.3"
    assert privacy.entities(fixed) == plain_entities(fixed) and len(plain_entities(fixed)) == 5


def test_terms_beside_an_entity_only_are_marked(spark):
    rows = [(i, f"common code{i % 2} contact bob mail joe@ex.com common") for i in range(20)]
    rows += [(100 + i, "clean common contact text") for i in range(50)] + [(None, None), (707, ""), (708, "9" * 50_000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, spans int")
    got = privacy.find_private(df).collect()
    assert len(got) == len(rows)
    marked = {r.doc_id: r.spans for r in got if r.spans}
    assert set(marked) == set(range(20))
    for doc_id, spans in marked.items():
        text = rows[doc_id][1]
        words = {text[int(s.split(":")[1]) : int(s.split(":")[2])] for s in spans.split(",")}
        assert {"joe@ex.com", "bob", "mail"} <= words and not {"common", "contact"} & words
    for r in got:
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in plain_entities(dict(rows)[r.doc_id] or ""))
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest() and r.spans.startswith(base)
    clean = {r.doc_id: r.text for r in privacy.sanitised(df).collect()}
    assert "[email]" in clean[0] and "bob" not in clean[0] and clean[100] == rows[20][1] and clean[None] is None
    assert privacy.find_private(df.limit(0)).collect() == [] and privacy.sanitised(df.limit(0)).collect() == []


def brute_private(rows):
    """All spans by doc_id, from counts over the whole corpus without blocks, bounds or sieves."""
    values, free, n_words, n, together, beside = {}, {}, 0, Counter(), Counter(), Counter()
    for doc_id, text in rows:
        found = plain_entities(text or "")
        every = list(re.finditer(privacy.TERM, text or ""))
        n_words += len(every)
        n.update(m[0].translate(ASCII) for m in every)
        free[doc_id] = [m for m in every if not any(a < m.end() and b > m.start() for _, a, b in found)]
        values[doc_id] = [(text[a:b].lower() if k == "email" else (k, re.sub("[^0-9]", "", text[a:b])), a) for k, a, b in found]
        for value, start in values[doc_id]:
            middle = sum(m.start() < start for m in free[doc_id])
            for m in free[doc_id][max(0, middle - privacy.WINDOW) : middle + privacy.WINDOW]:
                together[value, m[0].translate(ASCII)] += 1
                beside[value] += 1
    gain = {}
    for (value, term), k in together.items():
        p = min(beside[value] / n_words, 1 - 1e-9)
        gain[value, term] = math.log2(min((k + privacy.DRAWN * p) / (n[term] + privacy.DRAWN), 1) / p) / -math.log2(p)
    out = {}
    for doc_id, text in rows:
        spans = []
        for m in free[doc_id]:
            best = max((gain.get((v, m[0].translate(ASCII)), -9) for v, _ in values[doc_id]), default=-9)
            if best >= privacy.GENERALISE:
                spans.append(("remove" if best >= privacy.REMOVE else "generalise", *m.span()))
        spans = sorted(plain_entities(text or "") + spans, key=lambda s: (privacy.ALL_KINDS.index(s[0]), s[1]))
        out[doc_id] = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    return out


def test_disclosure_equals_plain_counts(spark, monkeypatch):
    rnd = random.Random(6)
    common = [f"w{i}" for i in range(30)]
    mentions = ["joe@ex.com", "ann@ex.org", "10.0.0.7", "4111 1111 1111 1111", "+1 (988) 555-2485"]
    rows = []
    for i in range(150):
        words = rnd.choices(common, k=rnd.randint(5, 40))
        for _ in range(rnd.choice([0, 0, 0, 1, 1, 2])):
            at = rnd.randrange(len(words))
            once = f"p{rnd.randrange(10**6)}@x.de"
            words[at:at] = [rnd.choice(["Secretary", "née", "w3", f"hint{rnd.randrange(40)}"]), rnd.choice([*mentions, once, once])]
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, f"one telling{i} word solo{i}@y.net and far " + "w1 " * 40 + f"Telling{i}") for i in range(30)]
    rows += [(2000, None), (2001, ""), (2002, "w1 " * 20_000 + "joe@ex.com née"), (2003, "joe@ex.com")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, hash string")
    expected = brute_private(rows)
    got = {r.doc_id: r.spans for r in privacy.find_private(df.repartition(3)).collect()}
    assert got == expected
    for i in range(1000, 1030):  # an entity seen once, and its telling word there and far away
        assert expected[i].count("remove") + expected[i].count("generalise") >= 2
    monkeypatch.setattr(privacy, "COUNTED", 4)
    assert {r.doc_id: r.spans for r in privacy.find_private(df).collect()} == expected
    clean = {r.doc_id: r.text for r in privacy.sanitised(df).collect()}
    assert "telling" not in clean[1000].lower() and "[email]" in clean[1000] and clean[2000] is None
