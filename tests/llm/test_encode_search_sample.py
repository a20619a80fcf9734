"""Chunk-reusing BPE, lexical search and importance resampling against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfcast.llm import chunk_bpe, importance_sampling, lexical_search
from shelfcast.llm.hashing import Crc, Lanes, xxh64

SCHEMA = "doc_id long, text string, lang string, source string, weight string, score string, `rank` string"
LOWER = {c: c + 32 for c in range(65, 91)}
PATH = public_tokenizers.path(chunk_bpe.VOCABULARY)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdefghijklm", k=rng.randint(1, 7))) for _ in range(120)]

    def some(n):
        return " ".join(rng.choices(words, k=n))

    shared = some(150)
    texts = [
        shared, shared, shared + "\n" + some(40), some(30) + " " + shared, some(4000), None, "", " \t\n", "12 34 !!", "x" * 7000,
        "Çé ß ǅ Σ \x0b 漢字 <|endoftext|>  double   spaces\n\n it's we'll <|endof", "漢字" * 800, "'" * 300 + "s", some(19), some(20),
        "A-b_C d\x00e f:g", "<|endoftext|><|endoftext|>", "a " * 900, *[some(rng.randint(1, 90)) for _ in range(60)],
    ]
    ids = [*range(len(texts))]
    ids[7], ids[12], ids[13] = None, None, 14  # null ids and a repeated one
    return [(i, t, "en", "s", "clash", "clash", "clash") for i, t in zip(ids, texts, strict=True)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def items(spark, rows):
    held = [(n, " ".join((rows[n % 18][1] or "none").split()[:25]), 1.0) for n in range(12)]
    held += [(None, "abc def", 2.0), (3, "zzzz nothing", 3.0), (40, "", 0.0), (41, None, 0.0), (42, "Ünbekannt 漢字", 0.0)]
    return spark.createDataFrame(held, "item_id long, text string, score double")


# -- hashing ------------------------------------------------------------------
def test_hashes_equal_the_libraries():
    rng = np.random.default_rng(1)
    buf = np.concatenate([rng.integers(0, 256, 5000, dtype=np.uint8), np.zeros(8, np.uint8)])
    length = np.concatenate([np.arange(0, 300), [4000]])
    start = np.concatenate([rng.integers(0, 4600, 300), [7]])
    data = buf.tobytes()
    got = xxh64(Lanes(buf), start, length)
    assert got.tolist() == [xxhash.xxh64_intdigest(data[a: a + n]) for a, n in zip(start, length, strict=True)]
    crc = Crc()
    a, b = [data[:n] for n in range(1, 40)], [data[100: 100 + 3 * n] for n in range(1, 40)]
    joined = crc.join(*(np.array([zlib.crc32(x) for x in side], np.uint32) for side in (a, b)), np.array([len(x) for x in b]))
    assert joined.tolist() == [zlib.crc32(x + y) for x, y in zip(a, b, strict=True)]


def test_gram_table_tells_equal_keys_apart():
    text = b"aa bb cc aa bb dd"
    buf = np.frombuffer(text + bytes(8), np.uint8)
    start, length = np.array([0, 3, 6, 9, 12, 15, 0, 9]), np.array([2, 2, 2, 2, 2, 2, 5, 5])
    table = importance_sampling.GramTable(Lanes(buf), start, length, key=np.full(8, 5, np.uint64))  # all keys collide
    assert table.slot[0] == table.slot[3] and table.slot[1] == table.slot[4] and table.slot[6] == table.slot[7]
    assert len(table.used) == 5 and sorted(table.count[table.used]) == [1, 1, 2, 2, 2]


# -- op11 ---------------------------------------------------------------------
def test_encoding_equals_the_library_and_decodes(docs, rows):
    lib = Tokenizer.from_file(PATH)
    got = chunk_bpe.decode(chunk_bpe.encode(docs, PATH), PATH).collect()
    have = collections.Counter((r.doc_id, tuple(r.ids), r.text) for r in got)
    want = collections.Counter()
    for doc_id, text, *_ in rows:
        ids = lib.encode(text or "", add_special_tokens=False).ids
        want[doc_id, tuple(ids), lib.decode(ids, skip_special_tokens=False)] += 1
    assert have == want


@pytest.mark.parametrize("bits", [8, 3, 1])
def test_any_cutting_agrees(monkeypatch, bits):
    monkeypatch.setattr(chunk_bpe, "BITS", bits)
    monkeypatch.setattr(chunk_bpe, "REMEMBERED", 20_000)
    rng = random.Random(bits)
    letters = ["a", "b", " ", "  ", "\n", "'", "'s", "'re", "1", "22", "é", "漢", "<|endoftext|>", "<|endof", "text|>", "\t", "!", "?)",
               " ", "　", "\x1c", "🙂", "Z", "word ", "and the "]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 300))) for _ in range(150)] + ["x" * 3000, " " * 900, "漢" * 700, ""]
    ids, count = chunk_bpe.ChunkEncoder(PATH).encode(texts)
    parts = np.split(ids, np.cumsum(count)[:-1])
    lib = Tokenizer.from_file(PATH)
    assert [p.tolist() for p in parts] == [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]


def test_chunks_are_encoded_once(monkeypatch):
    rng = random.Random(2)
    text = " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(3000))
    encoder, seen = chunk_bpe.ChunkEncoder(PATH), []
    plain = encoder.words.encode
    monkeypatch.setattr(encoder.words, "encode", lambda strings: seen.extend(strings) or plain(strings))
    encoder.encode([text, text[500:], "head " + text])
    assert sum(map(len, seen)) < 1.2 * len(text) and len(seen) == len(set(seen))
    before = len(seen)
    encoder.encode([text])
    assert len(seen) == before


def test_ids_beyond_utf8_decode_like_the_library(spark):
    lib = Tokenizer.from_file(PATH)
    single = [i for i, s in enumerate(chunk_bpe.token_bytes(PATH)) if len(s) == 1 and s[0] >= 0x80][:40]
    frame = spark.createDataFrame([(1, single), (2, []), (3, None), (4, [50256, *single[:3], 50256])], "doc_id long, ids array<int>")
    got = {r.doc_id: r.text for r in chunk_bpe.decode(frame, PATH).collect()}
    assert got == {1: lib.decode(single, skip_special_tokens=False), 2: "", 3: "",
                   4: lib.decode([50256, *single[:3], 50256], skip_special_tokens=False)}


# -- op12 ---------------------------------------------------------------------
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranked(rows, items, top):
    terms = [(d, collections.Counter(TERM.findall((t or "").translate(LOWER)))) for d, t, *_ in rows]
    n_docs, n_words = sum(1 for _, c in terms if c), sum(c.total() for _, c in terms)
    df = collections.Counter(t for _, c in terms for t in c)
    out = set()
    texts = {}
    for item, text, *_ in sorted(items, key=lambda r: (r[1] is None, r[1] or "")):
        texts.setdefault(item, text)
    for item, text in texts.items():
        wanted = set(TERM.findall((text or "").translate(LOWER)))
        scores = []
        for d, c in terms:
            n = c.total()
            m = 50 + 50 * n * n_docs // n_words if n else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                    for t in wanted if c[t])
            scores += [(-s, d is None, d)] if s > 0 else []
        out |= {(item, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:top])}
    return out


@pytest.mark.parametrize("limits", [{}, {"TILE_ITEMS": 3, "TILE_TERMS": 7, "SLAB_DOCS": 4}, {"ROUND_TERMS": 40, "SPREAD": 2},
                                    {"EXACT": 2**36}])
def test_search_equals_brute_force(monkeypatch, docs, rows, items, limits):
    for name, value in limits.items():
        monkeypatch.setattr(lexical_search, name, value)
    for top in (50, 4):
        got = lexical_search.search(docs, items, top).collect()
        assert {(r.item_id, r["rank"], r.doc_id, r.score) for r in got} == ranked(rows, items.collect(), top)
        assert len(got) == len({(r.item_id, r["rank"]) for r in got})
        if limits:
            break


def test_many_equal_scores_at_the_cut(spark):
    docs = spark.createDataFrame([(i, "same words here") for i in range(300)] + [(1000, "other")], "doc_id long, text string")
    got = lexical_search.search(docs.repartition(7), spark.createDataFrame([(1, "same")], "item_id long, text string")).collect()
    assert sorted((r["rank"], r.doc_id) for r in got) == [(i + 1, i) for i in range(50)]


def test_search_of_nothing(spark, docs, items):
    empty = spark.createDataFrame([], SCHEMA)
    assert lexical_search.search(empty, items).count() == 0
    assert lexical_search.search(docs, items.limit(0)).count() == 0


# -- op13 ---------------------------------------------------------------------
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    words = WORD.findall((text or "").translate(LOWER))
    return [" ".join(words[i: i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)], len(words)


def resampled(rows, target, percent):
    def bucket(f):
        return zlib.crc32(f.encode()) % 10_000

    own = [(d, *features(t)) for d, t, *_ in rows]
    s = collections.Counter(bucket(f) for _, fs, _ in own for f in fs)
    t = collections.Counter(bucket(f) for text in target for f in features(text)[0])
    S, T = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[k] + 1) * (S + 10_000) / ((s[k] + 1) * (T + 10_000)))) for k in range(10_000)]
    out = []
    for d, fs, n in own:
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        w = sum(gain[bucket(f)] for f in fs)
        out.append([d, len(fs), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = i + 1
    return collections.Counter(tuple(r[:5]) for r in out)


@pytest.mark.parametrize("block, percent", [(100_000, 5), (11, 40), (1, 100)])
def test_resampling_equals_brute_force(monkeypatch, docs, rows, items, block, percent):
    monkeypatch.setattr(importance_sampling, "BLOCK_WORDS", block)
    monkeypatch.setattr(importance_sampling.gram_blocks, "__defaults__", (block,))
    got = importance_sampling.resample(docs, items, percent).select("doc_id", "n_features", "weight", "score", "rank")
    assert collections.Counter(map(tuple, got.collect())) == resampled(rows, [r.text for r in items.collect()], percent)


def test_resampling_of_nothing(spark, docs, items):
    empty = spark.createDataFrame([], SCHEMA)
    assert importance_sampling.resample(empty, items).count() == 0
    got = importance_sampling.resample(docs, items.limit(0))
    assert got.count() == docs.count() and got.where(F.col("weight") > 0).count() >= 0


# -- the registered queries -----------------------------------------------------
def test_contract_columns(spark):
    from conftest import SF_SMALL

    got = {op.__name__: op(spark, SF_SMALL) for op in (
        chunk_bpe.op11_chunk_bpe, lexical_search.op12_lexical_search, importance_sampling.op13_importance_resampling)}
    assert [(f.name, f.dataType.simpleString()) for f in got["op11_chunk_bpe"].schema.fields] == [
        ("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    assert [(f.name, f.dataType.simpleString()) for f in got["op12_lexical_search"].schema.fields] == [
        ("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert {f.dataType.simpleString() for f in got["op13_importance_resampling"].schema.fields} == {"bigint"}
    lib = Tokenizer.from_file(PATH)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in got["op11_chunk_bpe"].collect():
        ids = lib.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()
