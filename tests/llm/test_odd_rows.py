"""Repeated ids, missing ids, tiny numbers, many sources and clashing columns."""

import collections
import math
import random
import time

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from shelfcast.llm import common, language_id, packing, passage_dedup, secret_scan, vector_search, wordcache
from shelfcast.llm.wordcache import WordCache


def test_a_repeated_query_has_each_neighbour_once(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(200)]
    vectors = spark.createDataFrame([*rows, (50, rows[50][1]), (50, rows[51][1])], "vec_id long, v array<double>")
    got = vector_search.nearest(vectors, vectors.where("vec_id % 50 = 0"))
    assert got.count() == 4 * 5 == got.select("query_id", "rank").distinct().count() == got.select("query_id", "vec_id").distinct().count()


def test_tiny_and_huge_components(spark):
    rows = [(0, [1e-170, 2e-170]), (1, [2e200, 4e200]), (2, [1.0, 2.1]), (3, [-1e-300, 5e-300]), (4, [1e-170, 2.2e-170])]
    vectors = spark.createDataFrame(rows, "vec_id long, v array<double>")
    got = [(r.vec_id, r.score) for r in vector_search.nearest(vectors, vectors.where("vec_id = 0")).orderBy("rank").collect()]
    assert [g[0] for g in got] == [1, 2, 4, 3] and abs(got[0][1] - 1) < 1e-12
    assert all(math.isfinite(s) for _, s in got)


def test_ordinary_vectors_score_as_before():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((300, 16)) * 3.7
    found = vector_search.search(x, np.arange(300), x[:7], np.arange(7))
    for q, v, c in found:
        assert c == (x[v] * x[q]).sum() / (np.sqrt((x[v] * x[v]).sum()) * math.sqrt((x[q] * x[q]).sum()))


def test_dense_secrets_take_time_in_proportion():
    rng = random.Random(1)

    def text(n):
        return " ".join(f"password={''.join(rng.choices('abcdef0123456789XYZ', k=30))} {''.join(rng.choices('ABCDEFGHJK23456789', k=34))}"
                        for _ in range(n))

    def seconds(n):
        t, start = text(n), time.process_time()
        base = secret_scan.base_spans(t)
        added = secret_scan.added_spans(t, base)
        assert added and not any(y[0] <= x[0] and x[2] <= y[2] for x in added[:50] for y in base[:200])
        return time.process_time() - start

    seconds(200)
    assert seconds(8000) < 10 * seconds(2000) + 0.5


def test_kept_spans_equal_comparing_all():
    rng = random.Random(2)
    for _ in range(200):
        spans = sorted((a := rng.randint(0, 60), 0, a + rng.randint(1, 12)) for _ in range(12))
        base = sorted((a := rng.randint(0, 60), 1, a + rng.randint(1, 25)) for _ in range(rng.randint(0, 8)))
        assert secret_scan._outside(spans, base) == [x for x in spans if not any(y[0] <= x[0] and x[2] <= y[2] for y in base)]


def test_rows_without_an_id_teach(spark):
    rng = random.Random(5)
    rows = [(None, lang, " ".join("".join(rng.choices(letters, k=5)) for _ in range(30)))
            for lang, letters in (("aa", "abcde"), ("bb", "vwxyz")) for _ in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(4)
    model = language_id.train(docs)
    assert sorted(model.langs) == ["aa", "bb"]
    found = language_id.identify(docs, model)
    assert found.where("__lang.lang_pred = lang").count() > 1980


def test_many_sources_spread_over_the_chunks(spark):
    docs = spark.createDataFrame([(i, "some words of a text " * 4, f"host{i}") for i in range(4000)],
                                 "doc_id long, text string, source string").repartition(8)
    pieces = packing.pack(docs, public_tokenizers.path(packing.VOCABULARY), chunk_ids=5000).cache()
    total = pieces.agg(F.sum("length")).first()[0]
    chunks = pieces.groupBy((F.col("sequence_id") / (1 << 20)).cast("long").alias("c")).agg(F.sum("length").alias("n"))
    sizes = [r.n for r in chunks.collect()]
    assert len(sizes) == round(total / 5000) and max(sizes) < 2 * total / len(sizes)
    assert pieces.select("doc_id").distinct().count() == 4000


def test_mix_stage_keeps_clashing_columns(spark):
    rows = [(i, "word " * (20 + i % 30), "ab"[i % 2], i, "x", "y", "z") for i in range(300)]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, source string, copies long, `__row` string, `__copy` string, `__of` string")
    out = corpus_pipeline.mix_sources(spark, docs, "")
    assert out.columns == docs.columns and out.count() > 0
    assert out.where("copies <> doc_id or `__row` <> 'x' or `__copy` <> 'y' or `__of` <> 'z'").count() == 0


def test_symbols_are_ranked_and_spans_merged_in_one_pass():
    rng = np.random.default_rng(4)
    for symbols, kind in ((3, np.uint8), (700, np.uint16)):
        bwt = rng.integers(0, symbols, 2000).astype(kind)
        symbol, place = rng.integers(0, symbols, 300), rng.integers(0, len(bwt) + 1, 300)
        got = passage_dedup._rank(bwt, symbol, place)
        assert got.tolist() == [int((bwt[:p] == s).sum()) for s, p in zip(symbol, place, strict=True)]
    segment, start = np.array([2, 2, 2, 5, 5, 7]), np.array([0, 10, 21, 21, 25, 3])
    assert [x.tolist() for x in passage_dedup._spans(segment, start, 10)] == [[2, 2, 5, 7], [0, 21, 21, 3], [20, 31, 35, 13]]
    assert [len(x) for x in passage_dedup._spans(segment[:0], start[:0], 10)] == [0, 0, 0]


def test_anchors_do_not_depend_on_kept_powers(monkeypatch):
    data = np.random.default_rng(6).integers(97, 103, 3000).astype(np.uint8)
    kept = passage_dedup.anchors(data)
    monkeypatch.setattr(passage_dedup, "KEPT_POWERS", 0)
    assert all(np.array_equal(a, b) for a, b in zip(kept, passage_dedup.anchors(data), strict=True))


def test_documents_are_encoded_slice_by_slice():
    """Of a batch of any size a worker holds the ids and words of one slice."""
    path = public_tokenizers.path(packing.VOCABULARY)
    texts = [f"The quick brown fox number {i} jumps. " * 3000 for i in range(30)] + [None, ""]
    sources = ["a" if i % 3 else None for i in range(len(texts))]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts)), pa.int64()), pa.array(texts), pa.array(sources)], names=["doc_id", "text", "source"])
    got = list(packing.encoded(iter([batch, batch]), path, 7))
    assert max(sum(len(texts[d] or "") for d in b["doc_id"].to_pylist()) for b in got) <= packing.SLICE_BYTES
    rows = pa.Table.from_batches(got).to_pylist()
    assert [r["row"] for r in rows] == list(range(2 * len(texts))) and {r["part"] for r in rows} == {7}
    tokenizer, before = Tokenizer.from_file(path), collections.Counter()
    for r, text, source in zip(rows, texts * 2, sources * 2, strict=True):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]
        assert np.frombuffer(r["ids"], "<u2").tolist() == ids and (r["source"], r["n"], r["before"]) == (source, len(ids), before[source])
        before[source] += len(ids)


def test_a_worker_gives_back_after_the_last_batch(monkeypatch):
    seen = []
    monkeypatch.setattr(common, "give_back", lambda: seen.append("given back"))
    for x in common.giving_back(lambda batches: (2 * b for b in batches))(iter([1, 2])):
        seen.append(x)
    assert seen == [2, 4, "given back"]


def test_stored_tables_send_python_small_batches(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    text = F.repeat(F.col("id").cast("string"), F.lit(20_000))
    sizes = spark.range(100, 600, 1, 1).select(text.alias("text")).mapInArrow(
        lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"]) for b in batches), "n long")
    got = [r.n for r in common.stored(sizes, "sizes").collect()]
    assert sum(got) > 5 * common.BATCH_BYTES and max(got) < 1.2 * common.BATCH_BYTES and spark.conf.get(key) == before


def test_remembered_pieces_are_copied_seldom():
    """Small slices of new words each copied all the ids met before."""
    encoder, arrays = WordCache(public_tokenizers.path(packing.VOCABULARY), False), []
    plain = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    for i in range(300):
        word = "".join(chr(97 + int(d)) for d in str(7919 * i))
        text = f"{word}x y{word} and {word}, 1{word}."
        assert encoder.encode([text])[0].tolist() == plain.encode(text, add_special_tokens=False).ids
        if not arrays or arrays[-1] is not encoder.flat:
            arrays.append(encoder.flat)
    assert len(arrays) < 20


def test_wide_space_is_told_as_by_the_regex_library():
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    got = pc.match_substring_regex(pa.array([c + c for c in points]), wordcache.WIDE_SPACE).to_pylist()
    assert got == [bool(regex.search(r"[\s\x1c-\x1f\x85]{2}", c + c)) for c in points]
    texts = ["a  b c", "plain words", "", None, "x\u3000\u3000y"]
    plain = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    got = WordCache(public_tokenizers.path(packing.VOCABULARY), False).encode(texts)
    assert [x.tolist() for x in got] == [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
