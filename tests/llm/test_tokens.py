"""BPE and packing against the tokenizer libraries, and packing's invariants."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from quaylake.llm import bpe, packing
from quaylake.llm.pretokens import ChunkTable, segments
from tokenizers import Tokenizer

from .conftest import tables


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path(bpe.VOCABULARY))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("all", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def expected(library, text):
    ids = library.encode_ordinary(text or "")
    return (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest())


def test_bpe_matches_library_on_documents_and_awkward_rows(spark, awkward, library):
    docs = tables(spark, "documents")[0].select("doc_id", "text").unionByName(awkward.select("doc_id", "text"))
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"])
                 for r in bpe.encoded_documents(spark, docs).collect())
    want = sorted((r["doc_id"] if r["doc_id"] is not None else -1, *expected(library, r["text"]))
                  for r in docs.collect())
    assert got == want


def test_bpe_blocks_and_buckets_do_not_matter(spark, ranks, library):
    texts = ["a  b", " lead", "trail ", "x\n\n y", "tab\tsep", "it's we'LL", "　　w", "aa " * 40]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = bpe.encode(docs, ranks, block_chars=10, buckets=3).collect()
    assert {r["doc_id"]: r["ids"] for r in got} == {i: library.encode_ordinary(t) for i, t in enumerate(texts)}


def test_bpe_of_an_empty_table_and_unknown_ids(spark, ranks):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encoded_documents(spark, empty).count() == 0
    lists = spark.createDataFrame([(1, [10**6, -1]), (2, []), (3, None)], "decoded long, ids array<int>")
    got = {r["k"]: r["decoded"] for r in bpe.decode(lists.withColumnRenamed("decoded", "k"), ranks).collect()}
    assert got == {1: "��".encode(), 2: b"", 3: None}


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab é'sl1 \n\t 　.,😀\x1c")), max_size=40))
def test_chunks_give_the_patterns_pretokens(text):
    import regex
    find_all = regex.compile(public_tokenizers.PATTERN).findall
    words = {}
    table = ChunkTable(find_all, lambda p: [words.setdefault(p, len(words))], 100)
    flat, sizes = table.expand([text, text])
    listed = list(words)
    assert [listed[i] for i in flat] == find_all(text) * 2 and sizes.tolist() == [len(find_all(text))] * 2
    # cutting a long text into segments changes nothing
    assert [p for s in segments(text, 3) for p in find_all(s)] == find_all(text)


def test_packing_pieces_and_sequences(spark, awkward):
    docs = tables(spark, "documents")[0].select("doc_id", "text").unionByName(
        awkward.where("doc_id IS NOT NULL AND doc_id <> 1").selectExpr("-doc_id AS doc_id", "text"))
    rows = packing.packed_documents(docs).collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(pieces) == set(texts)
    for doc_id, found in pieces.items():
        ids = np.array([*library.encode(texts[doc_id] or "", add_special_tokens=False).ids, 0], dtype="<u4")
        at = 0
        for r in sorted(found, key=lambda r: r["start"]):
            part = ids[at:at + r["length"]]
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(part.tobytes()))
            at += r["length"]
        assert at == len(ids)
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert sum(r["length"] for r in rows) > 0.95 * 1024 * (len(sequences) - 1)


def test_queries_find_added_tokens_like_the_library(spark, tmp_path):
    import corpus_pipeline
    from quaylake.llm.queries import QUERIES
    end = "<|endoftext|>"
    texts = [f"clean text {end} more", end, end * 3, f"a  {end}\n\n b {end}", f"{end}lead", "plain <|endoftext| >", "", None,
             f"word {end} " * 900]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for i, t in enumerate(texts):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        want += [(i, a, len(ids), zlib.crc32(ids[a:a + 1024].tobytes())) for a in range(0, len(ids), 1024)]
    for out in (QUERIES["op2_packing"](spark, str(tmp_path)), corpus_pipeline.pack(spark, docs, str(tmp_path))):
        assert sorted((r["doc_id"], r["start"], r["doc_tokens"], r["ids_crc32"]) for r in out.collect()) == want


def test_packing_repeated_rows_and_empty_table(spark, awkward):
    rows = packing.packed_documents(awkward).collect()
    assert sum(r["doc_id"] == 1 for r in rows) == 2 and sum(r["doc_id"] is None and r["length"] == 1 for r in rows) == 1
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows)
    assert packing.packed_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=12))
def test_patterns_use_every_length_once(histogram):
    patterns = packing.shortest_pack_first(histogram, 64)
    used = {}
    for pattern, count in patterns:
        assert count > 0 and sum(pattern) <= 64
        for length in pattern:
            used[length] = used.get(length, 0) + count
    assert used == histogram
    assert len(patterns) <= 4 * len(histogram) + 1


def test_a_batch_of_long_texts_is_cut_by_its_bytes(spark):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"size": [batch.nbytes]})
    texts = spark.range(0, 5000, 1, 1).select(F.expr("repeat('word ', 1000)").alias("text"))
    sizes = [r["size"] for r in texts.mapInArrow(run, "size long").collect()]
    assert sum(sizes) > 24_000_000 and max(sizes) < 6_000_000


def test_the_chunk_table_stays_with_its_vocabulary(spark):
    first, second = {bytes([i]): i for i in range(256)}, {bytes([i]): 255 - i for i in range(256)}
    docs = spark.createDataFrame([(i, "ab ba ab") for i in range(40)], "doc_id long, text string").repartition(8)
    table = packing.chunk_table(first)
    assert packing.chunk_table(first) is table and packing.chunk_table(second) is not table
    for ranks in (first, second, first):
        ids = packing.token_pieces(docs, ranks, include_ids=True).select("ids").distinct().collect()
        assert [r["ids"] for r in ids] == [[ranks[bytes([c])] for c in b"ab ba ab"] + [packing.END_ID]]


def test_packing_numbers_pieces_without_a_join_or_a_whole_length(spark, monkeypatch):
    pieces = spark.range(0, 4000, 1, 4).selectExpr(
        "id AS doc_id", "0L AS start", "IF(id < 3000, 1024L, id % 50 + 1) AS length", "id * 7919 % 4001 AS ids_crc32",
        "IF(id < 3000, 1024L, id % 50 + 1) AS doc_tokens")
    key, seen = "spark.sql.parquet.columnarReaderBatchSize", []
    write, before = packing.materialize, spark.conf.get(key)
    monkeypatch.setattr(packing, "materialize", lambda *a: seen.append(int(spark.conf.get(key))) or write(*a))
    packed = packing.pack(pieces, parts=32)
    # texts are read few at a time: batches of the default size take tens of MB of a task's heap
    assert seen == [packing.READER_ROWS] and seen[0] < int(before) == int(spark.conf.get(key))
    plan = packed._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1
    rows = packed.collect()
    assert len(rows) == 4000 and len({(r["sequence_id"], r["offset"]) for r in rows}) == 4000
    histogram = {1024: 3000, **dict.fromkeys(range(1, 51), 20)}
    split = packing.grouped(pieces, histogram, 32).collect()
    sizes = {}
    for r in split:
        sizes[r["group"]] = sizes.get(r["group"], 0) + 1
    assert len(sizes) <= 32 + len(histogram) and max(sizes.values()) <= 2 * 3000 // 24
    # places follow length, part and piece, as when one task numbers a length
    keys = ("part", "doc_id", "start", "ids_crc32")
    at = {r["doc_id"]: i for i, r in enumerate(sorted(split, key=lambda r: (r["length"], *(r[k] for k in keys))))}
    assert [r["group"] for r in sorted(split, key=lambda r: at[r["doc_id"]])] == sorted(r["group"] for r in split)
    full = sorted((r for r in rows if r["length"] == 1024), key=lambda r: r["sequence_id"])
    assert [r["doc_id"] for r in full] == sorted((r["doc_id"] for r in full), key=at.__getitem__)
