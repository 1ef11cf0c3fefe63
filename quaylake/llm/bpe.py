"""Byte-level BPE over a corpus: every distinct pre-token is encoded once.

Texts are split into pre-tokens in blocks of neighbouring documents. A block
keeps, for each position, the number of its pre-token in the block's own word
list; the word lists go, in hash buckets, through one global shuffle that
brings equal words together, where each distinct word is encoded once. The ids
go back to the blocks, and the documents are reassembled by position. What is
shuffled are word lists (each word once per block) and position codes, never
one row per pre-token.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaylake.llm.common import vocabulary_path
from quaylake.llm.pretokens import ChunkTable, gather, text_groups

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
BLOCK_CHARS = 8_000_000
UNKNOWN = "�".encode()
BLOCKS = ("block long, doc_ids array<bigint>, sizes array<bigint>, codes binary, n_words long, "
          "parts array<struct<bucket:int,words:binary>>")


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a tokenizer file: lines of base64 bytes and their rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


def word_encoder(ranks: dict[bytes, int]):
    """Encoder that takes its whole argument as one pre-token."""
    import tiktoken
    return tiktoken.Encoding("words", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def pack_ints(values: np.ndarray) -> bytes:
    """Compress integers below 2**32, one byte plane after another."""
    import zstandard
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def unpack_ints(data: bytes) -> np.ndarray:
    import zstandard
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel()


def pack_words(words: list[str]) -> bytes:
    import zstandard
    data = [w.encode() for w in words]
    sizes = pack_ints(np.array([len(w) for w in data], dtype=np.uint32))
    return len(sizes).to_bytes(4, "little") + sizes + zstandard.ZstdCompressor(level=9).compress(b"".join(data))


def unpack_words(data: bytes) -> list[bytes]:
    import zstandard
    n = int.from_bytes(data[:4], "little")
    ends = np.cumsum(unpack_ints(data[4:4 + n]).astype(np.int64))
    raw = zstandard.ZstdDecompressor().decompress(data[4 + n:])
    return [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def _word_blocks(buckets: int, block_chars: int):
    """Function that turns batches of (doc_id, text) into blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex
        import xxhash
        from pyspark import TaskContext

        find_all = regex.compile(pattern()).findall
        digest = xxhash.xxh3_64(str(TaskContext.get().partitionId()).encode())
        words: dict[str, int] = {}
        table = ChunkTable(find_all, lambda piece: [words.setdefault(piece, len(words))], 1 << 62)
        ids, sizes, flats, chars = [], [], [], 0

        def block() -> pa.RecordBatch:
            flat = np.concatenate(flats) if flats else np.zeros(0, dtype=np.uint32)
            # words in order of bucket, then alphabet (neighbours compress well); codes follow that order
            listed = list(words)
            bucket = np.array([xxhash.xxh3_64_intdigest(w) % buckets for w in listed], dtype=np.int64)
            order = np.array(sorted(range(len(listed)), key=listed.__getitem__), dtype=np.int64)
            order = order[np.argsort(bucket[order], kind="stable")]
            place = np.empty(len(order), dtype=np.uint32)
            place[order] = np.arange(len(order), dtype=np.uint32)
            parts = []
            for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(order) else []:
                parts.append({"bucket": int(bucket[part[0]]), "words": pack_words([listed[i] for i in part])})
            return pa.RecordBatch.from_pylist(
                [{"block": digest.intdigest() >> 1, "doc_ids": ids, "sizes": sizes,
                  "codes": pack_ints(place[flat] if len(flat) else flat), "n_words": len(listed), "parts": parts}],
                schema=pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                                  ("sizes", pa.list_(pa.int64())), ("codes", pa.binary()), ("n_words", pa.int64()),
                                  ("parts", pa.list_(pa.struct([("bucket", pa.int32()), ("words", pa.binary())])))]))

        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for a, b in text_groups(texts):
                flat, n = table.expand(texts[a:b])
                # a block is named by its partition and all its partition held so far
                for text in texts[a:b]:
                    digest.update(text.encode("utf-8", "replace"))
                    digest.update(b"\xff")
                ids += keys[a:b]
                sizes += n.tolist()
                flats.append(flat)
                chars += sum(map(len, texts[a:b]))
                if chars >= block_chars:
                    yield block()
                    words.clear()
                    table.reset()
                    ids, sizes, flats, chars = [], [], [], 0
        if ids:
            yield block()
    return run


def _word_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each word list of a block."""
    for batch in batches:
        blocks = batch.column(batch.schema.get_field_index("block"))
        parts = batch.column(batch.schema.get_field_index("parts"))
        owner = pc.list_parent_indices(parts)
        part = pc.list_flatten(parts)
        yield pa.RecordBatch.from_arrays([blocks.take(owner), pc.struct_field(part, "bucket"),
                                          pc.struct_field(part, "words")], names=["block", "bucket", "words"])


def _encode_words(ranks):
    """Function that encodes the word lists of a bucket, each distinct word once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_encoder(ranks.value)
        current, known = None, {}
        for batch in batches:
            out = []
            for block, bucket, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != current:
                    current, known = bucket, {}
                runs = []
                for w in unpack_words(words):
                    run_ = known.get(w)
                    if run_ is None:
                        run_ = known[w] = encode(w.decode())
                    runs.append(run_)
                flat = np.array([i for r in runs for i in r], dtype=np.uint32)
                out.append((block, bucket, pack_ints(np.array([len(r) for r in runs], dtype=np.uint32)),
                            pack_ints(flat)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int32()),
                 pa.array([r[2] for r in out], pa.binary()), pa.array([r[3] for r in out], pa.binary())],
                names=["block", "bucket", "sizes", "ids"])
    return run


def _reassemble(blocks: pa.Table, encoded: pa.Table) -> pa.Table:
    """Ids of a block's documents, from its position codes and its encoded words."""
    keys, out = [], []
    for row in blocks.to_pylist():
        parts = sorted(encoded.to_pylist(), key=lambda r: r["bucket"])
        sizes = np.concatenate([unpack_ints(p["sizes"]) for p in parts] or [np.zeros(0, np.uint32)]).astype(np.int64)
        flat = np.concatenate([unpack_ints(p["ids"]) for p in parts] or [np.zeros(0, np.uint32)])
        if len(sizes) != row["n_words"]:
            raise ValueError(f"block {row['block']}: {len(sizes)} of {row['n_words']} words came back; "
                             "the input changed between two reads")
        starts = np.cumsum(sizes) - sizes
        codes = unpack_ints(row["codes"]).astype(np.int64)
        ids = gather(flat, starts, sizes, codes)
        # tokens of each position, summed over each document's positions
        ends = np.concatenate(([0], np.cumsum(sizes[codes])))
        offsets = ends[np.concatenate(([0], np.cumsum(np.array(row["sizes"], dtype=np.int64))))]
        keys += row["doc_ids"]
        out.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.astype(np.int32))))
    return pa.table({"doc_id": pa.array(keys, pa.int64()),
                     "ids": pa.concat_arrays(out) if out else pa.array([], pa.list_(pa.int32()))})


def encode(docs: DataFrame, ranks: dict[bytes, int], block_chars: int = BLOCK_CHARS,
           buckets: int | None = None) -> DataFrame:
    """(doc_id, ids) for every document: its token ids, without special tokens.

    A null or empty text has no ids; null and repeated doc_ids keep one result
    row per input row; other columns are not carried. ``block_chars`` bounds what
    a task holds (a longer single text is a block of its own), ``buckets`` the
    distinct words of an encoding task: with n buckets each holds about 1/n of
    the corpus vocabulary. A word meets its copies once per block, however often
    it occurs.
    """
    spark = docs.sparkSession
    if buckets is None:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = spark.sparkContext.broadcast(ranks)  # the vocabulary file, under 1 MB
    # both uses of the blocks read this one exchange, which the last step needs anyway
    blocks = (docs.select(F.col("doc_id").cast("long"), "text")
              .mapInArrow(_word_blocks(buckets, block_chars), BLOCKS).repartition("block"))
    words = blocks.mapInArrow(_word_lists, "block long, bucket int, words binary")
    encoded = (words.repartition("bucket").sortWithinPartitions("bucket")
               .mapInArrow(_encode_words(shared), "block long, bucket int, sizes binary, ids binary"))
    return (blocks.groupBy("block").cogroup(encoded.groupBy("block"))
            .applyInArrow(_reassemble, "doc_id long, ids array<int>"))


def decode(encoded: DataFrame, ranks: dict[bytes, int], ids: str = "ids") -> DataFrame:
    """Replace the id lists by ``decoded``, the bytes they stand for; other columns are kept.

    The token-byte table joins in the tasks: its size is that of the vocabulary
    file. A null list decodes to null, an empty one to no bytes, an id without an
    entry to the bytes of the replacement character.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)
    kept = [c for c in encoded.columns if c not in (ids, "decoded")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = max(shared.value.values(), default=-1) + 1
        by_id = np.full(size + 1, UNKNOWN, dtype=object)
        for token, rank in shared.value.items():
            by_id[rank] = token
        for batch in batches:
            lists = batch.column(len(kept))
            offsets = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False)
            flat = np.where((flat >= 0) & (flat < size), flat, size).astype(np.int64)
            valid = lists.is_valid().to_pylist()
            out = [b"".join(by_id[flat[a:b]]) if ok else None
                   for a, b, ok in zip(offsets[:-1], offsets[1:], valid, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], pa.array(out, pa.binary())],
                                             names=[*kept, "decoded"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.select(*kept).schema)
    return encoded.select(*kept, ids).mapInArrow(run, f"{schema}, decoded binary")


def encoded_documents(spark: SparkSession, docs: DataFrame, path: str | None = None) -> DataFrame:
    """Digests of every document's ids and of the bytes they decode to."""
    ranks = read_ranks(path or vocabulary_path(VOCABULARY))
    listed = encode(docs, ranks)
    digest = listed.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), "ids")
    return decode(digest, ranks).select("doc_id", "n_tokens", "ids_sha256",
                                        F.sha2("decoded", 256).alias("decoded_sha256"))
