"""Packing of tokenised documents into fixed-length sequences: shortest pack first over the length histogram.

Only the histogram of piece lengths (at most ``capacity`` counts) reaches the
driver. It is packed longest length first, each length into the packs with the
most room, as counts of packing patterns. The patterns then meet the pieces by
rank: the i-th piece of a length takes the i-th place for that length.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quaylake.llm.bpe import pattern, read_ranks, word_encoder
from quaylake.llm.common import materialize, vocabulary_path
from quaylake.llm.pretokens import ChunkTable, text_groups

# the rank file holds the same vocabulary as byte_bpe_50k.json
VOCABULARY = "byte_bpe_50k.tiktoken"
# its added tokens are only in the other file
TOKENIZER = "byte_bpe_50k.json"
CAPACITY = 1024
END_ID = 0
REMEMBERED_CHUNKS = 300_000
# characters whose ids are gathered at a time
TEXTS_AT_ONCE = 1 << 20
# rows that Spark's Parquet reader holds at a time; of 4096 texts, the default, one array takes up to 32 MB
READER_ROWS = 512
# tasks that add up counts of at most some thousand lengths or groups
COUNT_TASKS = 8
# the ranks and the chunk table of a Python worker, which its next tasks find filled
_kept: list = [None, None]
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def added_tokens(path: str | None = None) -> dict[str, int]:
    """Ids of the added tokens of a tokenizer file, which the library finds in a text before anything else."""
    with open(path or vocabulary_path(TOKENIZER), encoding="utf-8") as f:
        listed = json.load(f)["added_tokens"]
    for t in listed:
        if t["single_word"] or t["lstrip"] or t["rstrip"]:
            raise ValueError(f"added token {t['content']!r} takes more than its own text")
    return {t["content"]: t["id"] for t in listed}


def chunk_table(ranks: dict[bytes, int]) -> ChunkTable:
    """The worker's table for these ranks; another vocabulary starts a new one."""
    if _kept[0] is not ranks:
        import regex
        _kept[:] = ranks, ChunkTable(regex.compile(pattern()).findall, word_encoder(ranks), REMEMBERED_CHUNKS)
    return _kept[1]


def token_pieces(docs: DataFrame, ranks: dict[bytes, int], capacity: int = CAPACITY, end_id: int = END_ID,
                 include_ids: bool = False, added: dict[str, int] | None = None) -> DataFrame:
    """Tokenise every whole text, append ``end_id`` and cut it into pieces of at most ``capacity``.

    One row per piece: doc_id, start, length, ids_crc32, doc_tokens and, if asked
    for, the ``ids`` themselves. A null or empty text is the end id alone.
    Repeated rows and null ids give rows of their own. Texts are cut at the
    ``added`` tokens, the longest first, which keep their ids; without ``added``
    such a string is text like any other.
    """
    added = added or {}
    shared = docs.sparkSession.sparkContext.broadcast(ranks)  # the vocabulary file, under 1 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex
        table = chunk_table(shared.value)
        cut = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")")

        end = np.array([end_id], dtype=np.uint32)

        def parts(text: str) -> list[str]:
            """Texts at even places, added tokens between them."""
            return cut.split(text) if any(t in text for t in added) else [text]

        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for a, b in text_groups(texts, TEXTS_AT_ONCE):
                split = [parts(t) for t in texts[a:b]]
                flat, sizes = table.expand([t for p in split for t in p[::2]])
                sizes = iter(sizes.tolist())
                rows, lists, at = [], [], 0
                for key, p in zip(keys[a:b], split, strict=True):
                    n = next(sizes)
                    runs = [flat[at:at + n]]
                    at += n
                    for token in p[1::2]:
                        n = next(sizes)
                        runs += [np.array([added[token]], dtype=np.uint32), flat[at:at + n]]
                        at += n
                    ids = np.concatenate([*runs, end]).astype("<u4", copy=False)
                    n = len(ids) - 1
                    for start in range(0, n + 1, capacity):
                        piece = ids[start:start + capacity]
                        rows.append((key, start, len(piece), zlib.crc32(piece.tobytes()), n + 1))
                        if include_ids:
                            lists.append(piece.astype(np.int32))
                columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                if include_ids:
                    columns.append(pa.array(lists, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = PIECES + (", ids array<int>" if include_ids else "")
    names = [c.split()[0] for c in schema.split(", ")]
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Packing patterns (lengths in a pack) with counts for a histogram of lengths in 1..capacity.

    Lengths go longest first; pieces of a length fill the open packs with the most
    room while they fit, then open new ones. The number of patterns depends on the
    number of different lengths, not on the counts.
    """
    done: list[tuple[tuple[int, ...], int]] = []
    # open packs by the room they have left
    room: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} is not in 1..{capacity}")
        while left > 0:
            most = max((r for r, packs in room.items() if packs), default=0)
            if most < length:
                break
            packed, count = room[most].pop()
            used = min(count, left)
            if count > used:
                room[most].append((packed, count - used))
            room.setdefault(most - length, []).append((packed + (length,), used))
            left -= used
        # new packs take pieces of this length until none fits
        fit = capacity // length
        for n, count in ((fit, left // fit), (left % fit, 1)):
            if n and count and left:
                room.setdefault(capacity - n * length, []).append(((length,) * n, count))
    for packs in room.values():
        done += packs
    return done


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """Places in order of length, as runs: number of the first place, first sequence and offset.

    A run gives ``count`` pieces of one length the same offset in consecutive
    sequences.
    """
    runs: dict[int, list[tuple[int, int, int]]] = {}
    sequence = 0
    for packed, count in patterns:
        offset = 0
        for length in packed:
            runs.setdefault(length, []).append((sequence, offset, count))
            offset += length
        sequence += count
    first, sequences, offsets, at = [], [], [], 0
    for length in sorted(runs):
        for start, offset, count in runs[length]:
            first.append(at)
            sequences.append(start)
            offsets.append(offset)
            at += count
    return {"first": np.array(first, dtype=np.int64), "sequence": np.array(sequences, dtype=np.int64),
            "offset": np.array(offsets, dtype=np.int64)}


@contextmanager
def reader_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """What runs inside reads Parquet files in batches of ``rows``."""
    key = "spark.sql.parquet.columnarReaderBatchSize"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def counted(pieces: DataFrame, column: str) -> dict[int, int]:
    """Rows of each value of a column with few values."""
    counts = pieces.groupBy(column).agg(F.count("*").alias("n")).coalesce(COUNT_TASKS)
    return {r[column]: r["n"] for r in counts.collect()}


def grouped(pieces: DataFrame, histogram: dict[int, int], parts: int) -> DataFrame:
    """Add ``part``, a hash of the piece, and ``group``; groups follow each other by length, then by part.

    A length has as many groups as it has times the pieces of an even part, so
    there are at most ``parts`` groups more than lengths, and one length with a
    third of all pieces is spread over a third of them.
    """
    even = max(1, -(-sum(histogram.values()) // parts))
    count, first, at = [1], [0], 0
    for length in range(1, max(histogram, default=0) + 1):
        n = -(-histogram.get(length, 0) // even)
        count.append(n)
        first.append(at)
        at += n
    hashed = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(parts)))
    return hashed.withColumn("group", F.expr(f"array({', '.join(map(str, first))})[int(length)] + "
                                             f"part * array({', '.join(map(str, count))})[int(length)] div {parts}"))


def pack(pieces: DataFrame, capacity: int = CAPACITY, parts: int | None = None) -> DataFrame:
    """``pieces`` (written to the shared folder) with ``sequence_id`` and ``offset``.

    Every piece has a place; offsets in a sequence are gapless from 0. An empty
    input gives an empty result. Pieces are numbered group by group, and the
    counts of the groups before shift their numbers: no join and no task that
    holds a whole length. Broadcast are the runs, at most a few per pair of
    lengths, and the counts, about ``parts`` (four a shuffle partition), whatever
    the corpus size.
    """
    spark = pieces.sparkSession
    parts = parts or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    with reader_rows(spark, READER_ROWS):
        pieces = materialize(pieces, "pieces")
    histogram = counted(pieces, "length")
    places = slots(shortest_pack_first(histogram, capacity))
    split = grouped(pieces, histogram, parts)
    counts = counted(split, "group")
    sizes = np.array([counts.get(g, 0) for g in range(max(counts, default=-1) + 1)], dtype=np.int64)
    shared = spark.sparkContext.broadcast({**places, "before": np.cumsum(sizes) - sizes})
    columns = pieces.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        for batch in batches:
            group, number = (batch.column(len(columns) + i).to_numpy() for i in range(2))
            at = p["before"][group] + number
            run = np.searchsorted(p["first"], at, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], pa.array(p["sequence"][run] + at - p["first"][run], pa.int64()),
                 pa.array(p["offset"][run], pa.int64())], names=[*columns, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    number = F.row_number().over(Window.partitionBy("group").orderBy("part", "doc_id", "start", "ids_crc32")) - 1
    return (split.withColumn("number", number).select(*columns, "group", "number")
            .mapInArrow(place, f"{schema}, `sequence_id` bigint, `offset` bigint"))


def packed_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY,
                     added: dict[str, int] | None = None) -> DataFrame:
    ranks = read_ranks(path or vocabulary_path(VOCABULARY))
    return pack(token_pieces(docs, ranks, capacity, added=added), capacity)
