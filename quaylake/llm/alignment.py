"""Alignment of two tokenizers over a corpus.

Both sides encode the same bytes, so tokens are intervals of byte offsets. Per
batch of documents ``pandas.merge_asof``, keyed by document, finds for every
token start the token of the other side that covers it. The union of both
directions is the overlaps; where a token and its covering token start at the
same byte, both sides ended there, and a group of tokens begins.

How many documents link an id pair is counted over the corpus. Blocks of
documents list each of their pairs once; the lists meet in one shuffle by pair,
and the totals return to the blocks, so what is shuffled is a pair a block and
never a link a document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quaylake.llm.bpe import pack_ints, pattern, read_ranks, unpack_ints, word_encoder
from quaylake.llm.common import materialize, vocabulary_path
from quaylake.llm.pretokens import text_groups

# the rank file holds the same vocabulary as byte_bpe_50k.json, without its special token
LEFT = "byte_bpe_50k.tiktoken"
RIGHT = "piece_bpe_32k.model"
# ids of both sides fit into one non-negative integer of 32 bits
RIGHT_BITS = 15
BATCH_CHARS = 1 << 20
BLOCK_CHARS = 8_000_000
# links of a larger group are counted by distinct ids instead of one by one
LARGE_GROUP = 1 << 14
BLOCK = ("block long, doc_ids array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, "
         "n_links array<bigint>, groups_sha256 array<string>, sizes array<bigint>, places binary, times binary, "
         "pairs array<int>, n_docs array<int>")


@dataclass(frozen=True)
class Side:
    """One tokenizer: texts to lists of ids, and the bytes of every id."""

    encode: Callable[[list[str]], list[list[int]]]
    token_bytes: list[bytes]


def byte_level_side(path: str | None = None) -> Side:
    """Byte-level BPE of a rank file over a space and the text; special tokens are plain text."""
    import regex
    import tiktoken
    ranks = read_ranks(path or vocabulary_path(LEFT))
    encoding = tiktoken.Encoding("left", pat_str=pattern(), mergeable_ranks=ranks, special_tokens={})
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    # the library's own splitting overflows its stack on very long runs of white space
    long_run, find_all, one_word = regex.compile(r"\s{4096}"), regex.compile(pattern()).findall, word_encoder(ranks)

    def encode(text: str) -> list[int]:
        if len(text) >= 4096 and long_run.search(text):
            return list(chain.from_iterable(map(one_word, find_all(" " + text))))
        return encoding.encode_ordinary(" " + text)

    return Side(lambda texts: list(map(encode, texts)), table)


def piece_side(path: str | None = None) -> Side:
    """Pieces with byte fallback; the library adds the space itself."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path or vocabulary_path(RIGHT))
    table = [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i)
             else model.id_to_piece(i).replace("▁", " ").encode() for i in range(model.get_piece_size())]
    return Side(lambda texts: model.encode(texts, num_threads=1), table)


def token_frame(ids: list[list[int]], widths: np.ndarray):
    """One row per token: document, byte range (documents one after another), id and place."""
    import pandas as pd
    sizes = np.array([len(x) for x in ids], dtype=np.int64)
    flat = np.fromiter(chain.from_iterable(ids), dtype=np.int64, count=int(sizes.sum()))
    ends = np.cumsum(widths[flat])
    return pd.DataFrame({"doc": np.repeat(np.arange(len(ids)), sizes), "start": ends - widths[flat], "end": ends,
                         "id": flat, "place": np.arange(len(flat))})


def covering(tokens, other):
    """``tokens`` with ``other_place`` and ``other_start`` of the other side's token at each token's first byte."""
    import pandas as pd
    right = other[["doc", "start", "place"]].rename(columns={"place": "other_place"})
    right["other_start"] = right["start"]
    return pd.merge_asof(tokens, right, on="start", by="doc")


def overlaps(a, b):
    """(doc, a_place, b_place) of all tokens that share a byte, from ``covering`` in both directions."""
    import pandas as pd
    from_a = a[["doc", "place", "other_place"]].set_axis(["doc", "a_place", "b_place"], axis=1)
    from_b = b[["doc", "other_place", "place"]].set_axis(["doc", "a_place", "b_place"], axis=1)
    return pd.concat([from_a, from_b]).drop_duplicates().sort_values(["a_place", "b_place"], ignore_index=True)


def aligned(left: list[list[int]], right: list[list[int]], widths_a: np.ndarray, widths_b: np.ndarray):
    """Token frames of both sides with ``group``, the number of the group over all documents."""
    a, b = token_frame(left, widths_a), token_frame(right, widths_b)
    a, b = covering(a, b), covering(b, a)
    for tokens in (a, b):
        tokens["group"] = np.cumsum(tokens["start"].to_numpy() == tokens["other_start"].to_numpy()) - 1
    return a, b


def linked_pairs(a, b, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links of every document: (document of pair, pair, times, groups a document, links a document).

    Pairs are distinct in a document and come in order of document and pair.
    """
    ga, gb = a["group"].to_numpy(), b["group"].to_numpy()
    ids_a, ids_b = a["id"].to_numpy(), b["id"].to_numpy()
    docs = a["doc"].to_numpy()
    n_groups = int(ga[-1]) + 1 if len(ga) else 0
    na, nb = np.bincount(ga, minlength=n_groups), np.bincount(gb, minlength=n_groups)
    first_a, first_b = np.cumsum(na) - na, np.cumsum(nb) - nb
    doc_of = docs[first_a]
    links = na * nb
    small = links <= LARGE_GROUP

    mine = np.flatnonzero(small[ga])
    reps = nb[ga[mine]]
    within = np.arange(int(reps.sum()), dtype=np.int64) - np.repeat(np.cumsum(reps) - reps, reps)
    other = np.repeat(first_b[ga[mine]], reps) + within
    keys = [(np.repeat(docs[mine], reps) << 31) | (np.repeat(ids_a[mine], reps) << RIGHT_BITS) | ids_b[other]]
    keys[0], counts = np.unique(keys[0], return_counts=True)
    times = [counts.astype(np.int64)]
    for g in np.flatnonzero(~small):
        x, nx = np.unique(ids_a[first_a[g]:first_a[g] + na[g]], return_counts=True)
        y, ny = np.unique(ids_b[first_b[g]:first_b[g] + nb[g]], return_counts=True)
        keys.append(((doc_of[g] << 31) | (x[:, None] << RIGHT_BITS) | y[None, :]).ravel())
        times.append((nx[:, None] * ny[None, :]).ravel())
    if len(keys) > 1:
        key, place = np.unique(np.concatenate(keys), return_inverse=True)
        time = np.zeros(len(key), dtype=np.int64)
        np.add.at(time, place, np.concatenate(times))
    else:
        key, time = keys[0], times[0]
    per_doc = np.zeros(n_docs, dtype=np.int64)
    np.add.at(per_doc, doc_of, links)
    return key >> 31, key & ((1 << 31) - 1), time, np.bincount(doc_of, minlength=n_docs), per_doc


def group_texts(a, b, sizes: np.ndarray, strings: list[str], shift: int) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` for every document; ``sizes`` are its tokens on both sides together.

    ``strings`` has, for ids of the left side then of the right (from ``shift``), the
    text inside a group and at its end.
    """
    ga, gb = a["group"].to_numpy(), b["group"].to_numpy()
    na, nb = np.bincount(ga), np.bincount(gb)
    last_a, last_b = np.cumsum(na), np.cumsum(nb)
    place_a, place_b = np.arange(len(ga)), np.arange(len(gb))
    order = np.empty(len(ga) + len(gb), dtype=np.int64)
    order[place_a + (last_b - nb)[ga]] = 2 * a["id"].to_numpy() + (place_a + 1 == last_a[ga])
    order[place_b + last_a[gb]] = 2 * (shift + b["id"].to_numpy()) + (place_b + 1 == last_b[gb])
    out, at = [], 0
    for n in sizes.tolist():
        out.append("".join(map(strings.__getitem__, order[at:at + n].tolist()))[:-1])
        at += n
    return out


def aligned_blocks(docs: DataFrame, left: Callable[[], Side], right: Callable[[], Side],
                   block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Blocks of documents with their counts, the pairs they link and how many documents link each.

    Row ``i`` of a block has ``sizes[i]`` pairs; ``places`` says which of ``pairs`` and
    ``times`` how often. The block's number holds only for rows that were written.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        a_side, b_side = left(), right()
        widths_a = np.array([len(t) for t in a_side.token_bytes], dtype=np.int64)
        widths_b = np.array([len(t) for t in b_side.token_bytes], dtype=np.int64)
        if len(widths_b) > 1 << RIGHT_BITS or len(widths_a) > 1 << (31 - RIGHT_BITS):
            raise ValueError("a vocabulary is too large for the pair code")
        strings = [s for n, end in ((len(widths_a), "|"), (len(widths_b), ";"))
                   for i in range(n) for s in (f"{i},", f"{i}{end}")]
        number = TaskContext.get().partitionId() << 32
        rows, held, chars = [], [], 0

        def whole(ids: list[int], side: Side, data: bytes) -> bool:
            return b"".join(map(side.token_bytes.__getitem__, ids)) == data

        def align(keys: list, texts: list[str]) -> None:
            ids_a, ids_b = a_side.encode(texts), b_side.encode(texts)
            for i, text in enumerate(texts):
                data = b" " + text.encode()
                if not text or not whole(ids_a[i], a_side, data) or not whole(ids_b[i], b_side, data):
                    ids_a[i], ids_b[i] = [], []
            n_a, n_b = (np.array([len(x) for x in ids], dtype=np.int64) for ids in (ids_a, ids_b))
            a, b = aligned(ids_a, ids_b, widths_a, widths_b)
            doc, pair, times, n_groups, n_links = linked_pairs(a, b, len(texts))
            digests = [hashlib.sha256(s.encode()).hexdigest() if s else ""
                       for s in group_texts(a, b, n_a + n_b, strings, len(widths_a))]
            rows.append((keys, n_a, n_b, n_groups, n_links, digests, np.bincount(doc, minlength=len(texts))))
            held.append((pair, times))

        def block() -> pa.RecordBatch:
            joined = [sum((list(r[i]) for r in rows), []) for i in range(7)]
            every = np.concatenate([p for p, _ in held])
            pairs, places, n_docs = np.unique(every, return_inverse=True, return_counts=True)
            return pa.RecordBatch.from_pydict(
                {"block": [number], **{name: [column] for name, column in zip(
                    ("doc_ids", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "sizes"), joined, strict=True)},
                 "places": [pack_ints(places)], "times": [pack_ints(np.concatenate([t for _, t in held]))],
                 "pairs": [pairs], "n_docs": [n_docs]}, schema=schema)

        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for at, end in text_groups(texts, BATCH_CHARS):
                align(keys[at:end], texts[at:end])
                chars += sum(map(len, texts[at:end]))
                if chars >= block_chars:
                    yield block()
                    rows.clear()
                    held.clear()
                    number, chars = number + 1, 0
        if rows:
            yield block()

    longs = pa.list_(pa.int64())
    schema = pa.schema([("block", pa.int64()), ("doc_ids", longs), ("n_a", longs), ("n_b", longs),
                        ("n_groups", longs), ("n_links", longs), ("groups_sha256", pa.list_(pa.string())),
                        ("sizes", longs), ("places", pa.binary()), ("times", pa.binary()),
                        ("pairs", pa.list_(pa.int32())), ("n_docs", pa.list_(pa.int32()))])
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, BLOCK)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, a, b, n_docs, best): every linked id pair, in how many documents, and whether its ``a`` has none above.

    An ``a`` has at most as many pairs as the other vocabulary has ids, so its window is bounded.
    """
    listed = blocks.select(F.explode(F.arrays_zip("pairs", "n_docs")).alias("x")).select("x.pairs", "x.n_docs")
    total = listed.groupBy(F.col("pairs").alias("pair")).agg(F.sum("n_docs").alias("n_docs"))
    a = F.shiftright("pair", RIGHT_BITS)
    best = F.col("n_docs") == F.max("n_docs").over(Window.partitionBy("a"))
    return (total.withColumn("a", a).withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << RIGHT_BITS) - 1)))
            .withColumn("best", best).select("pair", "a", "b", "n_docs", "best"))


def _per_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of blocks whose pairs came back as ``found`` (place, n_docs, best)."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(k).slice(i, 1) for k, name in enumerate(batch.schema.names)}
            found = row["found"].flatten()
            place = found.field("place").to_numpy()
            count, best = (np.zeros(len(place), dtype=np.int64) for _ in range(2))
            count[place] = found.field("n_docs").to_numpy()
            best[place] = found.field("best").to_numpy(zero_copy_only=False)
            places = unpack_ints(row["places"][0].as_py())
            times = unpack_ints(row["times"][0].as_py()).astype(np.int64)
            sizes = row["sizes"].flatten().to_numpy()
            ends = np.cumsum(sizes)
            columns = {}
            for name, value in (("n_best", best), ("count_sum", count)):
                run = np.concatenate(([0], np.cumsum(value[places] * times)))
                columns[name] = pa.array(run[ends] - run[ends - sizes], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [row[n].flatten() for n in ("doc_ids", "n_a", "n_b", "n_groups", "n_links")]
                + [columns["n_best"], columns["count_sum"], row["groups_sha256"].flatten()],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])


def document_links(blocks: DataFrame) -> DataFrame:
    """One row per document from ``aligned_blocks`` that were written to the shared folder."""
    totals = pair_counts(blocks).select("pair", "n_docs", "best")
    listed = blocks.select("block", F.posexplode("pairs").alias("place", "pair"))
    back = (listed.join(totals, "pair").groupBy("block")
            .agg(F.collect_list(F.struct("place", "n_docs", "best")).alias("found")))
    none = F.array().cast("array<struct<place:int,n_docs:bigint,best:boolean>>")
    return (blocks.drop("pairs", "n_docs").join(back, "block", "left")
            .withColumn("found", F.coalesce("found", none))
            .mapInArrow(_per_document, "doc_id long, n_a long, n_b long, n_groups long, n_links long, "
                                       "n_best long, count_sum long, groups_sha256 string"))


def align_documents(docs: DataFrame, left: Callable[[], Side] = byte_level_side,
                    right: Callable[[], Side] = piece_side, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Align both tokenizers on every whole ``text``: doc_id, token, group and link numbers, digest of the groups.

    A text that is null, empty or not given back byte by byte by both sides has no
    tokens: its numbers are 0 and its digest is ''. Repeated rows and null ids are
    documents of their own, also in the counts of pairs; other columns are not
    read; an empty table gives no rows. A text is aligned in one task, whatever its
    length; links of long groups are counted by distinct ids.
    """
    return document_links(materialize(aligned_blocks(docs, left, right, block_chars), "aligned-blocks"))


def token_overlaps(docs: DataFrame, left: Callable[[], Side] = byte_level_side,
                   right: Callable[[], Side] = piece_side) -> DataFrame:
    """One row per pair of overlapping tokens: doc_id, places from 0 and ids on both sides, group in the document.

    Documents without tokens, as in ``align_documents``, have no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_side, b_side = left(), right()
        widths = [np.array([len(t) for t in s.token_bytes], dtype=np.int64) for s in (a_side, b_side)]
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for at, end in text_groups(texts, BATCH_CHARS):
                ids = [], []
                kept = []
                for key, text, x, y in zip(keys[at:end], texts[at:end], a_side.encode(texts[at:end]),
                                           b_side.encode(texts[at:end]), strict=True):
                    data = b" " + text.encode()
                    if text and all(b"".join(map(s.token_bytes.__getitem__, i)) == data
                                    for s, i in ((a_side, x), (b_side, y))):
                        kept.append(key)
                        ids[0].append(x)
                        ids[1].append(y)
                a, b = aligned(*ids, *widths)
                found = overlaps(a, b)
                doc, i, j = (found[c].to_numpy() for c in ("doc", "a_place", "b_place"))
                group = a["group"].to_numpy()
                first = [np.concatenate(([0], np.cumsum([len(x) for x in side]))) for side in ids]
                base = group[first[0][:-1]] if len(kept) else np.zeros(0, dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([kept[d] for d in doc], pa.int64()), pa.array(i - first[0][doc], pa.int64()),
                     pa.array(j - first[1][doc], pa.int64()), pa.array(a["id"].to_numpy()[i], pa.int32()),
                     pa.array(b["id"].to_numpy()[j], pa.int32()), pa.array(group[i] - base[doc], pa.int64())],
                    names=["doc_id", "a_place", "b_place", "a_id", "b_id", "group_no"])

    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
            .mapInArrow(run, "doc_id long, a_place long, b_place long, a_id int, b_id int, group_no long"))
