"""Alignment of two tokenizers against the libraries and a plain recomputation, byte by byte."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from quaylake.llm import alignment
from tokenizers import Tokenizer

from .conftest import tables

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def libraries():
    left = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    left.encode_special_tokens = True
    right = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    return left, right


@pytest.fixture(scope="module")
def byte_letters():
    """The letter that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    letters.update({chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in plain)})
    return letters


def groups_of(text, libraries, byte_letters):
    """[(ids of one side, ids of the other)] of a text, or [] if it has no tokens."""
    if not text:
        return []
    left, right = libraries
    a = left.encode(" " + text, add_special_tokens=False).ids
    b = right.encode(text)
    bytes_a = [bytes(byte_letters[c] for c in left.id_to_token(i)) for i in a]
    bytes_b = [bytes([int(p[3:5], 16)]) if right.is_byte(i) else p.replace("▁", " ").encode()
               for i, p in ((i, right.id_to_piece(i)) for i in b)]
    whole = (" " + text).encode()
    if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return []
    ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
    out, i, j = [], 0, 0
    for cut in sorted(set(ends_a) & set(ends_b)):
        x, y = ends_a.index(cut, i) + 1, ends_b.index(cut, j) + 1
        out.append((a[i:x], b[j:y]))
        i, j = x, y
    return out


def brute_force(rows, libraries, byte_letters):
    found = [groups_of(text, libraries, byte_letters) for _, text in rows]
    links = [[(x, y) for ga, gb in groups for x in ga for y in gb] for groups in found]
    count = Counter(p for pairs in links for p in set(pairs))
    best = {}
    for (x, _), n in count.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for (key, _), groups, pairs in zip(rows, found, links, strict=True):
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out.append((key, sum(len(g) for g, _ in groups), sum(len(g) for _, g in groups), len(groups), len(pairs),
                    sum(count[p] == best[p[0]] for p in pairs), sum(count[p] for p in pairs),
                    hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return out


def sortable(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r))


def test_documents_and_awkward_rows_equal_brute_force(spark, awkward, libraries, byte_letters):
    extra = spark.createDataFrame(
        [(20, " lead  and   trail  "), (21, "▁ is lost"), (22, "<s> <0x41> <|endoftext|> <unk>"), (23, "="),
         (24, "\n\n \t x"), (25, "🎉🎉日本" * 40), (26, "a b" * 3), (26, "a b" * 3)], "doc_id long, text string")
    docs = (tables(spark, "documents")[0].select("doc_id", "text").unionByName(extra)
            .unionByName(awkward.where("doc_id IS NULL OR doc_id <> 5").select("doc_id", "text")))
    got = [tuple(r[c] for c in COLUMNS) for r in alignment.align_documents(docs, block_chars=50_000).collect()]
    want = brute_force([(r["doc_id"], r["text"]) for r in docs.collect()], libraries, byte_letters)
    assert sortable(got) == sortable(want)


def test_extra_columns_and_long_texts(spark, awkward, libraries, byte_letters):
    clash = awkward.selectExpr("*", "1 AS block", "2 AS pair", "'x' AS n_a", "array(1) AS found")
    got = {r["doc_id"]: r for r in alignment.align_documents(clash).where("doc_id = 5").collect()}
    text = next(r["text"] for r in awkward.collect() if r["doc_id"] == 5)
    groups = groups_of(text, libraries, byte_letters)
    assert got[5]["n_groups"] == len(groups)
    assert got[5]["n_a"] == sum(len(a) for a, _ in groups)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align_documents(empty).count() == 0
    assert alignment.token_overlaps(empty).count() == 0


def own_side(cuts):
    """A tokenizer that cuts a space and the text at the given lengths, the last of them for the rest."""
    names = [b"", b" a", b"a", b"aa", b"aaa", b" aa", b" "]

    def encode(texts):
        out = []
        for text in texts:
            data, ids, at, k = b" " + text.encode(), [], 0, 0
            while at < len(data):
                part = data[at:at + cuts[min(k, len(cuts) - 1)]]
                ids.append(names.index(part))
                at += len(part)
                k += 1
            out.append(ids)
        return out
    return lambda: alignment.Side(encode, names)


def test_large_groups_are_counted_by_distinct_ids(spark, monkeypatch):
    # tokens of 3 bytes against an opening 2 and then 3: their ends never meet before the text does
    left, right = own_side([3]), own_side([2, 3])
    texts = [(i, "a" * n) for i, n in enumerate((8, 8, 300, 1))]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    plain = sorted(map(tuple, alignment.align_documents(docs, left, right).collect()))
    sides, doc_links = [left(), right()], {}
    widths = [np.array([len(t) for t in s.token_bytes]) for s in sides]
    ids = [s.encode([t for _, t in texts]) for s in sides]
    a, b = alignment.aligned(*ids, *widths)
    for limit in (0, 10, alignment.LARGE_GROUP):
        monkeypatch.setattr(alignment, "LARGE_GROUP", limit)
        doc_links[limit] = [x.tolist() for x in alignment.linked_pairs(a, b, len(texts))]
    assert doc_links[0] == doc_links[10] == doc_links[alignment.LARGE_GROUP]
    n = {r[0]: r for r in plain}
    assert n[2][1:5] == (101, 101, 1, 101 * 101)


def test_pair_counts_count_documents(spark):
    docs = spark.createDataFrame([(1, "a a a"), (2, "a"), (3, "b"), (3, "b")], "doc_id long, text string")
    blocks = alignment.aligned_blocks(docs, alignment.byte_level_side, alignment.piece_side, block_chars=1)
    rows = alignment.pair_counts(alignment.materialize(blocks, "test-blocks")).collect()
    assert sorted(r["n_docs"] for r in rows) == [2, 2]
    assert all(r["best"] for r in rows)


def test_overlaps_cover_every_byte_once(spark, libraries, byte_letters):
    docs = spark.createDataFrame([(1, "tokenization, naïve 日本 42"), (2, ""), (3, "▁")], "doc_id long, text string")
    rows = alignment.token_overlaps(docs).collect()
    assert {r["doc_id"] for r in rows} == {1}
    groups = groups_of("tokenization, naïve 日本 42", libraries, byte_letters)
    a = [(x, g) for g, (ga, _) in enumerate(groups) for x in ga]
    b = [(y, g) for g, (_, gb) in enumerate(groups) for y in gb]
    assert {(r["a_place"], r["a_id"], r["group_no"]) for r in rows} == {(i, x, g) for i, (x, g) in enumerate(a)}
    assert {(r["b_place"], r["b_id"], r["group_no"]) for r in rows} == {(j, y, g) for j, (y, g) in enumerate(b)}
    # tokens of a group that share a byte form one chain
    for g, (ga, gb) in enumerate(groups):
        assert sum(r["group_no"] == g for r in rows) == len(ga) + len(gb) - 1
