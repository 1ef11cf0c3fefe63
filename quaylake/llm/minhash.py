"""Near-duplicates by bottom-k sketches of word shingles, with exact confirmation.

One 64-bit hash function names all shingles and orders them: first by how often
its bucket of hash values occurs in the corpus (powers of two, counted over all
documents in a table of fixed size), then by the hash. A document's sketch is the
bottom of its set in this order: the values in which two sets with the required
similarity must share at least one. Rare values come first, so the inverted
lists of retained values are short, except where many texts really are alike.

Lists of at most ``hot`` members give the pairs whose sizes and marks allow the
similarity. A mark has MARK_BITS bits, one for the smallest hash in each part of
the range of hashes, so two texts that only share a rare passage never leave their
list as a pair. The members of longer lists meet by bands: each names BAND_ROWS
smallest hashes under as many orders, and of two similar texts some band of the
BANDS agrees. Buckets of at most ``hot`` members give pairs again, the members of a
longer one are tied to its smallest id; members tied so need no pairs.

Pairs pass a second, uniform sketch: the overlap in the union of the SIGNATURE
smallest hashes of both estimates the similarity. What then hangs together is a
cluster, which holds every link of its members. Each set moves to its cluster
once, or to the pairs of parts of a large one, and all pairs inside are decided
exactly; a task returns links that join what is joined, not all of them.

At 80 per cent a similar pair fails its mark (more than eight standard deviations of
differing bits) or all bands with a chance of under 1e-9 each, and the estimate
(six standard deviations) with one of under 1e-8; every link returned is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaylake.llm.bpe import pack_ints, unpack_ints
from quaylake.llm.common import materialize

SIMILARITY = 80           # per cent
HOT = 64
SIGNATURE = 64
MARK_BITS = 128
BANDS = 40
BAND_ROWS = 4
# a part of a cluster: at most about so many hashes and so many sets
PART_HASHES = 1 << 19
PART_SETS = 512
COLUMNS_AT_ONCE = 4096
CLASS_BITS = 22
CHUNK_BITS = 16
BITMAP_BITS = 1 << 23
REMEMBERED_WORDS = 200_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xBF58476D1CE4E5B9)
_PART_STARTS = np.arange(MARK_BITS, dtype=np.uint64) * np.uint64((1 << 64) // MARK_BITS)


class _WordHashes(dict):
    def __init__(self, hash_of):
        super().__init__()
        self.hash_of = hash_of

    def __missing__(self, word: bytes) -> int:
        value = self[word] = self.hash_of(word)
        return value


class Shingler:
    """Sorted distinct 64-bit hashes of a text's word shingles."""

    def __init__(self, width: int):
        import xxhash
        self.width, self.known = width, _WordHashes(xxhash.xxh3_64_intdigest)

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "replace").lower().split()
        if not words:
            return np.zeros(0, dtype=np.uint64)
        if len(self.known) > REMEMBERED_WORDS:
            self.known.clear()
        codes = np.fromiter(map(self.known.__getitem__, words), dtype=np.uint64, count=len(words))
        width = min(self.width, len(words))
        size = len(codes) - width + 1
        h = np.full(size, width, dtype=np.uint64)
        for i in range(width):
            h = (h ^ codes[i:i + size]) * _MIX
            h ^= h >> np.uint64(29)
            h *= _MIX2
            h ^= h >> np.uint64(32)
        return np.unique(h)


def must_share(n, similarity: int):
    """In how many values of any order a set must meet every set that is similar enough."""
    return n * (100 - similarity) // 100 + 1


def frequency_classes(docs: DataFrame, width: int, bits: int = CLASS_BITS) -> np.ndarray:
    """Logarithm to base 2 of how many document sets a bucket of hash values occurs in, for 2**bits buckets.

    Every task counts its documents in an array of that size; the arrays meet in
    chunks, in two steps, so no task holds more than a few of them. One byte a
    bucket reaches the driver.
    """
    chunk, shift = 1 << CHUNK_BITS, np.uint64(64 - bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        shingles, counts = Shingler(width), np.zeros(1 << bits, dtype=np.uint32)
        held, size = [], 0

        def add():
            if held:
                np.add(counts, np.bincount(np.concatenate(held), minlength=1 << bits), out=counts, casting="unsafe")
                held.clear()

        for batch in batches:
            for text in batch.column(0):
                held.append((shingles(text.as_py()) >> shift).astype(np.int64))
                size += len(held[-1])
                if size > 1 << 20:
                    add()
                    size = 0
        add()
        part = TaskContext.get().partitionId() % 64
        for i in range(0, 1 << bits, chunk):
            if counts[i:i + chunk].any():
                yield pa.RecordBatch.from_pydict({"chunk": [i // chunk], "part": [part],
                                                  "counts": [pack_ints(counts[i:i + chunk])]}, schema=schema)

    def total(rows: pa.Table) -> np.ndarray:
        out = np.zeros(chunk, dtype=np.uint64)
        for data in rows["counts"]:
            out += unpack_ints(data.as_py())
        return np.minimum(out, np.uint64(0xFFFFFFFF))

    def merge(rows: pa.Table) -> pa.Table:
        return pa.table({"chunk": rows["chunk"].slice(0, 1), "counts": pa.array([pack_ints(total(rows))], pa.binary())})

    def classify(rows: pa.Table) -> pa.Table:
        logs = np.floor(np.log2(np.maximum(total(rows), np.uint64(1)).astype(np.float64))).astype(np.uint8)
        return pa.table({"chunk": rows["chunk"].slice(0, 1), "counts": pa.array([logs.tobytes()], pa.binary())})

    schema = pa.schema([("chunk", pa.int32()), ("part", pa.int32()), ("counts", pa.binary())])
    counted = docs.select("text").mapInArrow(count, "chunk int, part int, counts binary")
    merged = counted.groupBy("chunk", "part").applyInArrow(merge, "chunk int, counts binary")
    classes = np.zeros(1 << bits, dtype=np.uint8)
    for r in merged.groupBy("chunk").applyInArrow(classify, "chunk int, counts binary").toLocalIterator():
        classes[r["chunk"] * chunk:(r["chunk"] + 1) * chunk] = np.frombuffer(r["counts"], dtype=np.uint8)
    return classes


def mark(h: np.ndarray) -> np.ndarray:
    """Two words with a bit of the smallest of the sorted hashes in each of MARK_BITS equal parts of their range.

    A value that only one of two sets holds changes one bit at most.
    """
    starts = np.searchsorted(h, _PART_STARTS)
    there = np.flatnonzero(np.diff(starts, append=len(h)))
    bits = np.zeros(MARK_BITS, dtype=np.uint8)
    bits[there] = (h[starts[there]] >> np.uint64(20)) & np.uint64(1)
    return np.packbits(bits).view(np.int64)


def sketches(docs: DataFrame, width: int, similarity: int, classes: np.ndarray) -> DataFrame:
    """(doc_id, n, key, pool, sig, m1, m2): set size, digest, bottom in the corpus order, smallest hashes, mark.

    ``pool`` and ``sig`` hold the upper halves of the hashes.
    """
    shift = np.uint64(64 - (len(classes) - 1).bit_length())
    shared = docs.sparkSession.sparkContext.broadcast(classes)  # one byte a bucket, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        shingles, rank = Shingler(width), shared.value
        for batch in batches:
            sizes, keys, pools, sigs, marks = [], [], [], [], np.zeros((batch.num_rows, 2), dtype=np.int64)
            for i, text in enumerate(batch.column(1)):
                h = shingles(text.as_py())
                sizes.append(len(h))
                marks[i] = mark(h)
                keys.append(xxhash.xxh3_128_digest(h.tobytes()))
                # hashes come sorted, so a stable sort by class alone gives the order
                order = np.argsort(rank[(h >> shift).astype(np.int64)], kind="stable")
                half = (h >> np.uint64(32)).astype(np.uint32).view(np.int32)
                pools.append(np.unique(half[order[:must_share(len(h), similarity)]]))
                sigs.append(half[:SIGNATURE])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(pools, pa.list_(pa.int32())), pa.array(sigs, pa.list_(pa.int32())),
                 pa.array(marks[:, 0]), pa.array(marks[:, 1])],
                names=["doc_id", "n", "key", "pool", "sig", "m1", "m2"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n long, key binary, pool array<int>, sig array<int>, m1 long, m2 long")


def full_sets(docs: DataFrame, nodes: DataFrame, width: int, bits: int = BITMAP_BITS) -> DataFrame:
    """(node, n, hashes) of the documents whose id is in ``nodes``, each set of an id once.

    The ids are folded into a bitmap of fixed size that the scan of the texts
    carries along, so texts are neither shuffled nor all hashed; the ids it lets
    through by chance are dropped by a join.
    """
    place = F.pmod(F.xxhash64("node"), F.lit(bits))
    rows = (nodes.select(place.alias("p")).groupBy(F.shiftright("p", 6).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, CAST(p % 64 AS INT))")).alias("mask")).collect())
    bitmap = np.zeros(bits // 64, dtype=np.uint64)
    for r in rows:
        bitmap[r["word"]] = np.uint64(r["mask"] & 0xFFFFFFFFFFFFFFFF)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)  # bits / 8 bytes, whatever the number of ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        shingles = Shingler(width)
        for batch in batches:
            p = batch.column(2).to_numpy()
            hit = np.flatnonzero((shared.value[p >> 6] >> (p & 63).astype(np.uint64)) & np.uint64(1))
            found = [shingles(batch.column(1)[int(i)].as_py()) for i in hit]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(hit)), pa.array([len(h) for h in found], pa.int64()),
                 pa.array([h.view(np.int64) for h in found], pa.list_(pa.int64())),
                 pa.array([xxhash.xxh3_128_digest(h.tobytes()) for h in found], pa.binary())],
                names=["node", "n", "hashes", "key"])

    scanned = (docs.where(F.col("doc_id").isNotNull())
               .select(F.col("doc_id").cast("long").alias("node"), "text", place.alias("p"))
               .mapInArrow(run, "node long, n long, hashes array<bigint>, key binary"))
    return (scanned.join(nodes.select("node").distinct(), "node", "left_semi")
            .dropDuplicates(["node", "key"]).drop("key"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable over (a, b) edges, for the nodes that have one.

    Labels move along the edges and then jump to their label's label, so paths
    shorten by half each round; every round is written to the shared folder.
    """
    both = materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                       .where("a <> b").distinct(), "links")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                         .select("node", F.least("node", "m").alias("root")), "labels")
    while True:
        around = (both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("root").alias("m")))
        better = labels.join(around, labels["node"] == around["a"]).select(
            "node", F.col("root").alias("old"), F.least("root", "m").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("root").alias("far"))
        moved = materialize(better.join(jump, "next", "left").select(
            "node", "old", F.least("next", F.coalesce("far", "next")).alias("root")), "labels")
        labels = moved.select("node", "root")
        if moved.where("root <> old").isEmpty():
            return labels


def _pairs_of_lists(lists: DataFrame, similarity: int) -> DataFrame:
    """Pairs (a, b), a < b, of the members (node, n, m1, m2, label) of each list that may be similar by size and mark.

    Members with one label are joined already. Similar sets differ in at most
    (100 - similarity) / (100 + similarity) of their sizes' sum, so in no more
    bits; of large sets, a bit differs with a chance of half the distance.
    """
    p = (100 - similarity) / 200
    most = int(np.ceil(MARK_BITS * p + 8 * np.sqrt(MARK_BITS * p * (1 - p))))
    return (lists.select("members", F.explode("members").alias("x"))
            .select(F.col("x.node").alias("a"), F.explode(F.expr(
                "filter(members, y -> y.node > x.node AND y.label <> x.label"
                f" AND 100 * least(x.n, y.n) >= {similarity} * greatest(x.n, y.n)"
                f" AND bit_count(x.m1 ^ y.m1) + bit_count(x.m2 ^ y.m2) <= {most}"
                f" AND {100 + similarity} * (bit_count(x.m1 ^ y.m1) + bit_count(x.m2 ^ y.m2))"
                f" <= {100 - similarity} * (x.n + y.n))")).alias("y"))
            .select("a", F.col("y.node").alias("b")))


def _overlap(a: pa.ListArray, b: pa.ListArray) -> np.ndarray:
    """Share of the SIGNATURE smallest values of two signatures together that is in both, row by row."""
    none = np.uint64(1 << 40)

    def padded(lists):
        sizes = np.diff(lists.offsets.to_numpy())
        out = np.full((len(sizes), SIGNATURE), none)
        out[np.arange(SIGNATURE) < sizes[:, None]] = lists.flatten().to_numpy().view(np.uint32)
        return out
    both = np.sort(np.concatenate((padded(a), padded(b)), axis=1), axis=1)
    again = np.zeros(both.shape, dtype=bool)
    again[:, 1:] = both[:, 1:] == both[:, :-1]
    there = both < none
    place = np.cumsum(there & ~again, axis=1)
    covered = np.minimum(place[:, -1], SIGNATURE)
    return (again & there & (place <= covered[:, None])).sum(axis=1) / np.maximum(covered, 1)


def estimated(pairs: DataFrame, nodes: DataFrame, similarity: int) -> DataFrame:
    """(a, b, na, nb, est) of the pairs whose signatures allow the similarity.

    ``est`` is the share of the smallest hashes of both together, as many as the
    signatures cover, that is in both; it is exact for small sets.
    """
    t = similarity / 100

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            est = _overlap(batch.column(4), batch.column(5))
            covered = np.minimum(SIGNATURE, np.maximum(batch.column(2).to_numpy(), batch.column(3).to_numpy()))
            keep = pa.array(est >= t - 6 * np.sqrt(t * (1 - t) / covered))
            yield pa.RecordBatch.from_arrays([*(c.filter(keep) for c in batch.columns[:4]), pa.array(est).filter(keep)],
                                             names=["a", "b", "na", "nb", "est"])

    left = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sig").alias("sa"))
    right = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sb"))
    return (pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "na", "nb", "sa", "sb")
            .mapInArrow(run, "a long, b long, na long, nb long, est double"))


def bands(sets: DataFrame) -> DataFrame:
    """(node, band): for each set, BANDS digests of the smallest values under BAND_ROWS orders each."""
    seeds = np.random.default_rng(BANDS).integers(1, 1 << 63, size=BANDS * BAND_ROWS, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        for batch in batches:
            out = []
            for hashes in batch.column(1):
                h = hashes.values.to_numpy().view(np.uint64)
                least = np.empty(len(seeds), dtype=np.uint64)
                for i, seed in enumerate(seeds):
                    v = (h ^ seed) * _MIX
                    v ^= v >> np.uint64(32)
                    least[i] = (v * _MIX2).min()
                out.append(np.array([xxhash.xxh3_64_intdigest(row.tobytes(), seed=i)
                                     for i, row in enumerate(least.reshape(BANDS, BAND_ROWS))], dtype=np.uint64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([b.view(np.int64) for b in out],
                                                                        pa.list_(pa.int64()))], names=["node", "bands"])

    found = sets.where("n > 0").select("node", "hashes").mapInArrow(run, "node long, bands array<bigint>")
    return found.select("node", F.explode("bands").alias("band"))


def _members(rows: DataFrame, key: str) -> DataFrame:
    """(members) of each value of ``key``."""
    return rows.groupBy(key).agg(F.collect_list(F.struct("node", "n", "m1", "m2", "label")).alias("members"))


def _bucket_pairs(banded: DataFrame, nodes: DataFrame, similarity: int, hot: int
                  ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pairs, ties, labels) of the rows (node, band), all that share a band being joined by ties or met in pairs.

    ``labels`` (node, label) ties a member of buckets of more than ``hot`` members to the
    smallest id in them, ``ties`` (a, b) are these and those between the labels in a
    bucket. Shorter buckets give the pairs of members with different labels.
    """
    sizes = banded.groupBy("band").agg(F.count("*").alias("c"), F.min("node").alias("least")).where("c > 1")
    sized = materialize(banded.join(sizes, "band"), "buckets")
    labels = materialize(sized.where(F.col("c") > hot).groupBy("node").agg(F.min("least").alias("label")), "labels")
    named = sized.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    groups = named.where(F.col("c") > hot).select("band", F.col("label").alias("b")).distinct()
    between = groups.join(groups.groupBy("band").agg(F.min("b").alias("a")), "band").where("a <> b").select("a", "b")
    ties = labels.where("label <> node").select(F.col("label").alias("a"), F.col("node").alias("b"))
    ties = ties.unionByName(between).distinct()
    rows = named.where(F.col("c") <= hot).join(nodes.select("node", "n", "m1", "m2"), "node")
    return _pairs_of_lists(_members(rows, "band"), similarity).distinct(), ties, labels


def _unlabelled(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The (a, b) pairs whose ends do not have the same label."""
    la = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
    lb = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    return (pairs.join(la, "a", "left").join(lb, "b", "left")
            .where(F.coalesce("la", "a") != F.coalesce("lb", "b")).select("a", "b"))


def _similar_pairs(left: list[np.ndarray], right: list[np.ndarray], similarity: int) -> np.ndarray:
    """Which sets of ``left`` and ``right`` are similar, exactly: a matrix of booleans."""
    sizes = [np.array([len(h) for h in side], dtype=np.int64) for side in (left, right)]
    values, place = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    row = [np.repeat(np.arange(len(s)), s) for s in sizes]
    column = np.split(place, [int(sizes[0].sum())])
    # only values on both sides can be common
    both = np.logical_and(*(np.bincount(c, minlength=len(values)) > 0 for c in column))
    number = np.cumsum(both) - 1
    common = np.zeros((len(left), len(right)), dtype=np.int64)
    for i in range(0, int(both.sum()), COLUMNS_AT_ONCE):
        parts = []
        for r, c, s in zip(row, column, sizes, strict=True):
            here = both[c] & (number[c] >= i) & (number[c] < i + COLUMNS_AT_ONCE)
            part = np.zeros((len(s), min(COLUMNS_AT_ONCE, int(both.sum()) - i)), dtype=np.float32)
            part[r[here], number[c[here]] - i] = 1
            parts.append(part)
        common += (parts[0] @ parts[1].T).astype(np.int64)
    return 100 * common >= similarity * (sizes[0][:, None] + sizes[1][None, :] - common)


def _joining(linked: np.ndarray) -> Iterator[tuple[int, int]]:
    """For each component of a symmetric matrix of links, (its first row, another one) for all others."""
    free = np.ones(len(linked), dtype=bool)
    for start in range(len(linked)):
        if not free[start]:
            continue
        free[start] = False
        reached = np.flatnonzero(linked[start] & free)
        while len(reached):
            free[reached] = False
            yield from ((start, int(x)) for x in reached)
            reached = np.flatnonzero(linked[reached].any(axis=0) & free)


def cluster_links(sets: DataFrame, clusters: DataFrame, similarity: int) -> DataFrame:
    """Links (a, b) that join whatever similar pairs of sets inside the clusters (node, root) join.

    A cluster is dealt in parts of bounded size by a hash of the id. Every part meets
    itself and each other part in a group of its own, so no task holds more than two.
    """
    weight = F.sum(F.greatest("n", F.lit(PART_HASHES // PART_SETS))).alias("w")
    weights = clusters.join(sets.groupBy("node").agg(weight), "node")
    parts = weights.groupBy("root").agg(F.ceil(F.sum("w") / PART_HASHES).cast("int").alias("parts"))
    dealt = (clusters.join(parts, "root")
             .withColumn("part", F.pmod(F.xxhash64("node", F.lit(11)), F.col("parts")).cast("int"))
             .withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
             .select("node", "root", "part", F.least("part", "other").alias("i"),
                     F.greatest("part", "other").alias("j")))

    def links(rows: pa.Table) -> pa.Table:
        nodes = rows["node"].to_numpy()
        hashes = [h.values.to_numpy() for h in rows["hashes"]]
        first = rows["part"].to_numpy() == rows["i"][0].as_py()
        if first.all():
            linked = _similar_pairs(hashes, hashes, similarity)
        else:
            sides = np.flatnonzero(first), np.flatnonzero(~first)
            linked = np.zeros((len(nodes), len(nodes)), dtype=bool)
            across = _similar_pairs(*([hashes[x] for x in side] for side in sides), similarity)
            linked[np.ix_(*sides)] = across
            linked[np.ix_(*sides[::-1])] = across.T
        found = np.array(list(_joining(linked)), dtype=np.int64).reshape(-1, 2)
        return pa.table({"a": nodes[found[:, 0]], "b": nodes[found[:, 1]]})

    return (sets.select("node", "hashes").join(dealt, "node").groupBy("root", "i", "j")
            .applyInArrow(links, "a long, b long"))


def near_duplicates(docs: DataFrame, width: int, similarity: int = SIMILARITY, hot: int = HOT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    A text's set holds its distinct shingles of ``width`` words (a text with
    fewer words: all of them as one); words are split at ASCII white space and A-Z
    lower-cased. Texts are linked when the Jaccard similarity of their sets is at
    least ``similarity`` per cent, above 50. Null, empty and blank texts have no
    shingles and no links; their rows are components of their own. Rows with equal
    sets are one node named by their smallest id; rows that repeat an id are one
    document; a class with only null ids takes no part and is kept. Other columns
    are not carried.
    """
    docs = docs.select("doc_id", "text")
    sketched = materialize(sketches(docs, width, similarity, frequency_classes(docs, width)), "sketches")
    # equal sets first: the node of a set is its smallest id
    nodes = materialize(
        sketched.where("n > 0").groupBy("key")
        .agg(F.min("doc_id").alias("node"), *(F.first(c).alias(c) for c in ("n", "pool", "sig", "m1", "m2")))
        .where("node IS NOT NULL").drop("key"), "nodes")
    postings = nodes.select("node", "n", "m1", "m2", F.explode("pool").alias("h"))
    frequency = materialize(postings.groupBy("h").agg(F.count("*").alias("df")).where("df > 1"), "frequency")
    short = _members(postings.join(frequency.where(F.col("df") <= hot).select("h"), "h")
                     .withColumn("label", F.col("node")), "h")
    candidates = materialize(
        estimated(_pairs_of_lists(short, similarity).distinct(), nodes, similarity).select("a", "b"), "candidates")
    crowded = materialize(postings.select("h", "node").join(frequency.where(F.col("df") > hot).select("h"), "h")
                          .select("node").distinct(), "crowded")
    ends = F.explode(F.array("a", "b")).alias("node")
    edges = None
    wanted = candidates.select(ends).unionByName(crowded)
    if not wanted.isEmpty():
        sets = materialize(full_sets(docs, wanted, width), "sets")
        if not crowded.isEmpty():
            banded = bands(sets.join(crowded, "node", "left_semi"))
            pairs, ties, labels = _bucket_pairs(banded, nodes, similarity, hot)
            candidates = (_unlabelled(candidates, labels).unionByName(ties)
                          .unionByName(estimated(pairs, nodes, similarity).select("a", "b")))
        edges = materialize(cluster_links(sets, components(candidates), similarity), "links")
    classes = sketched.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("node"))
    if edges is not None:
        roots = components(edges)
        classes = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    else:
        classes = classes.withColumn("root", F.col("node"))
    rows = sketched.where("n > 0").select("doc_id", "n", "key").join(classes.select("key", "root"), "key")
    out = (rows.select("doc_id", F.col("n").alias("n_shingles"), F.col("root").alias("component_id"))
           .unionByName(sketched.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"),
                                                       F.col("doc_id").alias("component_id"))))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))
