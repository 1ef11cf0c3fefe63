"""Language identification: a linear-chain conditional random field over the words of a text.

Every word is labelled, so texts may switch languages. Emissions come from the
word's character n-grams (those that touch a word's edge are its affixes) and
from lexicons of frequent words; transitions are learned. Forward-backward
gives each word's label probabilities, and a document's language is the one
with the largest expected number of words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quaylake.llm.common import held_out, keep_rows
from quaylake.llm.pretokens import text_groups

UNKNOWN = "und"
ORDERS = (1, 2, 3, 4)
BITS = 16
LEXICON = 200
PER_LANGUAGE = 150
LANGUAGES = 64
MIX = 24
STEPS = 30
RATE = 0.15
PENALTY = 1e-3
REMEMBERED_WORDS = 200_000
WORDS_AT_ONCE = 4096
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], dtype=np.uint32)


def words_of(text: str | None) -> list[str]:
    return text.lower().split() if text else []


def word_features(words: list[str], orders=ORDERS, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of all words in one array, and the number of each word's.

    A word stands between two edge marks, so its n-grams include its affixes.
    Words are hashed together; an n-gram never reaches into the next word.
    """
    chars = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le", "replace"), dtype=np.uint32)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 2
    owner = np.repeat(np.arange(len(words)), sizes)
    found, owners = [], []
    for n in orders:
        size = len(chars) - n + 1
        if size <= 0:
            continue
        inside = owner[:size] == owner[n - 1:]
        h = np.full(size, n * 0x51ED270B & 0xFFFFFFFF, dtype=np.uint32)
        for i in range(n):
            h ^= chars[i:i + size] * _MULTIPLIERS[i]
            h *= np.uint32(0x01000193)
            h ^= h >> np.uint32(15)
        found.append((h >> np.uint32(32 - bits))[inside])
        owners.append(owner[:size][inside])
    flat, owner = np.concatenate(found or [np.zeros(0, np.uint32)]), np.concatenate(owners or [np.zeros(0, np.int64)])
    order = np.argsort(owner, kind="stable")
    return flat[order].astype(np.int64), np.bincount(owner, minlength=len(words))


@dataclass(frozen=True)
class ChainModel:
    labels: list[str]
    weights: np.ndarray       # hashed n-gram x label
    lexicon: dict[str, int]   # frequent word -> row of lexicon_weights
    lexicon_weights: np.ndarray
    transitions: np.ndarray   # label x label, logarithms
    start: np.ndarray

    def emissions(self, words: list[str]) -> np.ndarray:
        """Log potentials of each word's labels; n-grams count with their mean.

        Some words at a time: their n-grams take a hundred times as much as the result.
        """
        result = np.zeros((len(words), len(self.labels)), dtype=np.float32)
        for at in range(0, len(words) if self.labels else 0, WORDS_AT_ONCE):
            part = words[at:at + WORDS_AT_ONCE]
            flat, sizes = word_features(part)
            starts = np.cumsum(sizes) - sizes
            out = np.add.reduceat(self.weights[flat], starts, axis=0) / sizes[:, None]
            known = np.array([self.lexicon.get(w, -1) for w in part])
            out[known >= 0] += self.lexicon_weights[known[known >= 0]]
            result[at:at + len(part)] = out
        return result


def forward_backward(logits: np.ndarray, sizes: np.ndarray, transitions: np.ndarray, start: np.ndarray
                     ) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities of every position, and summed pair probabilities, of several chains at once.

    ``logits`` holds the chains one after another, ``sizes`` their lengths. The
    recursion runs over positions with all chains that are long enough; every
    step is normalised, so long chains neither under- nor overflow.
    """
    n_labels = logits.shape[1]
    e = np.exp(logits - logits.max(axis=1, keepdims=True)).astype(np.float64)
    e += 1e-30
    t = np.exp(transitions - transitions.max())
    order = np.argsort(-sizes, kind="stable")
    first = (np.cumsum(sizes) - sizes)[order]
    lengths = sizes[order]
    longest = int(lengths[0]) if len(lengths) else 0
    # chains still running at position i, longest first
    active = np.searchsorted(-lengths, -np.arange(longest), side="left")
    alpha, beta = np.empty_like(e), np.empty_like(e)
    a = np.exp(start - start.max())[None, :]
    for i in range(longest):
        rows = first[:active[i]] + i
        a = (a[:active[i]] @ t if i else a) * e[rows]
        a /= a.sum(axis=1, keepdims=True)
        alpha[rows] = a
    pairs = np.zeros((n_labels, n_labels))
    b = np.ones((0, n_labels))
    for i in range(longest - 1, -1, -1):
        k = active[i]
        rows = first[:k] + i
        new = np.ones((k, n_labels))
        if len(b):
            ahead = b * e[rows[:len(b)] + 1]
            new[:len(b)] = ahead @ t.T
            left = alpha[rows[:len(b)]]
            norm = 1.0 / (left * new[:len(b)]).sum(axis=1)
            pairs += (left * norm[:, None]).T @ ahead * t
        b = new / new.sum(axis=1, keepdims=True)
        beta[rows] = b
    marginals = alpha
    marginals *= beta
    marginals /= marginals.sum(axis=1, keepdims=True)
    return marginals, pairs


def fit(samples: list[tuple[str, str]], steps: int = STEPS, mix: int = MIX) -> ChainModel:
    """Learn from (language, text) pairs by gradient steps on the chains' likelihood.

    Each text's words are cut into runs of ``mix`` words and the runs of all
    languages are laid out in turn, so that switches occur in training.
    """
    labels = sorted({lang for lang, _ in samples})
    if not labels:
        return ChainModel([], np.zeros((1 << BITS, 0)), {}, np.zeros((0, 0)), np.zeros((0, 0)), np.zeros(0))
    index = {lang: i for i, lang in enumerate(labels)}
    words, targets, counts = [], [], [Counter() for _ in labels]
    runs: list[tuple[int, list[str]]] = []
    for lang, text in sorted(samples):
        found = words_of(text)
        counts[index[lang]].update(w for w in found if any(c.isalpha() for c in w))
        runs += [(index[lang], found[i:i + mix]) for i in range(0, len(found), mix)]
    # a fixed shuffle of runs, so neighbours come from any language
    order = np.random.default_rng(7).permutation(len(runs))
    for i in order:
        words += runs[i][1]
        targets += [runs[i][0]] * len(runs[i][1])
    n_labels, n = len(labels), len(words)
    common = sorted({w for c in counts for w, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:LEXICON]})
    lexicon = {w: i for i, w in enumerate(common)}
    model = ChainModel(labels, np.zeros((1 << BITS, n_labels)), lexicon, np.zeros((len(lexicon), n_labels)),
                       np.zeros((n_labels, n_labels)), np.zeros(n_labels))
    if n == 0 or n_labels == 1:
        return model
    distinct = sorted(set(words))
    number = {w: i for i, w in enumerate(distinct)}
    code = np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=n)
    y = np.array(targets)
    flat, sizes = word_features(distinct)
    owner = np.repeat(np.arange(len(distinct)), sizes)
    scale = 1.0 / sizes
    known = np.array([lexicon.get(w, -1) for w in distinct])
    in_lexicon = np.flatnonzero(known >= 0)
    chain = 16 * mix
    lengths = np.full(-(-n // chain), chain)
    lengths[-1] = n - chain * (len(lengths) - 1)
    ends = np.cumsum(lengths)
    inner = np.setdiff1d(np.arange(1, n), ends)
    seen_pairs = np.bincount(y[inner - 1] * n_labels + y[inner], minlength=n_labels ** 2).reshape(n_labels, n_labels)
    seen = np.stack([np.bincount(code[y == k], minlength=len(distinct)) for k in range(n_labels)], axis=1)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in (model.weights, model.lexicon_weights, model.transitions)]
    for step in range(1, steps + 1):
        emitted = np.stack([np.bincount(owner, weights=model.weights[flat, k], minlength=len(distinct))
                            for k in range(n_labels)], axis=1) * scale[:, None]
        emitted[in_lexicon] += model.lexicon_weights[known[in_lexicon]]
        marginals, pairs = forward_backward(emitted[code], lengths, model.transitions, model.start)
        expected = np.stack([np.bincount(code, weights=marginals[:, k], minlength=len(distinct))
                             for k in range(n_labels)], axis=1)
        error = (seen - expected) / n
        grams = np.stack([np.bincount(flat, weights=(error[:, k] * scale)[owner], minlength=1 << BITS)
                          for k in range(n_labels)], axis=1)
        lex = np.zeros_like(model.lexicon_weights)
        lex[known[in_lexicon]] = error[in_lexicon]
        grads = (grams, lex, (seen_pairs - pairs) / n)
        for p, g, (m, v) in zip((model.weights, model.lexicon_weights, model.transitions), grads, moments, strict=True):
            g = g - PENALTY / n * p
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-9)
    return ChainModel(labels, model.weights.astype(np.float32), lexicon, model.lexicon_weights.astype(np.float32),
                      model.transitions, model.start)


class Labeller:
    """Labels texts with a model; emissions of words are remembered up to a bound."""

    def __init__(self, model: ChainModel, limit: int = REMEMBERED_WORDS):
        self.model, self.limit = model, limit
        self.clear()

    def clear(self) -> None:
        self.codes: dict[str, int] = {}
        self.table = np.zeros((0, len(self.model.labels)), dtype=np.float32)
        self.letters = np.zeros(0, dtype=bool)

    def encode(self, texts: Iterable[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the table for all words of the texts, and how many words each text has.

        The words of one text at a time are held; the table keeps those it has not met yet.
        """
        if len(self.codes) > self.limit:
            self.clear()
        known, codes = len(self.codes), self.codes
        found = [np.fromiter((codes.setdefault(w, len(codes)) for w in words), dtype=np.int32, count=len(words))
                 for words in texts]
        if len(codes) > known:
            new = list(islice(codes, known, None))
            self.table = np.concatenate((self.table, self.model.emissions(new)))
            self.letters = np.concatenate((self.letters, np.array([any(c.isalpha() for c in w) for w in new])))
        sizes = np.array([len(c) for c in found], dtype=np.int64)
        return np.concatenate([np.zeros(0, dtype=np.int32), *found]), sizes

    def word_probabilities(self, texts: Iterable[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Label probabilities of all words of the texts, and which words have a letter."""
        return self.probabilities(*self.encode(texts))

    def probabilities(self, code: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``word_probabilities``, of encoded texts."""
        if not len(code) or not self.model.labels:
            return np.zeros((len(code), len(self.model.labels))), self.letters[code]
        marginals, _ = forward_backward(self.table[code], sizes[sizes > 0], self.model.transitions, self.model.start)
        return marginals, self.letters[code]

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, share of the words with a letter that it is expected to label) of each text."""
        code, sizes = self.encode(words_of(t) for t in texts)
        marginals, letters = self.probabilities(code, sizes)
        ends = np.cumsum(sizes)
        out = []
        for a, b in zip([0, *ends[:-1]], ends, strict=True):
            mask = letters[a:b]
            n = int(mask.sum())
            if not n or not self.model.labels:
                out.append((UNKNOWN, 0.0))
                continue
            mass = marginals[a:b][mask].sum(axis=0)
            best = int(np.argmax(mass))
            out.append((self.model.labels[best], float(min(1.0, mass[best] / n))))
        return out


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, languages: int = LANGUAGES) -> ChainModel:
    """Fit on at most ``per_language`` documents of each of the ``languages`` most frequent languages.

    The sample leaves the held-out fold out and follows a hash of the id within each
    language; only its ids are gathered first, and their texts fetched by a join
    with that bounded list. Rarer languages than these are not learned.
    """
    known = (docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .select("doc_id", "lang", F.xxhash64("doc_id").alias("h")))
    learned = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(languages)
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))
    ids = (known.join(F.broadcast(learned.select("lang")), "lang").withColumn("place", place)
           .where(F.col("place") <= per_language).select("doc_id", "lang").distinct())
    # rows that repeat an id are one sample
    rows = (docs.select("doc_id", "lang", "text").join(F.broadcast(ids), ["doc_id", "lang"])
            .groupBy("doc_id", "lang").agg(F.min("text").alias("text")).collect())
    return fit([(r["lang"], r["text"] or "") for r in rows])


def label_documents(docs: DataFrame, model: ChainModel) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row.

    Null texts and texts without a letter are ``und`` with score 0; repeated rows
    get the same answer; a null doc_id counts as not held out. Other columns are
    not carried.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS rows of a number per language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(shared.value)
        for batch in batches:
            texts = batch.column(2).to_pylist()
            found = []
            for a, b in text_groups([t or "" for t in texts]):
                found += labeller.predict(texts[a:b])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return (docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), "text")
            .mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double"))


def keep_identified(docs: DataFrame, model: ChainModel, least: float) -> DataFrame:
    """The rows of ``docs`` with a language (null texts and texts without a letter go) and a score of ``least``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def decide():
        labeller = Labeller(shared.value)

        def accept(texts: list[str | None]) -> list[bool]:
            found = []
            for a, b in text_groups([t or "" for t in texts]):
                found += [lang != UNKNOWN and score >= least for lang, score in labeller.predict(texts[a:b])]
            return found
        return accept

    return keep_rows(docs, decide)
