"""Subject areas of documents (problem 9).

One interpolated n-gram language model for each subject and one background model are trained on all documents, of which
some are hand-labelled. A sentence is about the subject whose model gives it the least per-token
cross-entropy, if that is below the background's by the subject's own margin, calibrated on labels that the models it is
measured with haven't seen; a document has every subject that enough of its sentences are about.

Labels hold for documents, not sentences, and have errors. Training therefore alternates: sentences are assigned to the
subjects their document is labelled with, to the background or, at a lower prior, to any other subject, and models are
estimated again from the assignments. Documents labelled as having no subject teach the background. The labelled ones
come first, then all; no document is left out, none is shortened, and counts are added up where the documents are. The
driver only holds the models, whose size is bounded by the least shares of words and pairs they know.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import blake2b
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, slices, spread_sample, table

#: Documents of a subject among those held out from which its margin is its own; with fewer it is that of all subjects.
LEAST_HELD_OUT = 12
#: Estimations from the labelled documents, and then from all of them; more of these change next to nothing.
ROUNDS, ROUNDS_OF_ALL = 8, 1
#: Words and pairs of words that make up a smaller share of all are taken as unknown words and by their second word. There
#: are at most as many as the share goes into 1, whatever the size of the corpus.
LEAST_OF_WORDS, LEAST_OF_PAIRS = 1e-6, 1e-6
#: Shares of the sentences of a text that must be about a subject.
LEAST_SHARE = 0.2
BIGRAM_WEIGHT, CORPUS_WEIGHT = 0.6, 0.3
#: Prior of the background, and of subjects a document isn't labelled with, against 1 for those it is labelled with.
BACKGROUND_PRIOR, OTHER_PRIOR = 0.3, 0.02
MIXTURE_FLOOR = 0.3
#: How many sentences a subject's description counts as.
NOTE_WEIGHT = 3.0

_TAG = re.compile(r"<[^<>]{1,80}>|&(?:[a-z]{2,8}|#\d{1,6});", re.IGNORECASE)
# A stop ends a sentence before a blank and a sign that can begin one; after a short abbreviation only if it is none.
_BREAK = re.compile(r"([.!?…](?<!\bi\.e\.)(?<!\be\.g\.)(?<!\bNo\.)(?<!\bNr\.)(?<!\bvs\.)[\"”»')\]]*)\s+(?=[\"“«(\[¿¡]?[^\Wa-zà-ÿ_])")
_TOKEN = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")
_STOPS = frozenset(".!?…")
_CLOSERS = "\"”»')]"


def sentences(text: str | None) -> list[str]:
    """Sentences of a text: markup is dropped, and lines that are no sentence (headings, page headers) don't count."""
    if not text:
        return []
    if "<" in text or "&" in text:
        text = _TAG.sub(" ", text)
    found = [s for part in _BREAK.sub("\\1\n", text).split("\n") if (s := part.strip())]
    whole = [s for s in found if s.rstrip(_CLOSERS)[-1:] in _STOPS]
    return whole or found


def words(sentence: str) -> list[str]:
    return _TOKEN.findall(sentence.lower())


class _Hashes(dict[bytes, int]):
    """Hashes of words in UTF-8, kept between texts."""

    LIMIT = 500_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        found = self[word] = int.from_bytes(blake2b(word, digest_size=8).digest(), "little", signed=True)
        return found


_hash_of = _Hashes().__getitem__
_LETTER, _JOINER = 1, 2
_AT_ONCE = 1 << 20


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """By code point: whether ``words`` takes it as a letter, or as a sign that joins letters."""
    kinds = np.zeros(0x110000, np.uint8)
    for m in re.finditer(r"[^\W\d_]+", "".join(map(chr, range(len(kinds))))):
        kinds[m.start() : m.end()] = _LETTER
    kinds[[ord(c) for c in "'’-"]] = _JOINER
    return kinds


def encode(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the ``words`` of the texts, how many each sentence has, and the sentences of each text.

    Sentences without words don't count. Those of about ``_AT_ONCE`` characters are taken apart at once.
    """
    found = [sentences(t) for t in texts]
    owner = np.repeat(np.arange(len(found)), [len(x) for x in found])
    every = list(chain.from_iterable(found))
    part = np.cumsum(np.fromiter(map(len, every), np.int64, len(every))) // _AT_ONCE
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(every)]
    parts = [_encode(every[a:b]) for a, b in zip(cuts, cuts[1:])]
    lengths = np.concatenate([n for _, n in parts])
    return np.concatenate([h for h, _ in parts]), lengths[lengths > 0], np.bincount(owner[lengths > 0], minlength=len(found))


def _encode(found: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of sentences, and how many each has; each distinct word is hashed once."""
    signs = np.frombuffer("\n".join([s.lower() for s in found]).encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = _kinds()[signs]
    inside = np.zeros(len(signs) + 2, bool)  # with one sign before and after
    letters = inside[1:-1]
    letters[:] = kinds == _LETTER
    at = np.flatnonzero(kinds == _JOINER)
    joins = at[inside[at] & inside[at + 2]]
    letters[joins] = True
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    flat = signs[letters]
    data = flat.tobytes().decode("utf-32-le").encode()
    if len(data) > len(flat):  # sizes in bytes
        at = np.flatnonzero(flat >= 0x80)
        more = np.searchsorted([0x80, 0x800, 0x10000], flat[at], side="right")
        sizes = sizes + np.bincount(np.searchsorted(np.cumsum(sizes), at, side="right"), more, len(sizes)).astype(np.int64)
    each = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))), pa.py_buffer(data)]).dictionary_encode()
    hashes = np.fromiter(map(_hash_of, each.dictionary.to_pylist()), np.int64, len(each.dictionary))[each.indices.to_numpy()]
    ends = np.append(np.flatnonzero(signs == ord("\n")), len(signs))[: len(found)]
    return hashes, np.diff(np.searchsorted(starts, ends), prepend=0)


def _starts(lengths: np.ndarray) -> np.ndarray:
    return np.cumsum(lengths) - lengths


@dataclass
class Index:
    """Rows of the models' tables: known words, one for all other words, then known pairs of words."""

    vocabulary: np.ndarray  # sorted hashes of known words
    pair_keys: np.ndarray  # sorted

    @property
    def size(self) -> int:
        return len(self.vocabulary) + 1 + len(self.pair_keys)

    def words(self, hashes: np.ndarray) -> np.ndarray:
        v = len(self.vocabulary)
        if not v:
            return np.zeros(len(hashes), np.int64)
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == v] = 0
        return np.where(self.vocabulary[at] == hashes, at, v)

    def keys(self, hashes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each word, and the key of the pair it ends; -1 at the beginning of a sentence."""
        ids = self.words(hashes)
        keys = np.empty(len(ids), np.int64)
        keys[1:] = ids[:-1] * (len(self.vocabulary) + 1) + ids[1:]
        keys[_starts(lengths)] = -1
        return ids, keys

    def rows(self, hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """For each word the row of its pair where that is known, else its own."""
        if not len(hashes):
            return np.zeros(0, np.int64)
        ids, keys = self.keys(hashes, lengths)
        if not len(self.pair_keys):
            return ids
        at = np.searchsorted(self.pair_keys, keys)
        at[at == len(self.pair_keys)] = 0
        return np.where(self.pair_keys[at] == keys, at + len(self.vocabulary) + 1, ids)


@dataclass
class Block:
    """Some documents: rows of their words, lengths of their sentences, sentences of each; labels and half where they have any."""

    rows: np.ndarray
    lengths: np.ndarray
    per_doc: np.ndarray
    labels: list[list[int] | None]
    halves: np.ndarray

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.per_doc)), self.per_doc)


def _sums(table: np.ndarray, rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of the table's rows over each sentence."""
    out = np.empty((len(lengths), table.shape[1]), np.float32)
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    for a in range(0, len(lengths), 200):  # few enough for the rows to stay in the processor's cache
        b = min(len(lengths), a + 200)
        out[a:b] = np.add.reduceat(np.take(table, rows[bounds[a] : bounds[b]], axis=0), bounds[a:b] - bounds[a], axis=0)
    return out


@dataclass
class SubjectModel:
    """Log ratios of each subject's model to the background's, for known words and pairs of words."""

    codes: list[str]
    index: Index
    ratios: np.ndarray  # (rows of the index, subjects)
    margins: np.ndarray  # (subjects,)

    def assign(self, texts: list[str | None]) -> list[list[str]]:
        """Subjects of each text, in the order of their codes."""
        hashes, lengths, per_text = encode(texts)
        return self.assign_rows(self.index.rows(hashes, lengths), lengths, per_text)

    def assign_rows(self, rows: np.ndarray, lengths: np.ndarray, per_text: np.ndarray) -> list[list[str]]:
        if not len(lengths) or not self.codes:
            return [[] for _ in per_text]
        s = _sums(self.ratios, rows, lengths) / lengths[:, None]
        best = s.argmax(axis=1)
        about = s[np.arange(len(s)), best] > self.margins[best]
        owner = np.repeat(np.arange(len(per_text)), per_text)
        counts = np.bincount(owner[about] * len(self.codes) + best[about], minlength=len(per_text) * len(self.codes)).reshape(len(per_text), -1)
        enough = (counts > 0) & (counts >= LEAST_SHARE * per_text[:, None] - 1e-9)
        return [[self.codes[j] for j in np.flatnonzero(row)] for row in enough]


def add_expected(block: Block, tables: np.ndarray, out: np.ndarray) -> None:
    """Add how often each row is expected under each class of each model; ``tables`` is (rows, models, classes),
    ``out`` (rows, models x classes).

    The first model learns from all documents, the others from one half of the labelled ones and all without labels.
    """
    size, models, classes = tables.shape
    k, n, owner = classes - 1, len(block.per_doc), block.owner
    if not len(block.lengths):
        return
    prior = np.full((n, classes), OTHER_PRIOR, np.float32)
    learns = np.ones((n, models), np.float32)
    unvoted = np.zeros(n, bool)
    for i, found in enumerate(block.labels):
        if found is None:
            prior[i], unvoted[i] = 1.0, True
            continue
        prior[i, found] = 1.0
        prior[i, k] = BACKGROUND_PRIOR if len(found) else 1.0
        learns[i, 1:] = block.halves[i] == np.arange(models - 1)
    score = _sums(tables.reshape(size, -1), block.rows, block.lengths).reshape(-1, models, classes) + np.log(prior)[owner][:, None]
    posterior = _normal(score)
    if unvoted.any():  # what the rest of its document is about counts for a sentence, too
        there = np.flatnonzero(block.per_doc)
        mixture = np.add.reduceat(posterior, _starts(block.per_doc)[there], axis=0, dtype=float) + MIXTURE_FLOOR
        share = np.zeros((n, models, classes), np.float32)
        share[there] = np.log(mixture / mixture.sum(axis=2, keepdims=True))
        share[~unvoted] = 0
        posterior = _normal(score + share[owner])
    posterior *= learns[owner][:, :, None]
    posterior[posterior <= 1e-9] = 0  # rounding
    _add_by_row(posterior.reshape(len(posterior), -1), block.rows, block.lengths, out)


def _add_by_row(values: np.ndarray, rows: np.ndarray, lengths: np.ndarray, out: np.ndarray) -> None:
    """Add to each row of ``out`` the values of the sentences that have it, once for each time."""
    pairs = np.sort(rows << 32 | np.repeat(np.arange(len(lengths)), lengths))
    for a in range(0, len(pairs), 4000):  # few enough for the values to stay in the processor's cache, and for sums of their kind
        part = pairs[a : a + 4000] >> 32
        first = np.flatnonzero(np.diff(part, prepend=-1))
        out[part[first]] += np.add.reduceat(np.take(values, pairs[a : a + 4000] & 0xFFFFFFFF, axis=0), first, axis=0)


def _normal(score: np.ndarray) -> np.ndarray:
    p = np.exp(score - score.max(axis=-1, keepdims=True))
    return p / p.sum(axis=-1, keepdims=True)


def _estimate(counts: np.ndarray, overall: np.ndarray, index: Index) -> np.ndarray:
    """Log probabilities by class from the counts of rows: of words, and of words after the word before them."""
    v = len(index.vocabulary)
    first, second = index.pair_keys // (v + 1), index.pair_keys % (v + 1)
    words_n, pairs_n = counts[: v + 1].copy(), counts[v + 1 :]
    np.add.at(words_n, second, pairs_n)
    # Every model is interpolated with that of the whole corpus: words and pairs that all subjects use decide nothing.
    all_words = overall[: v + 1] + 0.5
    np.add.at(all_words, second, overall[v + 1 :])
    all_words = all_words[:, None]
    base = all_words / all_words.sum()
    own = (words_n + 20 * base) / (words_n.sum(axis=0) + 20)
    unigram = (1 - CORPUS_WEIGHT) * own + CORPUS_WEIGHT * base
    after = words_n[first]
    lam = BIGRAM_WEIGHT * after / (after + 5)
    all_pairs = overall[v + 1 :, None] / np.maximum(all_words[first], 1)
    bigram = lam * pairs_n / np.maximum(after, 1e-9) + (1 - lam) * ((1 - CORPUS_WEIGHT) * unigram[second] + CORPUS_WEIGHT * all_pairs)
    return np.log(np.concatenate((unigram, np.maximum(bigram, 1e-12))))


_GRID = np.arange(0.0, 1.51, 0.05)


def agreement(block: Block, ratios: np.ndarray) -> np.ndarray:
    """(margins + 1, 2, subjects): by margin, assignments that the labels bear out and all; last, documents by label.

    ``ratios`` is (rows, models, subjects). With two models each judges the half that it hasn't learnt from.
    """
    size, models, k = ratios.shape
    out = np.zeros((len(_GRID) + 1, 2, k))
    there = np.array([x is not None for x in block.labels], bool) & (block.per_doc > 0)
    if not there.any() or not k:
        return out
    truth = np.zeros((len(block.per_doc), k), bool)
    for i in np.flatnonzero(there):
        truth[i, block.labels[i]] = True
    owner = block.owner
    s = _sums(ratios.reshape(size, -1), block.rows, block.lengths).reshape(-1, models, k) / block.lengths[:, None, None]
    s = s[np.arange(len(s)), 1 - block.halves[owner] if models == 2 else 0]
    best, top = s.argmax(axis=1), s.max(axis=1)
    out[-1] = truth.sum(axis=0)
    for g, margin in enumerate(_GRID):
        about = (top > margin) & there[owner]
        n = np.bincount(owner[about] * k + best[about], minlength=truth.size).reshape(truth.shape)
        got = (n > 0) & (n >= LEAST_SHARE * block.per_doc[:, None] - 1e-9)
        out[g] = (got & truth).sum(axis=0), got.sum(axis=0)
    return out


def _calibrate(sums: np.ndarray) -> np.ndarray:
    """The margin of each subject at which documents held out agree best with their labels.

    A subject with few of them has the margin that is best for all subjects together.
    """
    right, found, labelled = sums[:-1, 0], sums[:-1, 1], sums[-1, 0]
    if not labelled.any() and not found.any():
        return np.zeros(len(labelled))

    def margin_of(right: np.ndarray, found: np.ndarray, there: float) -> float:
        agreed = 2 * right / np.maximum(1, found + there)
        return float(np.median(_GRID[agreed >= agreed.max() - 0.002]))

    common = margin_of(right.sum(axis=1), found.sum(axis=1), float(labelled.sum()))
    return np.array([margin_of(right[:, j], found[:, j], float(labelled[j])) if labelled[j] >= LEAST_HELD_OUT else common for j in range(len(labelled))])


class _Texts:
    """Documents of a list, with labels as indices of subjects."""

    def __init__(self, docs: list[tuple[str, dict[str, int] | None]], codes: list[str]):
        at = {c: j for j, c in enumerate(codes)}
        labels = [None if votes is None else sorted(at[c] for c in votes if c in at) for _, votes in docs]
        self.hashes, lengths, per_doc = encode([t for t, _ in docs])
        place = np.cumsum([x is not None for x in labels], dtype=np.int64) - 1
        self.block = Block(self.hashes, lengths, per_doc, labels, place % 2)
        self.n_labelled = sum(x is not None for x in labels)

    def word_counts(self, share: float) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = np.unique(self.hashes, return_counts=True)
        kept = counts >= share * len(self.hashes)
        return keys[kept], counts[kept]

    def pair_keys(self, index: Index, share: float) -> np.ndarray:
        if not len(self.hashes):
            return np.zeros(0, np.int64)
        keys, counts = np.unique(index.keys(self.hashes, self.block.lengths)[1], return_counts=True)
        return keys[(keys >= 0) & (counts >= share * len(self.hashes))]

    def prepare(self, index: Index) -> np.ndarray:
        self.block.rows = index.rows(self.hashes, self.block.lengths)
        return np.bincount(self.block.rows, minlength=index.size)

    def _part(self, labelled: bool) -> Block:
        b = self.block
        if not labelled:
            return b
        docs = np.array([x is not None for x in b.labels], bool)
        sents = docs[b.owner]
        return Block(b.rows[np.repeat(sents, b.lengths)], b.lengths[sents], b.per_doc[docs], [x for x in b.labels if x is not None], b.halves[docs])

    def expected(self, tables: np.ndarray, labelled: bool) -> np.ndarray:
        out = np.zeros((len(tables), tables.shape[1] * tables.shape[2]))
        add_expected(self._part(labelled), tables, out)
        return out.reshape(tables.shape)

    def agreement(self, ratios: np.ndarray) -> np.ndarray:
        return agreement(self._part(True), ratios)


def _fit(corpus: _Texts | _Frames, codes: list[str], notes: dict[str, str] | None = None) -> SubjectModel:
    """Models of the words of each subject and of the background, with margins calibrated on labels held out.

    Documents without labels join in after the first rounds, when the models can tell their sentences apart. Without
    any document the models are those of the subjects' notes alone.
    """
    k = len(codes)
    # The subjects' own descriptions are one sentence each, sure to be about their subject.
    fixed = [(codes.index(c), [_hash_of(x.encode()) for x in w]) for c, note in (notes or {}).items() if c in codes for part in note.split(";") if (w := words(part))]
    noted = np.array([h for _, w in fixed for h in w], np.int64)
    lengths = np.array([len(w) for _, w in fixed], np.int64)
    keys, counts = corpus.word_counts(LEAST_OF_WORDS)
    own, own_counts = np.unique(noted, return_counts=True)
    every, at = np.unique(np.concatenate((keys, own)), return_inverse=True)
    index = Index(every[np.bincount(at, np.concatenate((counts, own_counts)), len(every)) >= 2], np.zeros(0, np.int64))
    pairs = index.keys(noted, lengths)[1] if len(noted) else np.zeros(0, np.int64)
    index = Index(index.vocabulary, np.union1d(corpus.pair_keys(index, LEAST_OF_PAIRS), pairs[pairs >= 0]).astype(np.int64))
    rows = index.rows(noted, lengths)
    overall = corpus.prepare(index) + np.bincount(rows, minlength=index.size)
    halves = corpus.n_labelled >= 2 * LEAST_HELD_OUT
    of_notes = np.zeros((index.size, 3 if halves else 1, k + 1))
    np.add.at(of_notes, (rows, slice(None), np.repeat([j for j, _ in fixed], lengths).astype(np.int64)), NOTE_WEIGHT)
    tables = np.zeros(of_notes.shape, np.float32)
    for turn in range(ROUNDS + ROUNDS_OF_ALL):
        found = corpus.expected(tables, turn < ROUNDS) + of_notes
        tables = np.stack([_estimate(found[:, m], overall, index) for m in range(found.shape[1])], axis=1).astype(np.float32)
    ratios = tables[:, :, :k] - tables[:, :, k:]
    # Margins are measured by models of one half of the labels on the other; with too few labels to hold any out, on all.
    margins = _calibrate(corpus.agreement(ratios[:, 1:] if halves else ratios)) if corpus.n_labelled else np.zeros(k)
    return SubjectModel(codes, index, np.ascontiguousarray(ratios[:, 0]), margins)


def train(docs: list[tuple[str, dict[str, int] | None]], codes: list[str], notes: dict[str, str] | None = None) -> SubjectModel:
    """A model of all (text, votes by code) pairs of a list, by the steps of ``fit_and_assign``.

    A code outside ``codes`` votes for no subject, None is for no votes at all. Every other labelled document is held out
    once, in two halves, so all labels take part.
    """
    return _fit(_Texts(docs, codes), codes, notes)


def _votes(labels: DataFrame) -> DataFrame:
    """Documents with labels: how many raters gave each code."""
    code = F.lower(F.trim("subject_code"))
    votes = labels.where(F.col("subject_code").isNotNull()).select("doc_id", code.alias("code"), "rater").distinct().groupBy("doc_id", "code").agg(F.count("*").alias("n"))
    return votes.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("code", "n"))).alias("votes"))


def training_docs(docs: DataFrame, labels: DataFrame, limit: int | None = None, unlabelled: int | None = None) -> list[tuple[str, dict[str, int] | None]]:
    """Documents of a small corpus with their votes, as ``train`` takes them; of either kind at most as many as asked for.

    The list is made on the driver, so queries don't use it: ``fit_and_assign`` learns from tables of any size.
    """
    known = docs.select("doc_id", "text").dropDuplicates(["doc_id"]).join(_votes(labels), "doc_id", "left")
    kinds = [(known.where("votes is not null"), limit), (known.where("votes is null"), unlabelled)]
    rows = [r for kind, most in kinds for r in (kind if most is None else spread_sample(kind, "doc_id", most)).collect()]
    return [(r["text"], {x["code"]: x["n"] for x in r["votes"]} if r["votes"] is not None else None) for r in sorted(rows, key=lambda r: r["doc_id"])]


_PART = 1024  # rows of the models' tables that are added up at once


def _blocks(batches: Iterator[pa.RecordBatch], most: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of (key, words, lengths, ...) of about ``most`` words, with their words, lengths and sentences by document."""
    for batch in batches:
        part = np.cumsum(_sizes(batch, 1)) // most
        for at in np.split(np.arange(len(part)), np.flatnonzero(np.diff(part)) + 1):
            if len(at):
                x = batch.slice(at[0], len(at))
                flat = [np.frombuffer(b"".join(x.column(i).to_pylist()), _PACKED[x.schema.names[i]]).astype(np.int64) for i in (1, 2)]
                yield x, *flat, _sizes(x, 2)


#: Numbers of a document are stored as bytes, which are copied whole, where lists would be taken apart at every step.
_PACKED = {"words": np.dtype("<i8"), "rows": np.dtype("<i4"), "lengths": np.dtype("<i4")}


def _packed(name: str, flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    kind = _PACKED[name]
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((ends * kind.itemsize).astype(np.int32)), pa.py_buffer(flat.astype(kind))])


def _sizes(batch: pa.RecordBatch, column: int) -> np.ndarray:
    """How many numbers each value of a packed column has."""
    return pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(np.int64) // _PACKED[batch.schema.names[column]].itemsize


class _Frames:
    """Documents of a table. Their words are written once as hashes and once as rows of the models' tables."""

    def __init__(self, docs: DataFrame, labels: DataFrame, codes: list[str]):
        self.labels, self.codes, self.spark = labels, codes, docs.sparkSession
        self.kind = docs.schema["doc_id"].dataType.simpleString()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, 1, 1 << 20):
                    hashes, lengths, per_doc = encode(part.column(1).to_pylist())
                    ends = np.cumsum(np.append(0, per_doc))
                    yield pa.RecordBatch.from_arrays([part.column(0), _packed("words", hashes, np.cumsum(np.append(0, lengths))[ends]), _packed("lengths", lengths, ends)], ["doc_id", "words", "lengths"])

        self.hashed = materialize(docs.select("doc_id", "text").where("text is not null").mapInArrow(run, f"doc_id {self.kind}, words binary, lengths binary"), "p9-words")
        self.rows = self.labelled = self.hashed
        self.n_labelled = 0

    def _counted(self, keys_of, share: float) -> tuple[np.ndarray, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, hashes, lengths, _ in _blocks(batches):
                keys, counts = np.unique(keys_of(hashes, lengths), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(counts, pa.int64())], ["key", "n"])

        sums = materialize(self.hashed.mapInArrow(run, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")), "p9-counts")
        total = sums.agg(F.sum("n")).first()[0] or 0
        found = sums.where(F.col("n") >= share * total).orderBy("key").collect()  # at most 1 / share
        return np.array([r["key"] for r in found], np.int64), np.array([r["n"] for r in found], np.int64)

    def word_counts(self, share: float) -> tuple[np.ndarray, np.ndarray]:
        return self._counted(lambda hashes, lengths: hashes, share)

    def pair_keys(self, index: Index, share: float) -> np.ndarray:
        shared = self.spark.sparkContext.broadcast(index)
        keys, _ = self._counted(lambda hashes, lengths: shared.value.keys(hashes, lengths)[1] if len(hashes) else hashes, share)
        return keys[keys >= 0]

    def prepare(self, index: Index) -> np.ndarray:
        shared = self.spark.sparkContext.broadcast(index)
        at = {c: j for j, c in enumerate(self.codes)}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for x, hashes, lengths, _ in _blocks(batches):
                rows = _packed("rows", shared.value.rows(hashes, lengths), np.cumsum(np.append(0, _sizes(x, 1))))
                labels = [None if v is None else sorted(at[c] for c in v if c in at) for v in x.column(3).to_pylist()]
                yield pa.RecordBatch.from_arrays([x.column(0), rows, x.column(2), pa.array(labels, pa.list_(pa.int32())), x.column(4)], ["doc_id", "rows", "lengths", "labels", "half"])

        votes = _votes(self.labels).select("doc_id", F.col("votes.code").alias("codes"))
        half = F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(2)).cast("int")
        known = self.hashed.join(votes, "doc_id", "left").select("doc_id", "words", "lengths", "codes", half.alias("half"))
        self.rows = materialize(known.mapInArrow(run, f"doc_id {self.kind}, rows binary, lengths binary, labels array<int>, half int"), "p9-rows")
        self.labelled = materialize(self.rows.where("labels is not null"), "p9-labelled")
        self.n_labelled = self.labelled.count()
        return self._added(self.rows, lambda block, out: out.__iadd__(np.bincount(block.rows, minlength=len(out))[:, None]), (index.size, 1))[:, 0]

    def _added(self, frame: DataFrame, add, shape: tuple[int, int]) -> np.ndarray:
        """What ``add`` adds to an array of ``shape`` for every block, summed over all tasks."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros(shape)
            for x, rows, lengths, per_doc in _blocks(batches):
                add(Block(rows, lengths, per_doc, x.column(3).to_pylist(), x.column(4).to_numpy(zero_copy_only=False).astype(np.int64)), out)
            for a in range(0, shape[0], _PART):
                if (part := out[a : a + _PART]).any():
                    yield pa.RecordBatch.from_arrays([pa.array([a // _PART], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["part", "sums"])

        def total(part: pa.Table) -> pa.Table:
            sums = sum(np.frombuffer(x.as_buffer()) for x in part.column("sums"))
            return pa.table({"part": pa.array([part.column("part")[0].as_py()], pa.int32()), "sums": pa.array([sums.tobytes()], pa.binary())})

        out = np.zeros(shape)
        for r in frame.mapInArrow(run, "part int, sums binary").groupBy("part").applyInArrow(total, "part int, sums binary").collect():
            out[r["part"] * _PART : (r["part"] + 1) * _PART] = np.frombuffer(r["sums"]).reshape(-1, shape[1])
        return out

    def expected(self, tables: np.ndarray, labelled: bool) -> np.ndarray:
        shared = self.spark.sparkContext.broadcast(tables)
        size, models, classes = tables.shape
        out = self._added(self.labelled if labelled else self.rows, lambda block, out: add_expected(block, shared.value, out), (size, models * classes))
        shared.destroy()
        return out.reshape(tables.shape)

    def agreement(self, ratios: np.ndarray) -> np.ndarray:
        shared = self.spark.sparkContext.broadcast(ratios)
        shape = (len(_GRID) + 1, 2, ratios.shape[2])
        return self._added(self.labelled, lambda block, out: out.__iadd__(agreement(block, shared.value).reshape(-1, 1)), (int(np.prod(shape)), 1)).reshape(shape)

    def assigned(self, model: SubjectModel) -> DataFrame:
        """(doc_id, subject_code) for every subject of every document."""
        shared = self.spark.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for x, rows, lengths, per_doc in _blocks(batches):
                yield _of_keys(x.column(0), shared.value.assign_rows(rows, lengths, per_doc))

        return self.rows.select("doc_id", "rows", "lengths").mapInArrow(run, f"k {self.kind}, subject_code string").withColumnRenamed("k", "doc_id")


def _of_keys(keys: pa.Array, found: list[list[str]]) -> pa.RecordBatch:
    at = [i for i, codes in enumerate(found) for _ in codes]
    return pa.RecordBatch.from_arrays([keys.take(pa.array(at, pa.int64())), pa.array([c for codes in found for c in codes], pa.string())], ["k", "subject_code"])


def assign_subjects(docs: DataFrame, model: SubjectModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, subject_code) for every subject of every document; documents without any give no row.

    Null and blank texts have no subject. Rows of one key are judged alone, and rows alike give one result.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, 1 << 20):
                yield _of_keys(part.column(0), shared.value.assign(part.column(1).to_pylist()))

    return docs.select(F.col(key).alias("k"), F.col(text).alias("v")).where("v is not null").mapInArrow(run, f"k {kind}, subject_code string").withColumnRenamed("k", key)


def fit_and_assign(docs: DataFrame, labels: DataFrame, codes: list[str], notes: dict[str, str] | None = None) -> tuple[SubjectModel, DataFrame]:
    """The model of all documents and labels, and (doc_id, subject_code) by it for every subject of every document."""
    corpus = _Frames(docs, labels, codes)
    model = _fit(corpus, codes, notes)
    return model, corpus.assigned(model).distinct()


def _found(spark: SparkSession, sf_dir: str) -> DataFrame:
    areas = table(spark, sf_dir, "subject_areas").orderBy("subject_code").collect()  # one row for each model: a parameter list
    notes = {r["subject_code"]: f"{r['subject_title']} {r['subject_note']}" for r in areas}
    return fit_and_assign(table(spark, sf_dir, "documents"), table(spark, sf_dir, "subject_labels"), [r["subject_code"] for r in areas], notes)[1]


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _found(spark, sf_dir)


def p9_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by subject, and their share of all documents."""
    n = table(spark, sf_dir, "documents").agg(F.count_distinct("doc_id")).first()[0]
    found = _found(spark, sf_dir).groupBy("subject_code").agg(F.count("*").alias("n_documents"))
    return found.withColumn("share", F.round(F.col("n_documents") / F.lit(n), 6))


QUERIES = {"p9_found": p9_found, "p9_composition": p9_composition}
SQL: dict[str, str] = {}
