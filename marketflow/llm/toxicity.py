"""Toxicity of texts: a bidirectional gated recurrent network over overlapping windows of words.

Each word is read at two levels: the evidence of the whole word and of its runs of five characters,
as surplus in toxic documents of the learning sample, in standard deviations (counts of other documents
only while learning, so that a word seen once is not mistaken for proof; equal contexts count once).  The network reads windows of 32 words,
each starting 24 words after the one before, and pools its states by attention.  Every window of the
whole text is scored; a logistic regression on the worst window, the expected number and the share of
bad windows and the length gives the document's score, so that one chance word in a long text weighs
little where the language's insults come in numbers.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.llm import gru
from marketflow.llm.blocks import BYTE_BASE, mix, prefix_sums, range_hashes, text_slices, words
from marketflow.llm.samples import labelled_sample
from marketflow.llm.shipping import arrow_map

WINDOW, STRIDE = 32, 24
GRAM = 5
THRESHOLD = 0.3
#: The fewest times a piece of evidence must be seen.
LEAST_SEEN = 3
#: Learning goes on for as many batches at least, however few windows there are.
LEAST_BATCHES = 400
FEATURES, HIDDEN, ATTENTION = 5, 8, 8

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Marks that are stripped from both ends of a word before it is read.
EDGE = np.zeros(256, bool)
EDGE[list(b".,;:!?\"'()[]{}<>*_-#$%&|~`/\\=+@^")] = True


def strip_marks(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word bounds without marks at either end; a word of marks only keeps its bounds."""
    if not len(starts):
        return starts, ends
    real = np.flatnonzero(~EDGE[data])
    a = np.searchsorted(real, starts)
    b = np.searchsorted(real, ends)
    some = b > a
    at = np.minimum(a, max(len(real) - 1, 0))
    last = np.maximum(b - 1, 0)
    if not len(real):
        return starts, ends
    return np.where(some, real[at], starts), np.where(some, real[last] + 1, ends)


def word_parts(data: np.ndarray, offsets: np.ndarray):
    """Lower-case words of a block: the distinct words' hashes and their runs of characters.

    Returns (first word of each document, place of each word among the distinct ones, hashes of the
    distinct words, hashes of all their runs, first run of each distinct word).
    """
    data = LOWER[data]
    starts, ends, first = words(data, offsets)
    starts, ends = strip_marks(data, starts, ends)
    sums = prefix_sums(data.astype(np.uint64) + np.uint64(1), BYTE_BASE)
    hashes, example, place = np.unique(
        range_hashes(sums, starts, ends, BYTE_BASE), return_index=True, return_inverse=True
    )
    a, b = starts[example], ends[example]
    n_runs = np.maximum(b - a - GRAM + 1, 0)
    at = np.concatenate([[0], np.cumsum(n_runs)])
    begin = np.repeat(a, n_runs) + np.arange(at[-1]) - np.repeat(at[:-1], n_runs)
    runs = range_hashes(sums, begin, begin + GRAM, BYTE_BASE) if len(begin) else np.zeros(0, np.uint64)
    return first, place, hashes, runs ^ np.uint64(0x5851F42D4C957F2D), at


class Evidence:
    """Surplus of hashes, in a table that compares 32 further bits of the hash."""

    def __init__(self, hashes: np.ndarray, odds: np.ndarray, bits: int = 20):
        self.mask = np.uint64((1 << bits) - 1)
        self.check = np.zeros(1 << bits, np.uint32)
        self.odds = np.zeros(1 << bits, np.float32)
        order = np.argsort(np.abs(odds), kind="stable")  # the strongest of those that meet stays
        h, o = mix(hashes[order]), odds[order]
        self.check[h & self.mask] = (h >> np.uint64(32)).astype(np.uint32)
        self.odds[h & self.mask] = o

    def get(self, hashes: np.ndarray) -> np.ndarray:
        h = mix(hashes)
        at = h & self.mask
        return np.where(self.check[at] == (h >> np.uint64(32)).astype(np.uint32), self.odds[at], np.float32(0))


def word_features(words_odds: np.ndarray, run_odds: np.ndarray, at: np.ndarray) -> np.ndarray:
    """FEATURES numbers of each distinct word."""
    n = len(words_odds)
    x = np.zeros((n, FEATURES), np.float32)
    x[:, 0] = np.clip(words_odds, -4, 16) / 4
    filled = np.flatnonzero(np.diff(at) > 0)
    if len(filled):
        begin = at[filled]
        count = np.diff(at)[filled]
        x[filled, 1] = np.clip(np.maximum.reduceat(run_odds, begin), -4, 16) / 4
        x[filled, 2] = np.clip(np.add.reduceat(run_odds, begin) / count, -4, 16) / 4
        x[filled, 3] = np.clip(np.minimum.reduceat(run_odds, begin), -4, 16) / 4
    x[:, 4] = (words_odds != 0).astype(np.float32)
    return x


def windows_of(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first word, words) of all windows; the last ends with the document."""
    n = np.diff(first)
    more = np.maximum(n - WINDOW, 0)
    count = np.where(n > 0, -(-more // STRIDE) + 1, 0)
    doc = np.repeat(np.arange(len(n)), count)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    begin = np.minimum(k * STRIDE, more[doc])
    return doc, first[:-1][doc] + begin, np.minimum(n[doc], WINDOW)


def window_places(place: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = begin[:, None] + np.arange(WINDOW)
    mask = np.arange(WINDOW) < size[:, None]
    return place[np.minimum(at, len(place) - 1)], mask


@dataclass
class ToxicityModel:
    params: gru.Params
    word_hashes: np.ndarray
    word_odds: np.ndarray
    run_hashes: np.ndarray
    run_odds: np.ndarray
    pooling: np.ndarray

    def tables(self) -> tuple[Evidence, Evidence]:
        return Evidence(self.word_hashes, self.word_odds), Evidence(self.run_hashes, self.run_odds)


def pooled_windows(
    params: gru.Params, projected: dict, place: np.ndarray, first: np.ndarray, most: int = 4096
) -> np.ndarray:
    """Per document: 1, the largest logit, log of the expected bad windows, their share, log of the words."""
    n = len(first) - 1
    top, total, count = np.full(n, -12.0), np.zeros(n), np.zeros(n)
    doc, begin, size = windows_of(first)
    for a in range(0, len(doc), most):
        places, mask = window_places(place, begin[a : a + most], size[a : a + most])
        logit = gru.forward(params, projected, places, mask).astype(np.float64)
        d = doc[a : a + most]
        np.maximum.at(top, d, logit)
        total += np.bincount(d, weights=gru.sigmoid(logit), minlength=n)
        count += np.bincount(d, minlength=n)
    share = total / np.maximum(count, 1)
    return np.stack(
        [np.ones(n), np.clip(top, -12, 12) / 6, np.log(total + 0.01), 2 * np.sqrt(share), np.log1p(np.diff(first)) / 3], axis=1
    )


def score_block(model: ToxicityModel, tables, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The score of each document of a block; 0 for one without words."""
    first, place, hashes, runs, at = word_parts(data, offsets)
    if not len(place):
        return np.zeros(len(offsets) - 1)
    x = word_features(tables[0].get(hashes), tables[1].get(runs), at)
    pooled = pooled_windows(model.params, gru.project(model.params, x), place, first)
    return np.where(np.diff(first) > 0, gru.sigmoid(pooled @ model.pooling), 0.0)


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.3, rounds: int = 50) -> np.ndarray:
    """Weighted logistic regression by Newton steps; the first column is the constant, free of the ridge."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-3
    for _ in range(rounds):
        p = gru.sigmoid(x @ w)
        slope = x.T @ (weight * (y - p)) - penalty * w
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(bend, slope)
        w += step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w


def _surplus(n1: np.ndarray, n0: np.ndarray) -> np.ndarray:
    """By how many standard deviations a key is seen more often in toxic documents than its share."""
    share = n1.sum() / max(1, n1.sum() + n0.sum())
    expected = (n1 + n0) * share
    z = (n1 - expected) / np.sqrt(expected * (1 - share) + 0.25)
    return np.where(n1 + n0 >= LEAST_SEEN, z, 0.0).astype(np.float32)


class Vocabulary:
    """The words of a learning sample: where they stand, what surrounds them and their runs."""

    def __init__(self, column: pa.Array):
        self.blocks = []
        hashes, runs, sizes, docs, contexts, words_ = [], [], [], [], [], []
        for a, b, data, at in text_slices(column):
            first, place, own, own_runs, run_at = word_parts(data, at)
            h = own[place]
            before, after = np.roll(h, 1), np.roll(h, -1)
            some = np.diff(first) > 0
            before[first[:-1][some]] = after[first[1:][some] - 1] = 0
            self.blocks.append((a, first, place, own, own_runs, run_at))
            hashes.append(own)
            runs.append(own_runs)
            sizes.append(np.diff(run_at))
            words_.append(h)
            docs.append(a + np.repeat(np.arange(b - a), np.diff(first)))
            contexts.append(mix(mix(before) + after))
        every, size = np.concatenate(hashes), np.concatenate(sizes)
        begin = np.cumsum(size) - size
        self.words, example = np.unique(every, return_index=True)
        n = size[example]
        at = np.repeat(begin[example] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        self.runs, self.run_of = np.unique(np.concatenate(runs)[at], return_inverse=True)
        self.word_of_run = np.repeat(np.arange(len(self.words)), n)
        self.word = np.searchsorted(self.words, np.concatenate(words_)).astype(np.int32)
        self.doc = np.concatenate(docs).astype(np.int32)
        self.context = np.concatenate(contexts)

    def evidence(self, label: np.ndarray, chosen: np.ndarray) -> tuple[Evidence, Evidence, tuple]:
        """Surplus of words and of runs in the chosen documents.

        A word counts for a label as often as it has documents or contexts, whichever are fewer: neither
        one document that repeats a word nor copies of one text prove much.  A run counts as its words do.
        """
        n = []
        for side in (1, 0):
            mine = np.flatnonzero((label[self.doc] == side) & chosen[self.doc])
            word = self.word[mine]
            salt = mix(word.astype(np.uint64) + np.uint64(1))
            counts = []
            for other in (self.context[mine], self.doc[mine].astype(np.uint64)):
                _, once = np.unique(salt + other, return_index=True)
                counts.append(np.bincount(word[once], minlength=len(self.words)))
            n.append(np.minimum(*counts))
        word_surplus = _surplus(*n)
        by_run = [np.bincount(self.run_of, weights=x[self.word_of_run], minlength=len(self.runs)) for x in n]
        run_surplus = _surplus(*by_run)
        w, r = word_surplus != 0, run_surplus != 0
        kept = (self.words[w], word_surplus[w], self.runs[r], run_surplus[r])
        return Evidence(*kept[:2]), Evidence(*kept[2:]), kept


def fit_toxicity(texts: list[str], labels: list[int], share: float | None = None, epochs: int = 5) -> ToxicityModel:
    """Learn from a sample of texts in the driver's memory; ``share`` of all texts are toxic (the sample's share).

    Without both labels in the sample nothing can be learned: every score is then near zero.
    """
    once = dict(zip(texts, labels))  # copies of a text are no further proof
    column = pa.array(list(once), pa.string())
    label = np.array(list(once.values()), np.float64)
    params = gru.init(FEATURES, HIDDEN, ATTENTION)
    params["o0"][:] = -3.0
    none = np.zeros(0, np.uint64), np.zeros(0, np.float32)
    if not len(label) or label.min() == label.max():
        return ToxicityModel(params, *none, *none, np.array([-12.0, 0, 0, 0, 0]))

    vocabulary = Vocabulary(column)
    # learning windows read evidence gathered from the other half of the documents
    fold = np.arange(len(label)) % 2
    x_all, at_all, mask_all, y_all = [], [], [], []
    rows, halves = 0, []
    for side in (0, 1):
        *tables, _ = vocabulary.evidence(label, fold != side)
        for a, first, place, hashes, runs, run_at in vocabulary.blocks:
            x = word_features(tables[0].get(hashes), tables[1].get(runs), run_at)
            halves.append((side, a, x, place, first))
            w_doc, begin, size = windows_of(first)
            mine = fold[a + w_doc] == side
            w_doc, begin, size = w_doc[mine], begin[mine], size[mine]
            if not len(w_doc):
                continue
            places, mask = window_places(place, begin, size)
            weight = np.where(mask, np.maximum(x[places, 0], x[places, 1]), -9).max(axis=1)
            y = label[a + w_doc]
            top = np.full(len(first) - 1, -9.0)
            np.maximum.at(top, w_doc, weight)
            # of a toxic document only its most telling windows are sure to be toxic
            chosen = np.where(y > 0, weight >= top[w_doc] - 1e-6, True)
            x_all.append(x)
            at_all.append(places[chosen] + rows)
            mask_all.append(mask[chosen])
            y_all.append(y[chosen])
            rows += len(x)
    x, at, mask = np.concatenate(x_all), np.concatenate(at_all), np.concatenate(mask_all)
    y = np.concatenate(y_all).astype(np.float32)
    # only the rows that windows use
    used, at = np.unique(at, return_inverse=True)
    x, at = x[used], at.reshape(mask.shape)
    few = np.unique(np.round(x, 2), axis=0, return_inverse=True)
    x, at = few[0].astype(np.float32), few[1].reshape(-1)[at]
    epochs = max(epochs, -(-LEAST_BATCHES * 256 // len(y)))
    params = gru.train(params, x, at, mask, y, epochs=min(epochs, LEAST_BATCHES))
    pooled = np.zeros((len(label), 5))
    for side, a, x, place, first in halves:
        part = pooled_windows(params, gru.project(params, x), place, first)
        mine = np.flatnonzero(fold[a : a + len(part)] == side)
        pooled[a + mine] = part[mine]
    in_sample = label.mean()
    share = in_sample if share is None else min(max(share, 1e-4), 1 - 1e-4)
    weight = np.where(label > 0, share / in_sample, (1 - share) / (1 - in_sample))
    *_, kept = vocabulary.evidence(label, np.ones(len(label), bool))
    return ToxicityModel(params, *kept, fit_logistic(pooled, label, weight))


def held_out() -> Column:
    """Rows that no label is learned from; a null doc_id is not held out, and has no label."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def learn_toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = 2_000, most_chars: int = 20_000) -> ToxicityModel:
    """A model from up to ``sample_rows`` labelled documents per label of at most ``most_chars`` characters."""
    sample = labelled_sample(
        docs.where(F.length("text") <= most_chars), labels.select("doc_id", "toxic"), "toxic", sample_rows, ~held_out()
    )
    rows = sample.select("doc_id", "text", "toxic").orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    share = labels.where(~held_out()).agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0]
    return fit_toxicity([r["text"] for r in rows], [int(r["toxic"] == 1) for r in rows], share)


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of ``docs``.

    Null, empty and wordless texts score 0.  Repeated rows score alike; other columns are ignored.
    There is no shuffle.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)  # bounded by the learning sample

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = None
        for batch in batches:
            tables = tables or sent.value.tables()
            parts = [score_block(sent.value, tables, d, at) for _, _, d, at in text_slices(batch.column(1))]
            if parts:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(parts))], ["doc_id", "score"])

    scored = arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), score, "doc_id long, score double")
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def drop_toxic(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at_text = docs.columns.index("text")

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = None
        for batch in batches:
            tables = tables or sent.value.tables()
            parts = [score_block(sent.value, tables, d, at) for _, _, d, at in text_slices(batch.column(at_text))]
            if parts:
                yield batch.filter(pa.array(np.concatenate(parts) < THRESHOLD))

    return arrow_map(docs, keep, docs.schema)
