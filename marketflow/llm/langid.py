"""Language of texts by cross-parsing: the language whose labelled text needs the fewest phrases wins.

A suffix automaton of each language's learning text accepts exactly its substrings.  A text is read
through it from the left; where no longer match exists a phrase ends and the next begins.  Few
phrases mean long matches, hence low cross entropy.  Counts are normalised by what held-back text of
the language itself needs per symbol, so that languages with richer texts do not lose.

Every letter of any script that stands in a learning text is a symbol of its own.  Steps by the most
frequent letters are looked up in a dense table, steps by all others in sorted arrays of edges, so that
thousands of letters cost memory only where the automata have such edges.

Texts are read in blocks of a fixed number of symbols (a block's end ends a phrase), all blocks of an
Arrow batch and all languages side by side, one symbol at a time.
"""

from __future__ import annotations

import collections
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.llm.blocks import text_slices
from marketflow.llm.quality import IS_CONTINUATION
from marketflow.llm.samples import labelled_sample
from marketflow.llm.shipping import arrow_map

UNKNOWN = "und"
BLOCK = 512
#: Symbols: everything that is no letter, letters of no learning text, padding, then letters by frequency.
GAP, OTHER, PAD, FIRST = 0, 1, 2, 3
#: Letters of the dense table; the column after them stands for all others.
DENSE = 48
#: Set in a step that begins a phrase.
BEGINS = np.uint32(1 << 31)
#: Edges are sorted by state and symbol as one number; symbols are fewer than the code points.
SYMBOL_BITS = 21


@dataclass
class LanguageModel:
    """What is learned: per language its learning text and its own phrases per symbol."""

    languages: list[str]
    texts: list[str]
    rates: list[float]


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton of all substrings; state 0 is the start."""
    follow: list[dict[int, int]] = [{}]
    length, link = [0], [-1]
    last = 0
    for c in symbols:
        now = len(follow)
        follow.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in follow[p]:
            follow[p][c] = now
            p = link[p]
        if p >= 0:
            q = follow[p][c]
            if length[p] + 1 == length[q]:
                link[now] = q
            else:
                copy = len(follow)
                follow.append(dict(follow[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and follow[p].get(c) == q:
                    follow[p][c] = copy
                    p = link[p]
                link[q] = link[now] = copy
        last = now
    return follow


class CrossParser:
    """Counts phrases of many blocks in all languages at once."""

    def __init__(self, texts: list[str]):
        self.symbol = np.full(0x110000, GAP, np.int32)
        alpha = [i for i in range(0x110000) if chr(i).isalpha()]
        self.symbol[alpha] = OTHER
        lower = {i: chr(i).lower() if len(chr(i).lower()) == 1 else chr(i) for i in alpha}
        seen = collections.Counter(lower[ord(c)] for t in texts for c in t if ord(c) in lower)
        code = {c: FIRST + k for k, (c, _) in enumerate(sorted(seen.items(), key=lambda x: (-x[1], x[0])))}
        for i, c in lower.items():
            if c in code:
                self.symbol[i] = code[c]
        self.rare = FIRST + min(len(code), DENSE)
        self.width = self.rare + (len(code) > DENSE)
        tables, self.base = [], []
        edges: list[tuple[int, int]] = []
        rows = 0
        for text in texts:
            follow = suffix_automaton(self.symbols(text).tolist())
            table = np.empty((len(follow), self.width), np.uint32)
            root = np.zeros(self.width, np.uint32)
            for c, s in follow[0].items():
                if c < self.rare:
                    root[c] = s
            # a missing step ends the phrase, and this symbol begins the next; what cannot begin one
            # in this language is a phrase by itself, after which the start state is reached
            table[:] = (root + rows) * np.uint32(self.width) | BEGINS
            for s, steps in enumerate(follow):
                for c, to in steps.items():
                    if c < self.rare:
                        table[s, c] = (to + rows) * self.width
                    else:
                        edges.append(((s + rows) << SYMBOL_BITS | c, (to + rows) * self.width))
            table[0] |= BEGINS  # from the start state every symbol begins a phrase
            table[:, PAD] = (np.arange(len(follow)) + rows) * self.width
            tables.append(table)
            self.base.append(rows * self.width)
            rows += len(follow)
        if rows * self.width >= 1 << 31:
            raise ValueError("too much learning text for the step table")
        self.table = np.concatenate(tables).reshape(-1) if tables else np.zeros(0, np.uint32)
        edges.sort()
        self.edge = np.array([e for e, _ in edges], np.int64)
        self.target = np.array([t for _, t in edges], np.uint32)

    def _edges(self, state: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Steps by letters outside the dense table: the states reached, and whether there is such a step."""
        key = (state.astype(np.int64) // self.width) << SYMBOL_BITS | symbol
        at = np.minimum(np.searchsorted(self.edge, key), len(self.edge) - 1)
        return self.target[at], self.edge[at] == key

    def _rare_steps(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """As the table's steps, of states (language, place) and the symbol of each place."""
        start = np.array(self.base, np.uint32)[:, None]
        symbol = np.broadcast_to(symbol, state.shape)
        to, there = self._edges(state, symbol)
        again, begins = self._edges(np.broadcast_to(start, state.shape), symbol)
        fresh = np.where(begins, again, start) | BEGINS
        return np.where(there & (state != start), to, fresh)

    def symbols(self, text: str) -> np.ndarray:
        """Symbols of a text; a run of non-letters is one gap."""
        s = self.symbol[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
        keep = np.ones(len(s), bool)
        keep[1:] = (s[1:] != GAP) | (s[:-1] != GAP)
        return s[keep]

    def count(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phrases (language, document), symbols and letters of each document of a block of texts."""
        n = len(offsets) - 1
        points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32)
        begin = np.concatenate([[0], np.cumsum(~IS_CONTINUATION[data], dtype=np.int64)])[offsets]
        s = self.symbol[points]
        is_letter = s != GAP
        keep = is_letter.copy()
        keep[1:] |= is_letter[:-1]
        if len(keep):
            keep[0] = True
        keep[begin[:-1][begin[:-1] < len(s)]] = True
        kept = np.concatenate([[0], np.cumsum(keep, dtype=np.int64)])[begin]
        letters = np.concatenate([[0], np.cumsum(is_letter, dtype=np.int64)])[begin]
        s = s[keep]
        size = np.diff(kept)
        blocks = -(-size // BLOCK)
        doc = np.repeat(np.arange(n), blocks)
        k = np.arange(len(doc)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        start = kept[:-1][doc] + k * BLOCK
        phrases = np.zeros((len(self.base), n), np.int64)
        languages = np.array(self.base, np.uint32)[:, None]
        for a in range(0, len(doc), 8192):
            first, d = start[a : a + 8192], doc[a : a + 8192]
            end = np.minimum(first + BLOCK, kept[1:][d])
            steps = int((end - first).max())
            at = first[None, :] + np.arange(steps)[:, None]
            grid = np.where(at < end, s[np.minimum(at, len(s) - 1)], PAD)
            state = np.repeat(languages, len(first), axis=1)
            count = np.zeros(state.shape, np.uint32)
            rare_rows = (grid >= self.rare).any(axis=1)
            dense = np.minimum(grid, self.rare).astype(np.uint32)
            for k, row in enumerate(dense):
                step = self.table.take(state + row)
                if rare_rows[k]:
                    some = np.flatnonzero(grid[k] >= self.rare)
                    step[:, some] = self._rare_steps(state[:, some], grid[k, some])
                count += step >> np.uint32(31)
                state = step & ~BEGINS
            for j in range(len(languages)):
                phrases[j] += np.bincount(d, weights=count[j], minlength=n).astype(np.int64)
        return phrases, size, np.diff(letters)


def decide(model: LanguageModel, phrases: np.ndarray, size: np.ndarray, letters: np.ndarray):
    """Predicted language and score of each document; the score is 1 - best / second best."""
    n = len(size)
    if not model.languages or not n:
        return [UNKNOWN] * n, np.zeros(n)
    rate = phrases / np.maximum(size, 1) / np.array(model.rates)[:, None]
    best = np.argmin(rate, axis=0)
    ranked = np.sort(rate, axis=0)
    score = 1 - ranked[0] / ranked[1] if len(ranked) > 1 else np.ones(n)
    some = letters > 0
    return [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, some)], np.where(some, score, 0.0)


def fit_languages(texts: dict[str, list[str]], learned_chars: int = 32_000, all_chars: int = 384_000) -> LanguageModel:
    """Learning text from pieces of all texts but every fifth, ``learned_chars`` characters of each language
    and ``all_chars`` of all together; rates from every fifth text, whole."""
    languages, learned, tests = [], [], []
    usable = {name: [t for t in texts[name] if any(c.isalpha() for c in t)] for name in sorted(texts)}
    usable = {name: own for name, own in usable.items() if own}
    each = min(learned_chars, max(200, all_chars // max(1, len(usable))))
    for name, own in usable.items():
        kept_back = own[4::5] or own
        used = [t for i, t in enumerate(own) if i % 5 != 4]
        piece = max(40, each // max(1, len(used)))
        languages.append(name)
        learned.append(" ".join(t[(len(t) - piece) // 2 if len(t) > piece else 0 :][:piece] for t in used)[:each])
        tests.append(kept_back[:60])
    model = LanguageModel(languages, learned, [1.0] * len(languages))
    parser = CrossParser(learned)
    for j, own in enumerate(tests):
        phrases = symbols = 0
        for _, _, data, at in text_slices(pa.array(own, pa.string())):
            p, size, _ = parser.count(data, at)
            phrases, symbols = phrases + int(p[j].sum()), symbols + int(size.sum())
        model.rates[j] = max(phrases, 1) / max(symbols, 1)
    return model


def held_out() -> Column:
    """Rows that no language is learned from; a null doc_id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def learn_languages(docs: DataFrame, sample_rows: int = 250, most_chars: int = 20_000) -> LanguageModel:
    """From up to ``sample_rows`` documents of each language (fewer where there are more than 64 languages, one
    at least); of a longer document pieces of ``most_chars`` characters in all, spread over it, are taken.
    Documents of 100 to ``most_chars`` characters come first, others where a language has too few of them.
    Rows without text, lang or doc_id teach nothing."""
    fit = docs.where(F.col("text").isNotNull()).select("doc_id", "lang", "text", F.length("text").alias("size"))
    odd = ~F.col("size").between(100, most_chars)
    sample = labelled_sample(fit, fit.select("doc_id", "lang", odd.alias("odd")), "lang", sample_rows, ~held_out(), "odd")
    texts: dict[str, list[str]] = {}

    def shortened(text: Column) -> Column:
        quarter = most_chars // 4
        step = ((F.length(text) - quarter) / 3).cast("int")
        pieces = [F.substr(text, step * k + 1, F.lit(quarter)) for k in range(4)]
        return F.when(F.length(text) > most_chars, F.concat_ws(" ", *pieces)).otherwise(text)

    sample = sample.withColumn("text", shortened(F.col("text")))
    for r in sample.orderBy(F.xxhash64("doc_id"), "doc_id").collect():
        texts.setdefault(r["lang"], []).append(r["text"])
    return fit_languages(texts)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, held_out, lang_pred, score), one row per row of ``docs``, from its text alone.

    Null texts and texts without a letter are ``und`` with score 0; so is every text when nothing was
    learned.  Ties go to the language first in the alphabet.  Other columns are ignored; no shuffle.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the learning sample

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = None
        for batch in batches:
            parser = parser or shared_parser(sent.value)
            names, scores = [], []
            for _, _, data, at in text_slices(batch.column(1), 4 << 20):
                name, score = decide(sent.value, *parser.count(data, at))
                names += name
                scores.append(score)
            if names:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(names), pa.array(np.concatenate(scores))], ["doc_id", "lang_pred", "score"]
                )

    read_out = arrow_map(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), read,
        "doc_id long, lang_pred string, score double",
    )
    return read_out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


_parsers: dict[tuple, CrossParser] = {}


def shared_parser(model: LanguageModel) -> CrossParser:
    """The parser of a model, built once for each Python worker."""
    key = tuple(model.texts)
    if key not in _parsers:
        _parsers.clear()
        _parsers[key] = CrossParser(model.texts)
    return _parsers[key]
