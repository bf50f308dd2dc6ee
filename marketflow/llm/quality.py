"""Quality rules: base statistics of whole texts, and a learned list of threshold rules.

The list is learned by sequential covering.  On two thirds of the labelled rows a conjunction of
thresholds is grown, test by test, by the gain in information about the bad class; on the other third
its last tests are pruned while (p - n) / (p + n) does not fall.  A rule that stays precise on that
third joins the list, what it covers is taken out, and the next is grown.  The list becomes one Spark
conditional expression over the statistics.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.llm.blocks import covered, gram_hashes, mix, runs, text_slices, word_hashes, words
from marketflow.llm.samples import labelled_sample
from marketflow.llm.shipping import arrow_map

# Fixed values of the base statistics.
SYMBOLS = b"#*$%&|<>"
REPEAT_WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_lines", "n_upper", "n_ascii_letters", "n_digits", "n_marks", "n_distinct_words", "longest_word")
STATS = "doc_id long, " + ", ".join(f"{c} long" for c in BASE + MORE)


def _flags(characters: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters)] = True
    return out


IS_SYMBOL = _flags(SYMBOLS)
IS_UPPER = _flags(bytes(range(65, 91)))
IS_LETTER = _flags(bytes([*range(65, 91), *range(97, 123)]))
IS_DIGIT = _flags(bytes(range(48, 58)))
IS_MARK = _flags(b"!?.,;:-_=+/\\()[]{}\"'`~@^")
IS_CONTINUATION = _flags(bytes(range(0x80, 0xC0)))


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _same_before(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: is there an equal one earlier; is there another equal one at all."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    equal = np.zeros(len(keys) + 1, bool)
    equal[1:-1] = ranked[1:] == ranked[:-1]
    earlier, any_other = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    earlier[order] = equal[:-1]
    any_other[order] = equal[:-1] | equal[1:]
    return earlier, any_other


def block_statistics(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The columns BASE + MORE of a block of texts."""
    n = len(offsets) - 1
    starts, ends, first = words(data, offsets)
    n_words = np.diff(first)
    in_word = np.zeros(len(data) + 1, np.int8)
    in_word[starts] += 1
    np.subtract.at(in_word, ends, 1)
    in_word = np.cumsum(in_word[:-1], dtype=np.int8).astype(bool)
    characters = ~IS_CONTINUATION[data]

    hashes = word_hashes(data, starts, ends)
    doc = np.repeat(np.arange(n), n_words)
    salt = mix(np.arange(1, n + 1, dtype=np.uint64))
    grams = gram_hashes(hashes, REPEAT_WINDOW)
    whole = np.flatnonzero(doc[: len(grams)] == doc[REPEAT_WINDOW - 1 :]) if len(grams) else np.zeros(0, np.int64)
    _, repeated = _same_before(grams[whole] ^ salt[doc[whole]])
    inside = covered(whole[repeated], REPEAT_WINDOW, len(starts))
    n_repeat = _sums(inside, first)

    line_starts, line_ends = runs(data != 10, offsets)
    filled = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_starts, line_ends = line_starts[filled], line_ends[filled]
    line_doc = np.searchsorted(offsets, line_starts, "right") - 1
    lines = word_hashes(data, line_starts, line_ends) ^ salt[line_doc]
    again, _ = _same_before(lines)

    word_again, _ = _same_before(hashes ^ salt[doc])
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, doc, ends - starts)
    return [
        n_words, _sums(in_word & characters, offsets), _sums(IS_SYMBOL[data], offsets),
        np.bincount(line_doc[again], minlength=n), n_repeat,
        np.bincount(line_doc, minlength=n), _sums(IS_UPPER[data], offsets), _sums(IS_LETTER[data], offsets),
        _sums(IS_DIGIT[data], offsets), _sums(IS_MARK[data], offsets),
        n_words - np.bincount(doc[word_again], minlength=n), longest,
    ]


def text_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of each whole text, one row per row of ``docs``.

    A null or empty text, or one of separators only, counts zero everywhere.  Other columns are
    ignored.  There is no shuffle; a task holds one Arrow batch and works on about 1 MB at a time.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [block_statistics(d, at) for _, _, d, at in text_slices(batch.column(1))]
            if parts:
                columns = [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*parts)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *BASE, *MORE])

    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), count, STATS)


def base_failed() -> Column:
    """True for fewer than 10 words, or if over 20 % of the words are in repeated windows."""
    return (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )


def ratios() -> dict[str, Column]:
    """What the rules may test, all free of the text's length."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    letters = F.greatest(F.col("n_ascii_letters"), F.lit(1)).cast("double")
    return {
        "mean_word": F.col("word_chars") / n,
        "symbols_per_word": F.col("n_symbols") / n,
        "marks_per_word": F.col("n_marks") / n,
        "digits_per_word": F.col("n_digits") / n,
        "upper_share": F.col("n_upper") / letters,
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)).cast("double"),
        "repeat_share": F.col("n_repeat_words") / n,
        "distinct_share": F.col("n_distinct_words") / n,
        "longest_word": F.col("longest_word").cast("double"),
        "words": F.col("n_words").cast("double"),
    }


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    threshold: float

    def column(self, features: dict[str, Column]) -> Column:
        c = features[self.feature]
        return c > self.threshold if self.above else c <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Test, ...]


def _hits(rule: Rule, table: dict[str, np.ndarray]) -> np.ndarray:
    out = np.ones(len(next(iter(table.values()))), bool)
    for t in rule:
        out &= table[t.feature] > t.threshold if t.above else table[t.feature] <= t.threshold
    return out


def _with_margins(rule: list[Test], table: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray) -> list[Test]:
    """Thresholds moved halfway to the nearest covered bad value, which covers the same bad rows."""
    inside, out = rows & bad & _hits(tuple(rule), table), []
    for t in rule:
        v = table[t.feature]
        if not inside.any():
            return rule
        near = float(v[inside].min() if t.above else v[inside].max())
        far = v[rows & ((v <= t.threshold) if t.above else (v > t.threshold))]
        edge = float(far.max() if t.above else far.min()) if len(far) else t.threshold
        out.append(Test(t.feature, t.above, edge + (near - edge) / 2))
    return out


def learn_decision_list(
    table: dict[str, np.ndarray],
    bad: np.ndarray,
    most_rules: int = 12,
    most_tests: int = 4,
    cuts: int = 48,
    least_precision: float = 0.9,
    least_hits: int = 3,
) -> list[Rule]:
    """Ordered rules for the bad class; empty when there is no bad or no good row."""
    names, n = sorted(table), len(bad)
    if n == 0 or bad.all() or not bad.any():
        return []
    prune = np.arange(n) % 3 == 2
    points = {f: np.unique(np.quantile(table[f], np.linspace(0, 1, cuts + 2)[1:-1])) for f in names}
    spread = {f: np.unique(np.quantile(table[f][bad], np.linspace(0, 1, cuts + 2)[1:-1])) for f in names}
    points = {f: np.unique(np.concatenate([points[f], spread[f]])) for f in names}
    open_rows, rules = np.ones(n, bool), []
    while len(rules) < most_rules:
        inside = open_rows & ~prune
        if not (bad & inside).any():
            break
        rule: list[Test] = []
        while len(rule) < most_tests and (~bad & inside).any():
            p0, n0 = int((bad & inside).sum()), int((~bad & inside).sum())
            best, best_gain, best_inside = None, 1e-9, None
            for f in names:
                v, b = table[f][inside], bad[inside]
                order = np.sort(v), np.sort(v[b])
                at, at_bad = (np.searchsorted(o, points[f], "right") for o in order)
                for above in (True, False):
                    total = len(v) - at if above else at
                    p = p0 - at_bad if above else at_bad
                    with np.errstate(divide="ignore", invalid="ignore"):
                        gain = p * (np.log2(p / total) - math.log2(p0 / (p0 + n0)))
                    gain = np.where((p > 0) & (total < len(v)), gain, -1.0)
                    k = int(np.argmax(gain))
                    if gain[k] > best_gain:
                        best, best_gain = Test(f, above, float(points[f][k])), float(gain[k])
            if best is None:
                break
            best_inside = inside & _hits((best,), table)
            rule.append(best)
            inside = best_inside
        check = open_rows & prune

        def worth(r: Sequence[Test]) -> float:
            hit = _hits(tuple(r), table) & check
            p, q = int((hit & bad).sum()), int((hit & ~bad).sum())
            return (p - q) / (p + q) if p + q else -1.0

        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule.pop()
        rule = _with_margins(rule, table, bad, open_rows & ~prune)
        hit = _hits(tuple(rule), table)
        p, q = int((hit & check & bad).sum()), int((hit & check & ~bad).sum())
        if not rule or p < least_hits or p / (p + q) < least_precision:
            break
        rules.append(tuple(rule))
        open_rows &= ~hit
    return rules


def fit_rules(docs: DataFrame, labels: DataFrame, sample_rows: int = 6_000) -> list[Rule]:
    """Rules from up to ``sample_rows`` labelled documents of each label (0 bad, 1 good).

    Only numbers reach the driver, a dozen for each sampled document.
    """
    sample = labelled_sample(docs, labels, "quality", sample_rows).select("doc_id", "text")
    known = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    features = ratios()
    rows = (
        text_statistics(sample).where(~base_failed()).join(known, "doc_id")
        .select("doc_id", *[c.alias(f) for f, c in features.items()], "quality")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .toPandas()
    )
    table = {f: rows[f].to_numpy(np.float64) for f in features}
    return learn_decision_list(table, (rows["quality"] == 0).to_numpy())


def verdict(rules: Sequence[Rule]) -> Column:
    """The list as one ordered conditional: false at the first rule that holds, else true."""
    features = ratios()
    tests = []
    for rule in rules:
        one = F.lit(True)
        for t in rule:
            one = one & t.column(features)
        tests.append(one)
    if not tests:
        return F.lit(True)
    out = F.when(tests[0], F.lit(False))
    for t in tests[1:]:
        out = out.when(t, F.lit(False))
    return out.otherwise(F.lit(True))


def judge_quality(docs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """doc_id, the base counts, ``base_failed`` and ``kept``; one row per row of ``docs``."""
    return text_statistics(docs).select(
        "doc_id", *BASE, base_failed().alias("base_failed"), (~base_failed() & verdict(rules)).alias("kept")
    )
