"""Importance resampling towards a target: hashed features, log-ratio weights, Gumbel top-k.

1. Texts are lower-cased in ASCII and cut into words of digits, letters and non-ASCII characters;
   features are all runs of one to three words, counted in ``BUCKETS`` buckets by CRC-32.  A task adds
   its rows up in one array and sends that, so a pass over the texts shuffles only small arrays.
2. A bucket's gain compares its smoothed share in the target with that in the corpus; a document's
   weight is the sum of its features' gains, looked up in the array of all gains.
3. Weight plus Gumbel noise (from a hash of the id) is the score; the highest scores are a draw
   without replacement in proportion to the weights.  Scores are ranked by :mod:`radix`.

Every row of the documents is returned.  Null and empty texts have no features and weight 0.  Rows
without a doc_id have no noise: their texts count in the corpus, their score and rank are null and they
are not among the documents drawn from.  Rows that repeat a doc_id are scored each; on equal score and
doc_id the stored order decides.  An empty table gives an empty result; without any target text the
gains follow from the smoothing alone.  Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.llm.blocks import runs, text_slices
from marketflow.llm.crc import run_crcs, word_crcs
from marketflow.llm.radix import radix_places
from marketflow.llm.shipping import arrow_map
from marketflow.llm.simhash import LOWER
from marketflow.session import stored

BUCKETS, LONGEST = 10_000, 3
#: Documents of fewer words are not drawn.
LEAST_WORDS = 20
#: The share drawn, in hundredths.
PERCENT = 5
SEED = 42

IN_WORD = np.zeros(256, bool)
IN_WORD[ord("0") : ord("9") + 1] = IN_WORD[ord("a") : ord("z") + 1] = IN_WORD[128:] = True


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, bucket) of every feature, and the words of each document."""
    data = LOWER[data]
    starts, ends = runs(IN_WORD[data], offsets)
    first = np.searchsorted(starts, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    owner, bucket = [], []
    for n, crc in enumerate(run_crcs(word_crcs(data, starts, ends), ends - starts, LONGEST)):
        whole = np.flatnonzero(doc[: len(crc)] == doc[n : n + len(crc)])
        owner.append(doc[whole])
        bucket.append(crc[whole] % np.uint32(BUCKETS))
    return np.concatenate(owner), np.concatenate(bucket), np.diff(first)


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for _, _, data, offsets in text_slices(batch.column(0)):
            total += np.bincount(features(data, offsets)[1], minlength=BUCKETS)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["bucket", "n"])


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Features of all texts (a single column) in each bucket; the driver gets ``BUCKETS`` rows at most."""
    counted = arrow_map(texts, _count, "bucket int, n long").groupBy("bucket").agg(F.sum("n")).collect()
    out = np.zeros(BUCKETS, np.int64)
    for bucket, n in counted:
        out[bucket] = n
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the logarithm of the smoothed ratio of shares, rounded down."""
    s_all, t_all = float(corpus.sum()), float(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * (s_all + BUCKETS) / ((s + 1.0) * (t_all + BUCKETS))))
            for s, t in zip(corpus.tolist(), target.tolist())
        ],
        np.int64,
    )


def _weigh(gains: np.ndarray) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def weigh(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_slices(batch.column(1)):
                doc, bucket, n_words = features(data, offsets)
                weight = np.zeros(b - a, np.int64)
                np.add.at(weight, doc, gains[bucket])
                size = np.bincount(doc, minlength=b - a)
                columns = [batch.column(0)[a:b], pa.array(n_words), pa.array(size), pa.array(weight)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_features", "weight"])

    return weigh


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """1000 times the Gumbel noise of a document, rounded down; null without an id."""
    head = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256), 1, 8)
    share = (F.conv(head, 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(share))).cast("long")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of ``docs``; rank is null where not drawn.

    ``docs`` has doc_id and text, ``target`` has text.  The texts are read twice (counts, weights); no
    text is shuffled.
    """
    gains = bucket_gains(bucket_counts(docs.select("text")), bucket_counts(target.select("text")))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    weighed = arrow_map(ids, _weigh(gains), "doc_id long, n_words long, n_features long, weight long")
    scored = weighed.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    scored = stored(scored.withColumn("tag", F.monotonically_increasing_id()), "weights")
    may = scored.where((F.col("n_words") >= LEAST_WORDS) & F.col("doc_id").isNotNull())
    places = radix_places(may.select("tag", "doc_id", "score"), [F.bitwise_not("score"), F.col("doc_id")])
    drawn = percent * places.count() // 100
    ranks = places.where(F.col("place") < drawn).select("tag", (F.col("place") + 1).alias("rank"))
    return scored.join(ranks, "tag", "left").select("doc_id", "n_features", "weight", "score", "rank")


def _oracle() -> str:
    """The same by exploded features and one sort; checksums by four bits at a time."""
    nibble = []
    for v in range(16):
        for _ in range(4):
            v = (v >> 1) ^ (0xEDB88320 if v & 1 else 0)
        nibble.append(v)

    def half(x: str) -> str:
        return f"xor(({x}) >> 4, {nibble}[(({x}) & 15) + 1])"

    return f"""
WITH texts AS (
  SELECT doc_id, false AS target, text FROM documents UNION ALL SELECT item_id, true, text FROM benchmark
), split AS (
  SELECT doc_id, target,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w
  FROM texts
), runs AS (
  SELECT doc_id, target, array_to_string(w[i:i + n - 1], ' ') AS f
  FROM (SELECT doc_id, target, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM split, (SELECT unnest([1, 2, 3]) AS n))
), codes AS (
  SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM runs)
), bytes AS (
  SELECT f, list_transform(range(1, len(h), 2), lambda i: ('0x' || substr(h, i, 2))::BIGINT) AS b FROM codes
), hashed AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x: {half(half("xor(c, x)"))}), 4294967295) % 10000 AS bucket
  FROM bytes
), found AS (
  SELECT doc_id, target, bucket, count(*) AS n FROM runs JOIN hashed USING (f) GROUP BY ALL
), shares AS (
  SELECT bucket, coalesce(sum(n) FILTER (target), 0) AS t, coalesce(sum(n) FILTER (NOT target), 0) AS s FROM found GROUP BY bucket
), totals AS (
  SELECT coalesce(sum(t), 0) AS tt, coalesce(sum(s), 0) AS ss FROM shares
), gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (ss + 10000)::DOUBLE) / ((s + 1)::DOUBLE * (tt + 10000)::DOUBLE)))::BIGINT AS gain
  FROM shares, totals
), weights AS (
  SELECT doc_id, sum(n) AS n_features, sum(n * gain) AS weight FROM found JOIN gains USING (bucket) WHERE NOT target GROUP BY doc_id
), scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM split LEFT JOIN weights USING (doc_id) WHERE NOT target
), placed AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_words >= {LEAST_WORDS}
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= {PERCENT} * n // 100 THEN place END AS rank
FROM scored LEFT JOIN placed USING (doc_id)
"""


ORACLE = _oracle()
