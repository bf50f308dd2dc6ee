"""Importance resampling and its radix sort against plain Python."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
from llm_fixtures import make_docs, odd_rows, rows, text_of  # noqa: F401
from pyspark.sql import functions as F

from marketflow.llm import crc, importance, radix
from marketflow.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_features(text):
    words = WORD.findall((text or "").translate(LOW))
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) % 10000 for r in runs]


def brute(docs, target):
    found = [(d, *brute_features(t)) for d, t in docs]
    s = collections.Counter(b for _, _, f in found for b in f)
    t = collections.Counter(b for x in target for b in brute_features(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in range(10000)]
    out = []
    for d, n_words, f in found:
        weight, score = sum(gain[b] for b in f), None
        if d is not None:
            h = int(hashlib.sha256(f"42:{d}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([d, len(f), weight, score, None, n_words])
    may = sorted((r for r in out if r[5] >= 20 and r[0] is not None), key=lambda r: (-r[3], r[0]))
    for k, r in enumerate(may[: 5 * len(may) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


def test_checksums_of_runs():
    rng = random.Random(3)
    words = [rng.randbytes(rng.choice([1, 2, 5, 63, 64, 65, 255, 256, 300, 5000])) for _ in range(200)]
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    size = np.array([len(w) for w in words])
    got = crc.run_crcs(crc.word_crcs(data, ends - size, ends), size, 3)
    for n in (1, 2, 3):
        assert got[n - 1].tolist() == [zlib.crc32(b" ".join(words[i : i + n])) for i in range(len(words) - n + 1)]
    assert [len(x) for x in crc.run_crcs(np.zeros(1, np.uint32), np.ones(1, int), 3)] == [1, 0, 0]


def test_radix_places(spark, monkeypatch):
    monkeypatch.setattr(radix, "LEAST_BLOCK", 6)
    rng = random.Random(1)
    some = [-(2**63), 2**63 - 1, -1, 0, 7, 7, 7, 300, -70000]
    data = [(rng.choice(some) if rng.random() < 0.5 else 7, rng.randrange(-300, 300), i) for i in range(3000)]
    df = spark.createDataFrame(data, "a long, b long, i long").repartition(5)
    got = radix.radix_places(df, [F.bitwise_not("a"), F.col("b")])
    by_place = sorted((r["place"], r["a"], r["b"]) for r in got.collect())
    assert [p for p, _, _ in by_place] == list(range(3000))
    assert [(a, b) for _, a, b in by_place] == sorted(((a, b) for a, b, _ in data), key=lambda x: (-x[0], x[1]))
    assert sorted(r["i"] for r in got.select("i").collect()) == list(range(3000))
    one = radix.radix_places(df.limit(1), [F.col("a")]).collect()
    assert [r["place"] for r in one] == [0]
    same = radix.radix_places(df.where("a = 7").select("i"), [F.lit(7)])
    assert sorted(r["place"] for r in same.collect()) == list(range(df.where("a = 7").count()))
    assert radix.radix_places(df.limit(0), [F.col("a"), F.col("b")]).collect() == []


def test_query_against_brute_force(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    bench = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    got = QUERIES["op11_importance_resampling"](spark, sf_dir)
    assert [(f.name, f.dataType.simpleString()) for f in got.schema] == [
        ("doc_id", "bigint"), ("n_features", "bigint"), ("weight", "bigint"), ("score", "bigint"), ("rank", "bigint"),
    ]
    assert rows(got) == brute(docs, bench)


def test_odd_rows_and_empty_tables(spark, odd_rows):  # noqa: F811
    docs = odd_rows + [(100 + i, text_of(30, i)) for i in range(100)] + [(-5, "Ab" * 2000 + " Cd-ef_gh1" * 30)]
    target = [None, "", text_of(50, 7)]
    targets = spark.createDataFrame([(t,) for t in target], "text string")
    assert rows(importance.resample(make_docs(spark, docs), targets)) == brute(docs, target)
    empty = make_docs(spark, docs).limit(0)
    assert importance.resample(empty, targets).collect() == []
    assert rows(importance.resample(make_docs(spark, docs), targets.limit(0))) == brute(docs, [])
