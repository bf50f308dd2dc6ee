"""Vector codes against full searches in plain integers."""

import hashlib
import math
import random

import numpy as np
from llm_fixtures import rows

from marketflow.llm import vectorcodes
from marketflow.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, error string, code string, part int"


def brute(data):
    """Rows (vec_id, embedding, label) to those of the contract."""
    fine = [r for r in data if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    if not fine:
        return []
    x = np.array([[math.floor(1024 * float(np.float32(v))) for v in e] for _, e, _ in fine], object)
    d = x.shape[1] // 4
    order = sorted(range(len(fine)), key=lambda i: (fine[i][0] is None, fine[i][0] or 0, list(fine[i][1])))[:256]
    codes, errors, books = [], 0, []
    for p in range(4):
        part = x[:, p * d : (p + 1) * d].astype(np.int64)
        book = part[order].copy()
        for k in range(5):
            dist = ((part[:, None, :] - book[None]) ** 2).sum(2)
            near = dist.argmin(1)
            if k < 4:
                for e in set(near.tolist()):
                    own = part[near == e]
                    book[e] = [int(s) // len(own) for s in own.sum(0)]
        codes.append(near)
        errors = errors + dist.min(1)
        books.append(book)
    digest = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e.tolist()).encode()).hexdigest()
    total = {}
    for (_, _, label), e in zip(fine, errors.tolist()):
        total[label] = total.get(label, 0) + e
    return sorted(
        ((v, bytes(int(c[i]) for c in codes).hex(), int(errors[i]), total[label], digest) for i, (v, _, label) in enumerate(fine)),
        key=repr,
    )


def frame(spark, data):
    return spark.createDataFrame([(v, e, label, "x", "x", 7) for v, e, label in data], SCHEMA)


def clouds(seed, n, dims=16, centres=300, ties=False):
    rng = random.Random(seed)
    middle = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(centres)]
    out = []
    for i in range(n):
        e = [float(np.float32(m + rng.gauss(0, 0.05))) for m in middle[rng.randrange(centres)]]
        out.append((i, [round(v) / 2 for v in e] if ties else e, rng.choice([None, 1, 1, 2])))
    return out


def test_query_against_brute_force(spark, sf_dir):
    got = QUERIES["op13_vector_codes"](spark, sf_dir)
    assert [(f.name, f.dataType.simpleString()) for f in got.schema] == [
        ("vec_id", "bigint"), ("code", "string"), ("error", "bigint"), ("label_error", "bigint"), ("codebooks_sha256", "string"),
    ]
    data = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert rows(got) == brute(data)


def test_clouds_ties_and_few_vectors(spark):
    for data in (clouds(1, 3000), clouds(2, 2000, ties=True), clouds(3, 60), clouds(4, 2), clouds(5, 1)):
        assert rows(vectorcodes.compress(frame(spark, data).repartition(3))) == brute(data)


def test_large_components(spark):
    """Beyond what doubles hold exactly, in 64-bit integers."""
    rng = random.Random(6)
    data = [(i, [rng.choice([-1, 1]) * rng.uniform(0, 1.3e5) for _ in range(8)], i % 3) for i in range(700)]
    assert rows(vectorcodes.compress(frame(spark, data))) == brute(data)


def test_odd_rows_and_many_labels(spark, monkeypatch):
    data = clouds(7, 400)
    good = [*data, data[5], (None, data[9][1], None), (-3, data[9][1], 2), (-3, data[11][1], 2), (10**12, [0.0] * 16, 4)]
    bad = [
        (500, None, 1), (501, [], 1), (502, [1.0] * 15 + [None], 1), (503, [1.0] * 15 + [float("nan")], 1),
        (504, [1.0] * 15 + [float("-inf")], 1),
    ]
    odd = [(600, [1.0] * 12, 1), (601, [1.0] * 15, 1)]
    df = frame(spark, good + bad + odd)
    want = brute(good)
    assert rows(vectorcodes.compress(df)) == want
    from marketflow.llm import vectors

    monkeypatch.setattr(vectors, "BROADCAST_GROUPS", 1)
    assert rows(vectorcodes.compress(df)) == want
    assert vectorcodes.compress(df.limit(0)).collect() == []
    huge = frame(spark, [(1, [1e30] * 4, 1), (2, [-1e30] * 4, 1)])
    assert [r["code"] for r in vectorcodes.compress(huge).orderBy("vec_id").collect()] == ["00000000", "01010101"]


def test_bounds_decide_most_parts_and_width_adapts():
    rng = np.random.default_rng(8)
    middle = rng.normal(0, 400, (256, 16))
    x = np.floor(middle[rng.integers(0, 256, 4000)] + rng.normal(0, 40, (4000, 16))).astype(np.int64)
    book = x[:256].copy()
    ids, bounds, _ = vectorcodes.nearest(x, book, 8)
    for scale in (60, 10, 2, 0):
        now = book + rng.integers(-scale, scale + 1, book.shape)
        shift = np.sqrt(((now - book) ** 2).sum(1)) + 1e-9
        depth = vectorcodes.reassign(x, now, ids, bounds, shift)
        full, all_bounds, _ = vectorcodes.nearest(x, now, 8)
        assert (ids[:, 0] == full[:, 0]).all()
        dist = np.sqrt(vectorcodes.all_distances(x, now))
        assert (np.take_along_axis(dist, ids[:, 1:].astype(int), 1) >= bounds[:, 1:-1]).all()
        rest = dist.copy()
        np.put_along_axis(rest, ids.astype(int), np.inf, 1)
        assert (rest.min(1) >= bounds[:, -1]).all() and (np.diff(bounds[:, 1:]) >= 0).all()
        book = now
    assert (depth == -1).mean() > 0.3 and (depth > 8).mean() < 0.05  # the last move was none
    assert vectorcodes.next_width({-1: 900, 1: 90, 2: 9, 5: 1, 9: 0}, 8, 256) == 3
    assert vectorcodes.next_width({-1: 100, 7: 900, 9: 2}, 8, 256) == 7
    assert vectorcodes.next_width({-1: 100, 9: 20}, 8, 256) == 16
