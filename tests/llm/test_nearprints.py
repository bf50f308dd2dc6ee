"""The fingerprints of the pipeline's near-duplicates: who meets by them."""

import random

import numpy as np
from test_nearcopies import edited, shingles

from marketflow.llm import components, nearcopies
from marketflow.llm.blocks import text_bytes


def test_fingerprints_within_four_bits_meet(spark):
    rng = random.Random(3)
    prints = [rng.getrandbits(64) for _ in range(150)]
    for p in prints[:100]:  # 0 to 8 bits away, and chains of these
        for k in range(3):
            p ^= sum(1 << b for b in rng.sample(range(64), rng.choice([0, 1, 3, 4, 5, 8])))
            prints.append(p)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    nodes = [(10 * k, 7 + k, p) for k, p in enumerate(signed)] + [(5, 0, signed[0])]
    df = spark.createDataFrame(nodes, "node long, size long, fp long")
    got = [tuple(r) for r in nearcopies.fingerprint_members(df).collect()]
    assert {(n, s) for _, n, s in got} <= {(n, s) for n, s, _ in nodes if s}
    every = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    want = components.local_roots(len(prints), *np.array(every).T)
    lead, node = np.array([(a // 10, b // 10) for a, b, _ in got]).T
    assert (components.local_roots(len(prints), lead, node) == want).all()
    assert nearcopies.fingerprint_members(df.limit(0)).collect() == []


def test_fingerprints_of_like_sets_are_near():
    import pyarrow as pa

    texts = [*edited(4, 2000, 1, 6), *edited(5, 2000, 1, 6), "", "one two"]
    grams, at = nearcopies.shingle_sets(*text_bytes(pa.array(texts)))
    assert np.diff(at).tolist() == [len(shingles(t)) for t in texts]
    prints = nearcopies.set_fingerprints(grams, at).view(np.uint64)
    apart = np.bitwise_count(prints[:, None] ^ prints[None, :])
    assert apart[:6, :6].max() <= 10 and apart[6:12, 6:12].max() <= 10 and apart[:6, 6:12].min() >= 15
    assert prints[12] == 0
