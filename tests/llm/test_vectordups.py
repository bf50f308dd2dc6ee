"""Near-duplicate vectors against all pairs in doubles."""

import math
import random

import numpy as np
from llm_fixtures import rows

from marketflow.llm import vectordups
from marketflow.llm.hnsw import Graph, pack, unpack
from marketflow.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, node string, shard string, data string, kept int"


def frame(spark, data):
    return spark.createDataFrame([(v, e, label, "x", "x", "x", 1) for v, e, label in data], SCHEMA)


def brute(data, cosine=0.93):
    def fine(v, e, label):
        ok = e is not None and label is not None and v is not None
        return ok and all(x is not None and math.isfinite(x) for x in e) and any(x != 0 for x in e)

    good = [i for i, r in enumerate(data) if fine(*r)]
    n_links, near = [0] * len(data), {i: [] for i in range(len(data))}
    for i in good:
        for j in good:
            if i < j and data[i][2] == data[j][2] and len(data[i][1]) == len(data[j][1]):
                x, y = np.array(data[i][1]), np.array(data[j][1])
                if x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= cosine:
                    n_links[i] += 1
                    n_links[j] += 1
                    near[i].append(j)
                    near[j].append(i)
    least = {}
    for i in range(len(data)):
        if i not in least:
            todo, seen = [i], {i}
            while todo:
                new = [k for k in near[todo.pop()] if k not in seen]
                seen.update(new)
                todo += new
            low = min((data[k][0] for k in seen if data[k][0] is not None), default=None)
            least.update(dict.fromkeys(seen, low))
    return sorted(((data[i][0], n_links[i], least[i], data[i][0] == least[i]) for i in range(len(data))), key=repr)


def groups(seed, spreads=((40, 0.02), (60, 0.045), (30, 0.09), (1, 0)), dims=24, noise=150, label=1):
    """Groups of near copies, some wider than a ball, among vectors without a partner."""
    rng = np.random.default_rng(seed)
    out = [rng.normal(size=dims) for _ in range(noise)]
    for size, spread in spreads:
        middle = rng.normal(size=dims)
        middle /= np.linalg.norm(middle)
        out += [(middle + spread * rng.normal(size=dims)) * rng.uniform(0.1, 9) for _ in range(size)]
    rng.shuffle(out)
    return [[float(np.float32(x)) for x in v] for v in out]


def test_query_against_brute_force(spark, sf_dir):
    got = QUERIES["op12_embedding_near_dedup"](spark, sf_dir)
    assert [(f.name, f.dataType.simpleString()) for f in got.schema] == [
        ("vec_id", "bigint"), ("n_links", "bigint"), ("component_id", "bigint"), ("kept", "boolean"),
    ]
    data = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert rows(got) == brute(data)


def test_groups_copies_shards_and_odd_rows(spark):
    rng = random.Random(4)
    one, two = groups(1), groups(2)
    data = [(i, v, 1) for i, v in enumerate(one)] + [(1000 + i, v, 2) for i, v in enumerate(two)]
    data += [(2000 + i, v, 2) for i, v in enumerate(one[:40])]  # the same vectors under another label
    data += [(3000 + i, one[3], 1) for i in range(200)]  # a hot copy
    data += [(7, one[8], 1), (7, two[9], 2), (-4, one[3][:12], 1), (-5, one[3][:12], 1)]
    data += [
        (4000, None, 1), (4001, [], 1), (4002, [0.0] * 24, 1), (4003, [1.0, None], 1), (4004, [float("nan")] * 24, 1),
        (4005, [float("inf")] * 24, 1), (4006, one[3], None), (None, one[3], 1), (4007, [3e38] * 24, 1), (4008, [1e-45] * 24, 1),
    ]
    rng.shuffle(data)
    df = frame(spark, data).repartition(4)
    want = brute(data)
    assert max(r[1] for r in want) >= 200 and len({r[2] for r in want}) < len(want) - 300
    assert rows(vectordups.near_duplicates(df)) == want
    assert rows(vectordups.near_duplicates(df, shard_numbers=24 * 120)) == want  # several shards of each label
    assert vectordups.near_duplicates(df.limit(0)).collect() == []


def test_near_copies_are_one_node_and_counted_without_pairs():
    x = vectordups.unit(np.array(groups(5, ((2000, 0.02),), noise=300), float))
    shard = vectordups.Shard(np.arange(len(x)), np.ones(len(x), int), x, 0.93)
    assert len(shard.leads) < 320
    a, b = vectordups.near_balls(shard, shard, 0.93)
    assert len(a) < 400  # balls, not members
    again = vectordups.Shard.load(shard.save(), 0.93)
    assert (again.ball == shard.ball).all() and (again.graph.search(x[:9], 8)[0] == shard.graph.search(x[:9], 8)[0]).all()


def test_graph_finds_neighbours_and_the_audit_widens():
    rng = np.random.default_rng(6)
    x = vectordups.unit(rng.normal(size=(3000, 24)))
    graph = Graph(x, 2.0)  # nothing is absorbed
    assert len(graph.nodes()) == 3000
    exact = np.argsort(-(x[:300] @ x.T), axis=1)[:, :10]
    ids, cos = graph.search(x[:300], 40)
    assert np.mean([len(set(a) & set(b[:40])) / 10 for a, b in zip(exact.tolist(), ids.tolist())]) > 0.9
    assert (np.diff(cos, axis=1) <= 0).all()
    shard = vectordups.Shard(np.arange(3000), np.ones(3000, int), x, 0.93)
    wide, recall = vectordups.audited_beam(shard, x, np.full(3000, 0.5), True)
    assert wide > vectordups.FIRST_BEAM and recall >= 0.9
    assert {k: v.tolist() for k, v in unpack(pack({"a": exact[:2]})).items()} == {"a": exact[:2].tolist()}
    for n in (0, 1, 2):
        small = Graph(x[:n], 2.0)
        assert len(small.nodes()) == n and small.search(x[:3], 5)[0].shape[0] == 3
