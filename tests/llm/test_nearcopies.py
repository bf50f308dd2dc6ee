"""The pipeline's near-duplicates against plain Python."""

import random
import re

import numpy as np
from llm_fixtures import make_docs, odd_rows, rows, text_of  # noqa: F401

import corpus_pipeline
from marketflow.llm import components, nearcopies, simhash


def shingles(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(docs):
    docs = [(d, shingles(t)) for d, t in docs if d is not None]
    a, b = [], []
    for i, (_, s) in enumerate(docs):
        for j, (_, t) in enumerate(docs[:i]):
            if s == t or 5 * len(s & t) >= 4 * len(s | t):
                a.append(i)
                b.append(j)
    root = components.local_roots(len(docs), np.array(a, int), np.array(b, int))
    least = {}
    for (d, _), r in zip(docs, root.tolist()):
        least[r] = min(d, least.get(r, d))
    return sorted(((d, least[r]) for (d, _), r in zip(docs, root.tolist())), key=repr)


def edited(seed, words, changes, copies):
    rng, base = random.Random(seed), text_of(words, seed).split()
    for _ in range(copies):
        copy = list(base)
        for _ in range(changes):
            copy[rng.randrange(len(copy))] = f"n{rng.random()}"
        yield " ".join(copy)


def test_blocks_of_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(nearcopies, "BLOCK", 20)
    docs = [(k, t) for k, t in enumerate(edited(7, 150, 4, 120))]  # many pairs just below 0.8
    docs += [(500 + k, t) for k, t in enumerate(edited(8, 200, 2, 60))]
    docs += [(900 + k, t) for k, t in enumerate(edited(9, 12, 1, 30))]
    assert rows(nearcopies.components_of_similar(make_docs(spark, docs))) == brute(docs)


def test_rounds_make_the_components_of_all_pairs():
    rng = np.random.default_rng(1)
    base = np.unique(rng.integers(0, 1 << 63, 100, dtype=np.uint64))
    sets = []
    for _ in range(60):
        own = base.copy()
        own[rng.integers(0, len(own), rng.integers(1, 16))] = rng.integers(0, 1 << 63, 1, dtype=np.uint64)
        sets.append(np.unique(own))
    pairs = [(i, j) for i in range(60) for j in range(i) if nearcopies.similar_to(sets[i], [sets[j]])[0]]
    assert pairs == [(i, j) for i in range(60) for j in range(i)
                     if 5 * len(np.intersect1d(sets[i], sets[j])) >= 4 * len(np.union1d(sets[i], sets[j]))]
    a, b = np.array(pairs).T
    every = np.arange(60)
    assert (nearcopies.group_roots(sets, every, every) == components.local_roots(60, a, b)).all()
    low, high = every[:25], every[25:]
    across = (a >= 25) & (b < 25)
    want = components.local_roots(60, a[across], b[across])
    assert (nearcopies.group_roots(sets, low, high) == want).all()


def test_similar_texts_are_one_group_whatever_their_fingerprints(spark, odd_rows):
    docs = list(odd_rows)
    for g in range(12):  # few, many and very many changed words around the limit
        docs += [(1000 + 100 * g + k, t) for k, t in enumerate(edited(g, 300, 1 + g, 6))]
    docs += [(5000 + k, t) for k, t in enumerate(edited(50, 150, 4, 150))]  # one large group, not all alike
    df = make_docs(spark, docs)
    want = brute(docs)
    assert rows(nearcopies.components_of_similar(df)) == want
    kept = corpus_pipeline.near_duplicate_stage(spark, df, "")
    assert kept.columns == df.columns
    alone = {(d,) for d, c in want if d == c} | {(None,)}
    assert rows(kept, "doc_id") == sorted(alone, key=repr)
    old = {r["doc_id"] for r in simhash.keep_one_per_group(df).collect()}
    assert old - {d for d, in alone}  # links of four bits leave similar texts apart
    assert corpus_pipeline.near_duplicate_stage(spark, df.limit(0), "").count() == 0
