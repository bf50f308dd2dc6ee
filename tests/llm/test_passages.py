"""Repeated passages and strings against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from llm_fixtures import make_docs, odd_rows, rows, text_of  # noqa: F401

from marketflow.llm import bwt, bytepassages, substrings
from marketflow.llm import repeats as R

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def key(row):
    return (-(1 << 63) if row[0] is None else row[0],)


def brute_words(docs, width=20):
    seen, out = set(), []
    for d, t in sorted(docs, key=key):
        words = WORD.findall(t or "")
        gone = set()
        for i in range(len(words) - width + 1):
            window = tuple(words[i : i + width])
            if window in seen:
                gone.update(range(i, i + width))
            seen.add(window)
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((d, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def brute_bytes(docs, width=400):
    count = collections.Counter()
    for _, t in docs:
        raw = (t or "").encode()
        count.update(raw[i : i + width] for i in range(len(raw) - width + 1))
    out = []
    for d, t in docs:
        raw = (t or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - width + 1):
            if count[raw[i : i + width]] > 1:
                gone[i : i + width] = True
        spans = int((gone[1:] & ~gone[:-1]).sum()) + int(gone[0])
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((d, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def planted(seed):
    rng = random.Random(seed)
    passage = text_of(90, 99)
    docs = []
    for d in range(60):
        text = text_of(rng.randrange(5, 400), seed * 1000 + d)
        if d % 3 == 0:
            words = passage.split()
            a = rng.randrange(0, 40)
            text += " " + "  ".join(words[a : a + rng.randrange(15, 50)]) + "\n" + text_of(30, d)
        if d % 7 == 0:
            text += " tick tock" * rng.randrange(5, 200)
        docs.append((d, text))
    docs += [(100 + d, t) for d, t in docs[:10]]
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_passages_of_words(spark, seed):
    docs = planted(seed)
    assert rows(substrings.repeat_report(make_docs(spark, docs).repartition(5))) == brute_words(docs)


@pytest.mark.parametrize("seed", [1, 2])
def test_strings_of_bytes(spark, seed):
    docs = planted(seed)
    assert rows(bytepassages.string_report(make_docs(spark, docs).repartition(5))) == brute_bytes(docs)


def test_strings_begin_at_400_bytes(spark):
    """A shared string of 399 bytes stays, however many words it has; one of 400 goes, from its first text too."""
    words = " ".join(f"w{i}" for i in range(51))
    docs = [(1, words + " one"), (2, words + " other")]
    docs += [(3, "é" + "x" * 399 + "a"), (4, "è" + "y" * 2 + "x" * 399 + "b"), (5, "c" + "𐍈" * 100), (6, "d" + "𐍈" * 100)]
    got = rows(bytepassages.string_report(make_docs(spark, docs)))
    assert got == brute_bytes(docs)
    assert [r[2] for r in got] == [0, 0, 0, 0, 400, 400]


def test_odd_rows(spark, odd_rows):
    df = make_docs(spark, odd_rows)
    assert rows(substrings.repeat_report(df)) == brute_words(odd_rows)
    assert rows(bytepassages.string_report(df)) == brute_bytes(odd_rows)


def test_empty_table(spark):
    df = make_docs(spark, [(1, "x")]).limit(0)
    assert substrings.repeat_report(df).count() == 0
    assert bytepassages.string_report(df).count() == 0
    assert rows(substrings.repeat_report(make_docs(spark, [(1, None)])), "n_words", "n_removed") == [(0, 0)]


def common(seed):
    """Texts that share a frequent anchor: a short line, whole copies and passages around it."""
    rng = random.Random(seed)
    line, passage = text_of(12, 77), text_of(110, 78)
    docs = []
    for d in range(80):
        before = " ".join(text_of(30, 4).split()[rng.randrange(25) :])  # a few ways to reach the line
        text = before + " " + line + " " + text_of(rng.randrange(1, 30), 1000 + d % 50)
        docs.append((d, text + (" " + passage if d % 4 == 0 else "")))
    docs += [(200 + d, docs[3][1]) for d in range(20)]
    docs += [(None, docs[5][1]), (None, docs[5][1]), (7, docs[7][1])]
    return docs


def test_hot_anchors(spark, monkeypatch):
    """Anchors in more than ten places are dealt by whole windows, here more than half of all."""
    docs = common(1)
    df = make_docs(spark, docs).repartition(6)
    want = brute_words(docs), brute_bytes(docs)
    monkeypatch.setattr(R, "HOT_SHARE", 0)
    for least in (10, 1, 1 << 30):
        monkeypatch.setattr(R, "HOT_LEAST", least)
        assert rows(substrings.repeat_report(df)) == want[0]
        assert rows(bytepassages.string_report(df)) == want[1]


def test_buckets_follow_the_places(spark, monkeypatch):
    docs = common(2)
    monkeypatch.setattr(R, "BUCKET_BYTES", 1 << 12)
    assert rows(substrings.repeat_report(make_docs(spark, docs))) == brute_words(docs)


def test_kept_texts_and_spans(spark):
    passage = text_of(40, 1)
    df = make_docs(spark, [(1, passage + " end"), (2, "begin " + passage)])
    kept = {r["doc_id"]: r["kept_text"] for r in substrings.without_repeats(df).collect()}
    assert kept == {1: passage + " end", 2: "begin"}
    assert rows(substrings.repeated_passages(df)) == [(2, 1, 41)]
    raw = len(passage)
    assert rows(bytepassages.repeated_strings(make_docs(spark, [(1, passage * 4), (2, passage * 4 + " x")]))) == [
        (1, 0, 4 * raw), (2, 0, 4 * raw)
    ]


def tree_of(seed):
    rng = np.random.default_rng(seed)
    symbols = rng.integers(0, 2, 400)
    symbols[200:300] = symbols[50:150]
    hashes = rng.integers(1, 1 << 60, 2, dtype=np.uint64)[symbols]
    return symbols, R.prefix_sums(hashes, R.WORD_BASE), np.arange(381)


def test_prefixes_grow_where_groups_are_too_large():
    symbols, sums, suffixes = tree_of(3)
    depths = set()
    for most in (1, 7, 1000):
        found = [(some, depth) for some, depth in substrings.prefix_groups(sums, suffixes, 20, most)]
        assert all(len(some) <= most or depth == 20 for some, depth in found)
        depths.add((most, tuple(sorted({d for _, d in found}))))
        seen = np.concatenate([some for some, _ in found])
        assert len(set(seen.tolist())) == len(seen)
    assert depths == {(1, (20,)), (7, (5, 10)), (1000, (5,))}


def test_subtrees_are_sorted_suffixes_with_common_prefixes():
    symbols, sums, suffixes = tree_of(5)
    ranked, common = substrings.subtree(symbols, suffixes, suffixes[::-1], 20)
    texts = [tuple(symbols[i : i + 20].tolist()) for i in ranked.tolist()]
    assert texts == sorted(texts)
    for x, y, n in zip(texts, texts[1:], common[1:].tolist()):
        assert x[:n] == y[:n] and (n == 20 or x[n] != y[n])
    assert all(a > b for a, b, n in zip(ranked, ranked[1:], common[1:]) if n == 20)  # equal ones as given


def test_deep_nodes_whatever_a_subtree_may_hold():
    symbols, sums, suffixes = tree_of(3)
    want = collections.defaultdict(list)
    for i in suffixes.tolist():
        want[symbols[i : i + 20].tobytes()].append(i)
    for most in (1, 7, 1 << 18):
        suffix, node = substrings.deep_nodes(symbols, sums, suffixes, 20, most)
        found = collections.defaultdict(list)
        for s, n in zip(suffix.tolist(), node.tolist()):
            found[n].append(s)
        assert sorted(found.values()) == sorted(v for v in want.values() if len(v) > 1)


def test_merged_transform_is_the_whole_one():
    rng = np.random.default_rng(4)
    windows = rng.integers(0, 3, (500, 4)).astype(np.uint64)
    whole = bwt.transform(list(windows.T), np.arange(500))
    parts = np.split(np.arange(500), [100, 100, 230, 231])
    merged = bwt.merge([bwt.transform(list(windows[p].T), p) for p in parts])
    for a, b in zip([*whole.columns, *whole.deal], [*merged.columns, *merged.deal]):
        assert (a == b).all()
    assert (merged.order == whole.order).all() and (merged.common == whole.common).all()
    ranked = [tuple(windows[i].tolist()) for i in merged.order]
    assert ranked == sorted(map(tuple, windows.tolist()))
    for x, y, n in zip(ranked, ranked[1:], merged.common[1:].tolist()):
        assert x[:n] == y[:n] and (n == 4 or x[n] != y[n])
