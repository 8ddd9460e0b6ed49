"""Suffix dedup against brute force over all 400-byte strings."""

import hashlib
import random
from collections import Counter

import pytest

from tramflow.llm import suffix_dedup

SHAPE = "doc_id long, text string, hash string, node string"


def brute(texts, length=400):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[k : k + length] for r in raw for k in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = [False] * len(r)
        for k in range(len(r) - length + 1):
            if seen[r[k : k + length]] > 1:
                gone[k : k + length] = [True] * length
        kept = bytes(b for b, g in zip(r, gone, strict=True) if not g)
        spans = sum(g and (not k or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept.decode(errors="ignore")))
    return out


def cases():
    rng = random.Random(8)
    prose = lambda n: "".join(rng.choice("abcdefghij éü\n") for _ in range(n))
    passage, line = prose(700), prose(90)
    texts = [prose(900) for _ in range(4)]
    texts += [prose(300) + passage + prose(200), passage[:450] + prose(500), prose(10) + passage, passage]
    texts += [line * 12 + prose(50), prose(30) + line * 5, "ab" * 600, "x" * 401, prose(7) + "ab" * 300 + prose(9), "ab" * 230 + prose(100), "abcde" * 90]
    texts += [texts[0], texts[0], None, "", " ", prose(399), "é" * 500]
    return texts


def run(spark, texts, **settings):
    rows = [(k, t, "clash", "clash") for k, t in enumerate(texts)]
    out = suffix_dedup.removals(spark.createDataFrame(rows, SHAPE), **settings).collect()
    assert len(out) == len(texts)
    return [tuple(r)[1:] for r in sorted(out, key=lambda r: r.doc_id)]


def test_brute_force(spark):
    texts = cases()
    assert run(spark, texts) == brute(texts)


def test_groups_too_large_for_a_task(spark, monkeypatch):
    texts = cases()
    monkeypatch.setattr(suffix_dedup.repeated_ranges, "__defaults__", (1,))
    assert run(spark, texts) == brute(texts)


def test_empty_table(spark):
    assert suffix_dedup.removals(spark.createDataFrame([], SHAPE)).count() == 0


def test_shorter_strings(spark):
    rng = random.Random(9)
    shared = ["".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (199, 200, 201, 260, 399)]
    prose = lambda n: "".join(rng.choice("klmnopqr é") for _ in range(n))
    texts = cases() + [prose(50 * k) + s + prose(90) for s in shared for k in (1, 7)]
    texts += ["abc" * n for n in range(60, 80)] + [prose(20) + "xyz" * 150, prose(9) + "yzx" * 67 + prose(9)]
    assert run(spark, texts, length=200) == brute(texts, 200)
    kept = suffix_dedup.without_repeats(spark.createDataFrame([(k, t, None, None) for k, t in enumerate(texts)], SHAPE), 200).collect()
    assert [r.text for r in sorted(kept, key=lambda r: r.doc_id)] == [b[4] for b in brute(texts, 200)]


def test_strings_too_short_for_anchors(spark):
    with pytest.raises(ValueError):
        suffix_dedup.removals(spark.createDataFrame([], SHAPE), 100)
