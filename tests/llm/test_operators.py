"""Each operator on odd inputs, against brute force or a reference library."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from tramflow.llm import byte_bpe, collinear, fingerprints, mixing, probminhash, quality_mil, rule_cascade, token_counts, toxicity_cnn

SHAPE = "doc_id long, text string, lang string, source string, n_chars long, node string, size string, label string"
PATH = public_tokenizers.path(byte_bpe.VOCABULARY)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def texts():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdeféñ漢") for _ in range(rng.randint(1, 9))) for _ in range(3000)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = prose(200).split(" ")
    near = base.copy()
    near[50] = near[120] = "changed"
    moved = prose(40).split(" ") + base[20:110] + prose(30).split(" ")
    return [" ".join(base), " ".join(near), " ".join(moved), prose(300), prose(300), prose(20000), "a b c", "x", "", None, "  \n\t ", "it's  'll\n's", "b" * 3000, " ".join(base), "la la la " * 60, "one\ntwo\none\n\n"]


def frame(spark, rows):
    return spark.createDataFrame(rows, SHAPE)


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(k, t, ["en", None][k % 2], ["s1", "s2", None][k % 3], None, "clash", "clash", "clash") for k, t in enumerate(texts())]
    return frame(spark, [*rows, rows[3], (None, "no id", None, None, None, None, None, None)])


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


@pytest.fixture(scope="module")
def marks(spark):
    return spark.createDataFrame([(k, k % 2, k % 3 == 0 and 1 or 0) for k in range(9)] + [(3, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")


def test_fingerprints(odd, empty):
    rows = odd.select("doc_id", "text").collect()
    order = sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id or 0))
    out = sorted(fingerprints.edit_study(odd).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    want = []
    for at, r in enumerate(order):
        text, after = r.text or "", order[(at + 1) % len(order)].text or ""
        k = len(text) // 4
        want.append((r.doc_id, len(text), hashlib.sha256((text[: len(text) - k] + after[:k]).encode()).hexdigest()))
    assert [(r.doc_id, r.n_chars, r.edited_sha256) for r in out] == want
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in out)
    assert len({r.fingerprint for r in out if r.doc_id in (0, 13)}) == 1
    assert fingerprints.edit_study(empty).count() == 0


def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe(odd, empty):
    encoding, given = library(), Counter((r.doc_id, tuple(encoding_ids)) for r in odd.collect() for encoding_ids in [library_ids(r.text)])
    out = byte_bpe.encoded(odd, PATH, with_ids=True).collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in out) == given
    text = {r.doc_id: r.text or "" for r in odd.collect()}
    assert all(r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest() and r.n_tokens == len(r.ids) for r in out)
    assert encoding.n_vocab and byte_bpe.encoded(empty, PATH).count() == 0


def library_ids(text, cache=[]):  # noqa: B006
    cache or cache.append(library())
    return cache[0].encode_ordinary(text or "")


def test_token_counts(odd, empty):
    out = token_counts.section_tokens(odd, PATH).collect()
    total = Counter()
    for r in out:
        total[r.doc_id] += r.n_tokens
    rows = odd.collect()
    want = Counter()
    for r in rows:
        want[r.doc_id] += len(library_ids(r.text))
    assert +total == +want
    assert token_counts.section_tokens(empty, PATH).count() == 0
    first, second = token_counts.allocate(*(__import__("numpy").array(x) for x in ([0, 3], [4, 5], [0, 3], [3, 5])), "most")
    assert first.tolist() == [0, 1] and second.tolist() == [True, False]


def test_classifiers(odd, empty, marks):
    for module, cut in ((quality_mil, 0.5), (toxicity_cnn, 0.7)):
        out = module.scored(odd, marks).collect()
        assert len(out) == odd.count()
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= cut) for r in out)
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out if r.doc_id is not None)
        assert module.scored(empty, marks).count() == 0
        assert module.scored(odd, marks.where("doc_id < 0")).count() == odd.count()


def test_near_duplicates(odd, empty):
    out = {r.doc_id: r for r in probminhash.near_duplicates(odd).collect()}
    assert {r.class_id for k, r in out.items() if k in (0, 1, 13)} == {0}
    assert {k for k, r in out.items() if r.class_id in (0, 8, 9)} >= {0, 1, 8, 9, 13}
    assert out[2].class_id == 2 and out[8].class_id == out[9].class_id == 8 and out[10].class_id == 10
    kept = probminhash.one_of_each(odd)
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(k) for k, r in out.items() if r.kept)
    assert probminhash.near_duplicates(empty).count() == 0


def test_fuzzy_passages(odd, empty):
    found = {(r.doc_id, r.partner_id) for r in collinear.passages(odd).collect()}
    assert {(0, 13), (13, 0), (0, 1), (1, 0)} <= found
    assert 2 in {a for a, _ in found} and not {4, 5, 6, 8, 9} & {a for a, _ in found}
    assert collinear.passages(empty).count() == 0


def test_rule_cascade(odd, empty):
    out = Counter((r.doc_id, r.n_words, r.word_chars, r.n_repeat_words, r.n_dup_lines) for r in rule_cascade.cascade(odd).collect())
    want = Counter()
    for r in odd.collect():
        words = WORD.findall(r.text or "")
        grams = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
        repeated = {k + j for k in range(len(words) - 2) if grams[tuple(words[k : k + 3])] > 1 for j in range(3)}
        lines = [x for x in (r.text or "").split("\n") if WORD.search(x)]
        want[(r.doc_id, len(words), sum(map(len, words)), len(repeated), len(lines) - len(set(lines)))] += 1
    assert out == want
    assert rule_cascade.cascade(empty).count() == 0


def test_mixing(odd, empty):
    out = mixing.mix(odd).collect()
    size, target, taken = {}, {}, Counter()
    for r, source in zip(sorted(out, key=str), out, strict=True):
        del source
        assert 0 <= r.taken <= 3 * r.size
        size[r.source_size], target[r.source_size] = r.source_size, r.target
        taken[r.source_size] += r.taken
    assert len(size) == 3
    assert sum(target.values()) == pytest.approx(sum(size.values()))
    for s in size:
        assert 0 <= target[s] <= 3 * s + 1e-6 and abs(taken[s] - target[s]) <= mixing.BLOCK_WORDS
    assert sorted(map(str, out)) == sorted(map(str, mixing.mix(odd).collect()))
    assert mixing.mix(empty).count() == 0


@pytest.mark.parametrize("sizes", [[10, 500, 9000, 40], [1, 1, 1, 10_000, 3], [0, 0, 7], [100] * 7])
def test_targets_by_repeated_sharing(spark, sizes):
    rows = spark.createDataFrame([(f"s{k}", n) for k, n in enumerate(sizes)], "source string, size long")
    got = {r.source: r.target for r in mixing.targets(rows).collect()}
    weight = {f"s{k}": (5, 2, 1)[k % 3] for k in range(len(sizes))}
    cap, want, rest, free = {f"s{k}": 3 * n for k, n in enumerate(sizes)}, {}, float(sum(sizes)), set(weight)
    while free:  # share by weight; whoever is above its cap stops at it, and the rest is shared anew
        share = {s: rest * weight[s] / sum(weight[t] for t in free) for s in free}
        over = {s for s in free if share[s] >= cap[s]}
        if not over:
            want |= share
            break
        want |= {s: cap[s] for s in over}
        rest -= sum(cap[s] for s in over)
        free -= over
    assert got == pytest.approx(want)


def test_pipeline_stages_on_odd_input(odd, empty, marks, tmp_path, spark):
    folder = str(tmp_path)
    marks.write.parquet(f"{folder}/labels.parquet")
    for start in (odd.select("doc_id", "text", "lang", "source", "n_chars"), empty.select("doc_id", "text", "lang", "source", "n_chars")):
        docs = start
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, folder)
            assert k == len(corpus_pipeline.STAGES) - 1 or out.columns == start.columns
            path = f"{folder}/{start.count()}-{k}"
            out.write.parquet(path)
            docs = spark.read.parquet(path)
