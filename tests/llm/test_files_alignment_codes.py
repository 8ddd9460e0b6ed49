"""Token stores, the alignment of two tokenizers and vector codes, against brute force on odd inputs."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tramflow.llm import common, token_align, token_store, vector_codes

SHAPE = "doc_id long, text string, lang string, file string, shard string, key string, n long, block string, pair string, size string"
WORDS = public_tokenizers.path(token_store.VOCABULARY)
A, B = public_tokenizers.path(token_align.VOCABULARY_A), public_tokenizers.path(token_align.VOCABULARY_B)


def texts():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgéñ漢😀'") for _ in range(rng.randint(1, 9))) for _ in range(2000)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    odd = ["", None, " ", "\n\n\t ", "a▁b", "x" * 5000, "<|endoftext|> and <s> </s>", "é ΣΑΣ İ\x1c\x00y z　w", " lead", "trail  ", "12345 it's we'LL", "la la la " * 90, prose(20000)]
    return [*odd, *(prose(rng.randint(1, 300)) for _ in range(60)), *["copied " * 9] * 40]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(k, t, None, *["clash"] * 3, 7, *["clash"] * 3) for k, t in enumerate(texts())]
    return spark.createDataFrame([*rows, rows[20], rows[1], (None, "no id", *[None] * 8), (3, "other text of an id", *[None] * 8)], SHAPE)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SHAPE)


def pairs_of(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


# ---- token stores


def stored(spark, docs, scratch, **kw):
    folder = f"file:{scratch}/store"
    token_store.write(docs, folder, WORDS)
    return folder, token_store.read(spark, folder, **kw)


def test_store_reads_back_what_the_library_encodes(spark, odd, scratch):
    tokenizer = Tokenizer.from_file(WORDS)
    folder, back = stored(spark, odd, scratch, with_ids=True)
    rows = sorted(back.collect(), key=lambda r: r.start)
    want = Counter((d, (*tokenizer.encode(t or "", add_special_tokens=False).ids, 2)) for d, t in pairs_of(odd))
    assert Counter((r.doc_id, tuple(r.ids)) for r in rows) == want
    assert [r.doc_id for r in rows if r.doc_id is not None] == sorted(r.doc_id for r in rows if r.doc_id is not None) and rows[-1].doc_id is None
    at = 0
    for r in rows:
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(r.ids), zlib.crc32(np.array(r.ids, "<u4")))
        at += len(r.ids)
    few = odd.where("doc_id IN (3, 12, 20) OR doc_id IS NULL").select("doc_id")
    found = token_store.read(spark, folder, few).collect()
    assert sorted((r.start, r.n_tokens) for r in found) == [(r.start, r.n_tokens) for r in rows if r.doc_id in (3, 12, 20, None)]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \t\n\r\x0b\x0c\x1c\x85  'sStTrReE<|endoftext|>̧́Aéσς가")), max_size=60))
def test_words_one_by_one_give_the_ids_of_the_text(text):
    encoder = token_store.word_encoder(WORDS)
    assert np.frombuffer(encoder.encode([text])[0], encoder.kind).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(max_codepoint=255), st.sampled_from(" \n'sStTrReEvVlLmMdD09!")), max_size=40), st.text(alphabet="ab's\u00e9\u00a0. ", max_size=9))
def test_texts_of_latin_letters_are_split_as_the_library_does(text, other):
    encoder = token_store.word_encoder(WORDS)
    want = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in (text, other, "", text)]
    assert [np.frombuffer(x, encoder.kind).tolist() for x in encoder.encode([text, other, "", text])] == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\t'sreéñ漢1²,.▁\u3000")), max_size=40), max_size=5))
def test_pieces_apart_give_the_ids_of_the_text(texts):
    first, second = token_align.byte_level(A), token_align.pieces(B)
    for got, whole in ((first.encode(texts), lambda t: first.tokenizer.encode(" " + t, add_special_tokens=False).ids), (second.encode(texts), second.processor.encode)):
        ids, rows = got
        assert [ids[a:b].tolist() for a, b in zip(rows[:-1], rows[1:])] == [whole(t) if t else [] for t in texts]


def test_store_of_an_empty_table_and_of_too_few_rows_to_train_on(spark, odd, empty, scratch):
    folder, back = stored(spark, empty, scratch)
    assert back.count() == 0
    token_store.write(odd.where("doc_id = 11"), folder + "-one", WORDS)
    assert [(r.doc_id, r.start) for r in token_store.read(spark, folder + "-one").collect()] == [(11, 0)]


def test_store_refuses_another_dictionary(spark, odd, scratch):
    folder, back = stored(spark, odd, scratch)
    import glob

    path = glob.glob(f"{scratch}/store/dictionary-*")[0]
    with open(path, "ab") as f:
        f.write(b"x")
    with pytest.raises(Exception, match="is not the one"):
        token_store.dictionary.__wrapped__(folder, path.rsplit("-", 1)[1])


# ---- alignment


def brute_alignment(rows):
    first, second = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    first.encode_special_tokens = True
    letters = {c: bytes([b]) for c, b in common.byte_letters().items()}
    spelled_a = {i: b"".join(letters.get(c, b"?") for c in e) for e, i in first.get_vocab().items()}
    spelled_b = {i: bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode() for i in range(second.get_piece_size()) for p in [second.id_to_piece(i)]}
    out, counts = [], Counter()
    for doc_id, text in rows:
        a, b = (first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)) if text else ([], [])
        if any(b"".join(x) != (" " + (text or "")).encode() for x in ([spelled_a[i] for i in a], [spelled_b[i] for i in b])):
            a = b = []
        links, groups, i, j, to_a, to_b, gi, gj = [], [], 0, 0, 0, 0, 0, 0
        while i < len(a):
            links.append((a[i], b[j]))
            end_a, end_b = to_a + len(spelled_a[a[i]]), to_b + len(spelled_b[b[j]])
            if end_a <= end_b:
                i, to_a = i + 1, end_a
            if end_b <= end_a:
                j, to_b = j + 1, end_b
            if end_a == end_b:
                groups.append(",".join(map(str, a[gi:i])) + "|" + ",".join(map(str, b[gj:j])))
                gi, gj = i, j
        counts.update(links)
        out.append((doc_id, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return Counter((d, na, nb, ng, len(x), sum(counts[p] == best[p[1]] for p in x), sum(counts[p] for p in x), h) for d, na, nb, ng, x, h in out)


def test_alignment(odd, empty):
    want = brute_alignment(pairs_of(odd))
    assert Counter(map(tuple, token_align.aligned(odd, A, B).collect())) == want
    assert (4, 0, 0, 0, 0, 0, 0, "") in want  # a text that one vocabulary spells otherwise
    assert token_align.aligned(empty, A, B).count() == 0


def test_alignment_over_many_blocks(odd):
    docs = common.id_and_text(odd)
    blocks = token_align.tokenise_distinct(docs, A, B, 500).select("block").distinct().count()
    assert blocks > 20 > token_align.tokenise_distinct(docs, A, B).select("block").distinct().count()
    assert Counter(map(tuple, token_align.aligned(odd, A, B, 500).collect())) == Counter(map(tuple, token_align.aligned(odd, A, B).collect()))


def test_measures_reach_rows_of_heavy_and_light_keys(spark, scratch, monkeypatch):
    rows = spark.createDataFrame([(k, None if k % 3 == 0 else k % 7) for k in range(90)], "doc_id long, key long")
    rows.groupBy("key").count().withColumnRenamed("count", "n").selectExpr("key", "n", "n * 10 AS ten").write.parquet(f"{scratch}/m")
    sizes = Counter(r.key for r in rows.collect())
    want = Counter((r.doc_id, r.key, 10 * sizes[r.key]) for r in rows.collect())
    for heavy in (1, 4, 10_000):
        monkeypatch.setattr(common, "HEAVY_KEYS", heavy)
        assert Counter(map(tuple, common.join_measures(rows, spark.read.parquet(f"{scratch}/m"), "key", "n").collect())) == want


# ---- vector codes


def brute_codes(rows):
    kept = [(v, [math.floor(4096 * x) for x in e], label) for v, e, label in rows if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    width = -(-max((len(e) for _, e, _ in kept), default=0) // 8)
    kept = sorted(((v, [*e, *[0] * (8 * width - len(e))], label) for v, e, label in kept), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = lambda e, p: e[p * width : (p + 1) * width]
    books = [[cut(e, p) for _, e, _ in kept[:16]] for p in range(8)]

    def nearest(x, book):
        far = [sum((s - t) ** 2 for s, t in zip(x, y)) for y in book]
        return far.index(min(far)), min(far)

    for _ in range(6):
        for p in range(8):
            members = defaultdict(list)
            for _, e, _ in kept:
                members[nearest(cut(e, p), books[p])[0]].append(cut(e, p))
            for i, xs in members.items():
                books[p][i] = [sum(c) // len(xs) for c in zip(*xs)]
    out, labels = [], Counter()
    for v, e, label in kept:
        found = [nearest(cut(e, p), books[p]) for p in range(8)]
        labels[label] += sum(d for _, d in found)
        out.append((v, "".join(f"{i:02x}" for i, _ in found), sum(d for _, d in found), label))
    sha = hashlib.sha256(",".join(str(x) for book in books for y in book for x in y).encode()).hexdigest()
    long = lambda x: x if x < 2**63 else None
    return Counter((v, c, long(d), long(labels[label]), sha) for v, c, d, label in out)


VECTORS = "vec_id long, embedding array<float>, label int, part long, entry long, n long, key long"


def vectors(dim, scale, n=150):
    rng = random.Random(dim)
    value = lambda: float(np.float32(rng.gauss(0, scale)))
    rows = [(k, [value() for _ in range(dim)], [None, 1, 2, 2][k % 4], 1, 2, 3, 4) for k in range(n)]
    rows += [(n + k, list(rows[0][1]), 1, 1, 2, 3, 4) for k in range(60)]  # one vector many times: ties and unused entries
    bad = [None, [*rows[1][1][:-1], None], [*rows[1][1][:-1], math.nan], [math.inf, *rows[1][1][1:]], [*rows[1][1][:-1], -math.inf]]
    return rows + [(-k, e, 9, 0, 0, 0, 0) for k, e in enumerate(bad)] + [rows[7], (None, rows[3][1], None, 0, 0, 0, 0)]


@pytest.mark.parametrize(("dim", "scale"), [(64, 0.2), (24, 3.0), (8, 1.0), (40, 2e4), (24, 2e7), (16, 3e4)])
def test_vector_codes(spark, dim, scale):
    rows = vectors(dim, scale)
    assert Counter(map(tuple, vector_codes.coded(spark.createDataFrame(rows, VECTORS)).collect())) == brute_codes([r[:3] for r in rows])


def test_vector_codes_of_few_ragged_or_no_rows(spark):
    few = [(k, [0.5 * k] * (3 + k), None, 0, 0, 0, 0) for k in range(5)] + [(9, [], 1, 0, 0, 0, 0)]
    assert Counter(map(tuple, vector_codes.coded(spark.createDataFrame(few, VECTORS)).collect())) == brute_codes([r[:3] for r in few])
    for rows in ([], [(1, None, 1, 0, 0, 0, 0)]):
        assert vector_codes.coded(spark.createDataFrame(rows, VECTORS)).count() == 0
    huge = [(k, [3e14 * (k + 1)] * 8, 1, 0, 0, 0, 0) for k in range(20)]
    out = vector_codes.coded(spark.createDataFrame([*huge, (99, [3e15] * 8, 1, 0, 0, 0, 0)], VECTORS)).collect()
    assert sorted(r.vec_id for r in out) == [0, 1, 2]  # 2**50 and beyond count as infinite


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 20), st.integers(1, 17), st.integers(0, 2**20), st.randoms(use_true_random=False))
def test_transformed_search_equals_plain_search(width, entries, top, rng):
    draw = lambda n: np.array([[rng.randint(-top, top) for _ in range(width)] for _ in range(n)], np.int64)
    parts, book = draw(30), draw(entries)
    plain = ((parts[:, None, :] - book[None]) ** 2).sum(axis=2)
    for kind in (np.int64, object):
        entry, distance = vector_codes.nearest(parts.astype(kind), book.astype(kind))
        assert entry.tolist() == plain.argmin(axis=1).tolist() and distance.tolist() == plain.min(axis=1).tolist()
