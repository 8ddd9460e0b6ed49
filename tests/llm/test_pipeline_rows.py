"""Rows of the pipeline's stages: ids null or repeated, columns named like the operators' own."""

from collections import Counter

from tramflow.llm import mixing, suffix_dedup

SHAPE = "doc_id long, text string, lang string, source string, n_chars long, node string, ranges string, size string, taken string, _row string, c0 string"


def rows(spark):
    same = "word " * 40
    ids = [(None, f"a {same}"), (None, f"b {same}"), (None, f"c {same}"), (1, f"d {same}"), (1, f"e {same}"), (2, f"f {same}")]
    return spark.createDataFrame([(i, t, "en", "s", None, "n", "r", "z", "t", "w", "c") for i, t in ids], SHAPE)


def test_mix_gives_each_row_its_own_quota(spark):
    docs = rows(spark)
    taken = Counter(r.taken for r in mixing.mix(docs).collect())
    out = mixing.mixed(docs).collect()
    words = sum(len(r.text.split()) for r in out)
    assert words == sum(n * k for n, k in taken.items())
    assert len(out) == sum(-(-n // 41) * k for n, k in taken.items()) < 9
    assert {(r.doc_id, r.text) for r in docs.collect()} <= {(r.doc_id, r.text) for r in out}
    assert mixing.mixed(docs).columns == docs.columns and mixing.mixed(docs.limit(0)).count() == 0


def test_repeats_are_cut_beside_columns_of_any_name(spark):
    passage = "".join(chr(97 + (k * k) % 23) for k in range(500))
    unique = [f"{k} begins " * 9 for k in range(2)]
    given = [(0, unique[0] + passage, "en", "s", None, "n", "r", "z", "t", "w", "c"), (1, passage + unique[1], "de", None, 7, None, "r", "z", "t", "w", "c"), (None, None, None, None, None, None, None, None, None, None, None)]
    out = suffix_dedup.without_repeats(spark.createDataFrame(given, SHAPE)).collect()
    found = {r.doc_id: r for r in out}
    assert [found[k].text.strip() for k in (0, 1)] == [u.strip() for u in unique] and found[None].text == ""
    assert (found[1].node, found[0].ranges, found[1].lang, found[0].n_chars) == (None, "r", "de", len(found[0].text))
