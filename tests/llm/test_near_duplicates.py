"""The near-duplicate stage holds to five words and 80 percent."""

import random

import corpus_pipeline
from shelfspark.llm import jaccard_join


def shingles(text, words):
    w = text.split()
    return {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))}


def similarity(a, b, words):
    a, b = shingles(a, words), shingles(b, words)
    return len(a & b) / len(a | b)


def test_stage_drops_copies_from_80_percent(spark):
    rnd = random.Random(5)
    rows, expected = [], set()
    for group in range(6):
        words = [f"w{rnd.randrange(10**6)}" for _ in range(400)]
        extra = [f"x{rnd.randrange(10**6)}" for _ in range(100)]
        copies = [words[:328], words[:332], [*words, *extra[:80]], [*words, *extra[:90]], words[:310], [*words, *extra]]
        for k, copy in enumerate([words, copies[group]]):
            rows.append((2 * group + k, " ".join(copy)))
        near = similarity(rows[-2][1], rows[-1][1], 5)
        assert group >= 4 and near < 0.8 or group < 4 and 0.8 <= near < 0.85
        expected |= {2 * group} if near >= 0.8 else {2 * group, 2 * group + 1}
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    assert {r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, docs, "").collect()} == expected
    # the query's own contract stays at four words and 85 percent
    assert {r.component_id for r in jaccard_join.join(docs).collect()} == {i for i, _ in rows}


def test_words_of_a_shingle(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h"), (2, "a b c d e"), (3, "a b c"), (4, None)], "doc_id int, text string")
    for words, counts in ((4, [5, 2, 1, 0]), (5, [4, 1, 1, 0])):
        assert [r.n_shingles for r in sorted(jaccard_join.join(docs, words=words).collect())] == counts
