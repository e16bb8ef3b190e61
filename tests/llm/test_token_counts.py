"""Count-only Viterbi against the public unigram encoder and against brute force over all segmentations."""

import itertools
import random

import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer, models

from shelfspark.llm import token_counts
from shelfspark.llm.queries import PIECES, op3_token_counts

PATH = public_tokenizers.path(PIECES)
SF = "/root/testdata/sf0.001"


def library():
    """The public library's unigram encoder over the same pieces, scores and byte pieces."""
    m = sentencepiece.SentencePieceProcessor(model_file=PATH)
    vocab = [(m.id_to_piece(i), m.get_score(i)) for i in range(m.get_piece_size())]
    return Tokenizer(models.Unigram(vocab, unk_id=0, byte_fallback=True))


def marked(text):
    return "▁" + text.replace(" ", "▁")


def test_documents_as_the_library(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    lib = library()
    got = {r.doc_id: (r.n_chars, r.n_tokens) for r in op3_token_counts(spark, SF).collect()}
    assert got == {i: (len(t or ""), len(lib.encode(marked(t), add_special_tokens=False).ids) if t else 0) for i, t in texts.items()}
    assert sum(n for _, n in got.values()) > 0


def test_odd_texts_as_the_library():
    with open(PATH, "rb") as f:
        counter = token_counts.from_model(f.read())
    lib, rnd = library(), random.Random(5)
    chars = list("aeinst  \n\t.'1") + ["▁", "é", "梦", "\U0001f600", "\x00", "ﷺ", "①"]
    texts = ["".join(rnd.choices(chars, k=rnd.randint(1, 60))) for _ in range(400)]
    texts += [" ", "  ", "a" * 9000, "ab" * 5000, "x\n\ny", " lead", "trail ", "\n"]
    for t in texts:
        assert counter.count(t) == len(lib.encode(marked(t), add_special_tokens=False).ids), repr(t)


def brute(text, scores, unknown, byte_pieces):
    """Every segmentation; ties as the encoders break them: from the end, the piece that starts earliest."""
    found = []
    for cuts in itertools.product([0, 1], repeat=len(text) - 1):
        at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(text)]
        parts = [text[a:b] for a, b in zip(at, at[1:])]
        if all(p in scores or len(p) == 1 for p in parts):
            total = sum(scores[p] if p in scores else unknown for p in parts)
            found.append((-total, at[::-1][1:], parts))
    parts = min(found)[2]
    if byte_pieces:
        return sum(1 if p in scores else len(p.encode()) for p in parts)
    return sum(p in scores or i == 0 or parts[i - 1] in scores for i, p in enumerate(parts))


def test_ties_and_unknown_runs_by_brute_force():
    rnd = random.Random(9)
    for _ in range(300):
        pool = ["".join(rnd.choices("abc▁", k=rnd.randint(1, 4))) for _ in range(8)]
        scores = {p: float(rnd.randint(-3, -1)) for p in pool}
        byte_pieces = rnd.random() < 0.5
        least = min(scores.values())
        counter = token_counts.Unigram(scores, least, byte_pieces)
        for _ in range(5):
            text = "".join(rnd.choices("abcd \n", k=rnd.randint(1, 9)))
            want = brute(marked(text), scores, least - token_counts.UNKNOWN_PENALTY, byte_pieces)
            assert counter.count(text) == want, (text, scores, byte_pieces)


def test_long_text_equals_its_chunks(monkeypatch):
    with open(PATH, "rb") as f:
        counter = token_counts.from_model(f.read())
    text = " ".join(f"word{i} running" for i in range(3000))
    monkeypatch.setattr(token_counts, "CACHE_CHUNKS", 50)
    assert counter.count(text) == counter.viterbi(marked(text))


def test_nulls_empty_repeats_clashing_columns(spark):
    rows = [(1, None, 5, "x"), (2, "", 5, "x"), (3, "one two", 5, "x"), (3, "one two", 5, "x"), (None, "one", 5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, id string")
    got = sorted(map(tuple, token_counts.count_tokens(docs, PATH).collect()), key=str)
    one, two = (len(library().encode(marked(t), add_special_tokens=False).ids) for t in ("one", "one two"))
    assert got == sorted([(1, 0, 0), (2, 0, 0), (3, 7, two), (3, 7, two), (None, 3, one)], key=str)
    assert token_counts.count_tokens(docs.limit(0), PATH).count() == 0
