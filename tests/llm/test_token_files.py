"""Token files against the tokenizers library, bit packing by brute force, random access and damage."""

import io
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shelfspark.llm import token_files as tf

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, id string, part int, n int, ids string"
ODD = [
    None, "", " ", "\n \n", "Word, word. WORD", "don't you're 'S it's", "áb é, é,́x", "İstanbul İ, straße", "x y z\tq\r\nw\x1cv\x0bu",
    "ΣΑΣ ς.", "漢字。テスト", "a<|endoftext|>b <|startoftext|>", "1234 5,6 ²½Ⅷ", "....,,,!!?? ;:", "<|endoftext|", "café!café? naïve;", "\U0001f600\U0001f3fd, ok", "z" * 3000,
]


@pytest.mark.parametrize("width", [1, 3, 7, 8, 11, 16, 17, 24, 31, 32])
def test_packing(width):
    rnd = np.random.default_rng(width)
    for n in (0, 1, 5, 8, 4097):
        ids = rnd.integers(0, 1 << width, n, dtype=np.uint64).astype("<u4")
        data = tf.pack(ids, width)
        assert len(data) == -(-n * width // 8)
        whole = sum(int(v) << (width * i) for i, v in enumerate(ids.tolist()))
        assert data == whole.to_bytes(len(data), "little")
        assert (tf.unpack(data, width, n) == ids).all()


def test_width():
    assert [tf.width_of(n) for n in (1, 2, 3, 256, 257, 49_408, 65_536, 65_537)] == [1, 1, 2, 8, 9, 16, 16, 17]


class Kept(io.BytesIO):
    def close(self):
        pass


@pytest.mark.parametrize("width, count", [(16, 0), (16, 1), (17, 64), (17, 65), (13, 100_000)])
def test_random_access(width, count):
    ids = np.random.default_rng(3).integers(0, 1 << width, count).astype("<u4")
    out, at = Kept(), 0
    w = tf.Writer(out, width, block=64)
    rnd = random.Random(1)
    while at < count:
        step = rnd.choice((1, 2, 63, 64, 65, 9000))
        w.append(ids[at : at + step])
        at += step
    w.close()
    data = out.getvalue()
    r = tf.Reader(io.BytesIO(data), len(data))
    assert r.ids == count
    for _ in range(200):
        a = rnd.randint(0, count)
        n = rnd.randint(0, min(count - a, rnd.choice((1, 70, 100_000))))
        assert np.concatenate([*r.runs(a, n), np.empty(0, np.uint32)]).tolist() == ids[a : a + n].tolist()
    with pytest.raises(IndexError):
        list(r.runs(count, 1))
    if count:
        bad = bytearray(data)
        bad[len(tf.MAGIC)] ^= 1
        with pytest.raises(ValueError):
            list(tf.Reader(io.BytesIO(bytes(bad)), len(bad)).runs(0, 1))


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_encoder_equals_the_library(path):
    with open(path, "rb") as f:
        e = tf.Encoder(f.read())
    assert e.by_chunk == (path == WORD)
    t = Tokenizer.from_file(path)
    rnd = random.Random(9)
    parts = ["a", "B", "é", "é", "'", "'s", "'LL", " ", "\n", ",", ".", "İ", "ß", "漢", "9", "́", "<|endoftext|>", "-", "\t", " ", "\x1c", "ing", "The "]
    texts = [t or "" for t in ODD] + ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 40))) for _ in range(3000)]
    want = [np.array(x.ids, "<u4").tobytes() for x in t.encode_batch(texts, add_special_tokens=False)]
    assert e.encode(texts) == want and e.encode(texts) == want


def test_slices_and_forgetting(monkeypatch):
    monkeypatch.setattr(tf, "SLICE_CHARS", 50)
    monkeypatch.setattr(tf, "CACHE_BYTES", 4000)
    with open(WORD, "rb") as f:
        e = tf.Encoder(f.read())
    text = " ".join(f"word{i} été, x  y\n" for i in range(500))
    assert e.encode([text])[0] == np.array(Tokenizer.from_file(WORD).encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert len(e) + len(e.elder) < 200


def brute(rows, path):
    t, out, start = Tokenizer.from_file(path), [], 0
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*t.encode(r[1] or "", add_special_tokens=False).ids, 2]
        out.append((r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), np.array(ids, "<u4").tobytes()))
        start += len(ids)
    return out


@pytest.mark.parametrize("path, file_ids", [(WORD, 200), (BYTE, 1 << 20)])
def test_files(spark, tmp_path, path, file_ids):
    rnd = random.Random(4)
    rows = [(i * 7 - 50, t, "a", 1, 2, "c") for i, t in enumerate(ODD)]
    rows += [(1000 + i, " ".join(rnd.choice(("alpha", "beta", "42")) for _ in range(rnd.randint(0, 30))), "a", 1, 2, "c") for i in range(120)]
    rnd.shuffle(rows)
    folder, index = tf.write(spark.createDataFrame(rows, SCHEMA), path, 2, folder=str(tmp_path / "files"), file_ids=file_ids)
    got = sorted(map(tuple, tf.read(folder, index).collect()), key=lambda r: r[1])
    assert got == brute(rows, path)
    names = {r.file for r in index.collect()}
    assert names == {f.name for f in (tmp_path / "files").iterdir()}
    assert len(names) > 8 if file_ids == 200 else len(names) <= 5


def test_repeated_and_null_ids(spark):
    rows = [(5, f"hot {i % 3}", "", 0, 0, "") for i in range(300)] + [(None, "none", "", 0, 0, "")] * 200 + [(i, "w " * i, "", 0, 0, "") for i in range(10)]
    folder, index = tf.write(spark.createDataFrame(rows, SCHEMA).repartition(3), WORD, 2)
    got = sorted(map(tuple, tf.read(folder, index, ids=False).collect()), key=lambda r: r[1])
    want = brute(rows, WORD)
    assert [r[0] for r in got] == [r[0] for r in want]
    assert sorted((repr(r[0]), r[2], r[3]) for r in got) == sorted((repr(r[0]), r[2], r[3]) for r in want)
    assert [r[1] for r in got] == np.cumsum([0] + [r[2] for r in got[:-1]]).tolist()
    assert index.where("doc_id = 5").select("file").distinct().count() > 1  # dealt over several tasks


def test_empty_table(spark):
    folder, index = tf.write(spark.createDataFrame([], SCHEMA), WORD, 2)
    assert tf.read(folder, index).collect() == []
