"""Token-ID files: fixed-width bit packing with block offsets.

Every id takes the fewest bits that hold the vocabulary's largest id.  A file is

    magic ``TOKBITS1`` | blocks | footer | width, ids per block, blocks (uint32), ids, footer's place (uint64) | magic

with all numbers little-endian.  A block holds ``BLOCK_IDS`` ids (the last one fewer), bit after bit from the lowest on,
padded to whole bytes; the footer has the place of each block in the file, one place past the last, and the CRC-32 of
each block.  Ids of documents follow each other without gaps or padding, over block borders.  So any run of ids is read
by seeking to its first block, and unpacked by numpy at once.

``write`` deals documents by ranges of ascending ids (``ranges``) to tasks that sort them, append them to files of about
``FILE_IDS`` ids, and return one index row per document: its file and its place in it.  A task that runs again writes
files of other names; the index, a Parquet table that Spark commits, names those that count, and ``start`` in it is the
number of ids of all documents before.  ``read`` goes through the index and reads the files.  Documents are never cut
in two files, and never held unpacked as a whole when read.

Files are opened by ``pyarrow.fs`` in the tasks, so the folder may be any that all executors reach: a shared path, or
an hdfs://, s3:// or gs:// address.

Edge cases: a null text counts as empty; an empty text has the end id alone; null ids come first; rows of the same id
follow each other, in an order that isn't fixed, and an id with a large share of all rows is dealt over several tasks;
an empty table gives no files and no rows; texts of any length are encoded in slices that no token crosses; extra
columns are ignored.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from .bpe import _parts, _ranks
from .common import only, shared_dir, ship, stored

MAGIC = b"TOKBITS1"
BLOCK_IDS = 4096
FILE_IDS = 1 << 25
#: Blocks unpacked at once when reading.
READ_BLOCKS = 64
_TAIL = struct.Struct("<3I2Q8s")


def width_of(vocabulary: int) -> int:
    """Bits that hold the ids 0 .. vocabulary - 1."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """The ids' lowest ``width`` bits, one after the other, the last byte padded with zeros."""
    octets = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if width % 8 == 0:
        return octets[:, : width // 8].tobytes()
    return np.packbits(np.unpackbits(octets, axis=1, bitorder="little")[:, :width], bitorder="little").tobytes()


def unpack(data: bytes, width: int, count: int) -> np.ndarray:
    """The first ``count`` ids of packed bytes."""
    octets = np.zeros((count, 4), np.uint8)
    if width % 8 == 0:
        octets[:, : width // 8] = np.frombuffer(data, np.uint8, count * (width // 8)).reshape(count, width // 8)
    else:
        bits = np.unpackbits(np.frombuffer(data, np.uint8), count=count * width, bitorder="little").reshape(count, width)
        octets[:, : (width + 7) // 8] = np.packbits(bits, axis=1, bitorder="little")
    return octets.view("<u4").ravel()


class Writer:
    """One file; ids are appended and packed block by block."""

    def __init__(self, stream, width: int, block: int = BLOCK_IDS):
        self.stream, self.width, self.block = stream, width, block
        self.held, self.waiting, self.ids = [], 0, 0
        self.places, self.sums = [len(MAGIC)], []
        stream.write(MAGIC)

    def append(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.waiting += len(ids)
        self.ids += len(ids)
        if self.waiting >= READ_BLOCKS * self.block:
            self._flush(self.waiting // self.block * self.block)

    def _flush(self, count: int) -> None:
        every = np.concatenate([*self.held, np.empty(0, np.uint32)])
        for at in range(0, count, self.block):
            data = pack(every[at : min(at + self.block, count)], self.width)
            self.stream.write(data)
            self.places.append(self.places[-1] + len(data))
            self.sums.append(zlib.crc32(data))
        self.held, self.waiting = [every[count:]], len(every) - count

    def close(self) -> None:
        self._flush(self.waiting)
        self.stream.write(np.array(self.places, "<u8").tobytes() + np.array(self.sums, "<u4").tobytes())
        self.stream.write(_TAIL.pack(self.width, self.block, len(self.sums), self.ids, self.places[-1], MAGIC))
        self.stream.close()


class Reader:
    """Random access to the ids of one file."""

    def __init__(self, stream, size: int):
        self.stream = stream
        stream.seek(size - _TAIL.size)
        self.width, self.block, blocks, self.ids, foot, magic = _TAIL.unpack(stream.read(_TAIL.size))
        if magic != MAGIC:
            raise ValueError("not a token file")
        stream.seek(foot)
        self.places = np.frombuffer(stream.read(8 * (blocks + 1)), "<u8").tolist()
        self.sums = np.frombuffer(stream.read(4 * blocks), "<u4").tolist()
        self._first, self._held = 0, np.empty(0, np.uint32)

    def _blocks(self, first: int) -> np.ndarray:
        """The ids of some blocks from ``first`` on; the last ones read are kept."""
        if not (self._first <= first * self.block < self._first + len(self._held)):
            last = min(first + READ_BLOCKS, len(self.sums))
            self.stream.seek(self.places[first])
            data = memoryview(self.stream.read(self.places[last] - self.places[first]))
            parts = []
            for b in range(first, last):
                one = data[self.places[b] - self.places[first] : self.places[b + 1] - self.places[first]]
                if zlib.crc32(one) != self.sums[b]:
                    raise ValueError(f"block {b} is damaged")
                parts.append(unpack(one, self.width, min(self.block, self.ids - b * self.block)))
            self._first, self._held = first * self.block, np.concatenate(parts)
        return self._held

    def runs(self, start: int, count: int) -> Iterator[np.ndarray]:
        """The ids from ``start`` on, in runs of bounded length."""
        if start < 0 or start + count > self.ids:
            raise IndexError("beyond the file's ids")
        while count:
            held = self._blocks(start // self.block)
            run = held[start - self._first : start - self._first + count]
            yield run
            start, count = start + len(run), count - len(run)


#: Letters that every version of Unicode calls so and that never combine with each other, and the ASCII
#: signs without the apostrophe (which may begin a token of letters) and ``<`` (which may begin a special token).
_LETTERS, _SIGNS = "a-zA-ZÀ-ÖØ-öø-ɏ", r"!\"#$%&()*+,\-./:;=>?@\[\\\]^_`{|}~"
#: Chunks are cached in two generations of up to so many bytes each in a worker (an entry takes about 200 besides): the
#: elder one goes when the younger is full, and what is met again in it moves to the younger; results never change.
#: Long texts are encoded in slices of about so many characters.
CACHE_BYTES, ENTRY_BYTES, SLICE_CHARS = 128 << 20, 200, 1 << 20


class Encoder(dict):
    """Ids of texts, as the tokenizer gives them, by chunks between spaces; as a mapping, the cached chunks.

    The tokenizer drops white space and its tokens never cross it.  A chunk of plain letters, digits and signs falls
    into runs of letters, single digits and runs of signs, each with ids of its own.  A run of letters goes to the
    tokenizer's model as the characters that its normalizer and pre-tokenizer make of each letter; all else goes through
    the tokenizer as a whole.  ``check`` says whether a tokenizer is one of these; texts of all others are encoded whole."""

    def __init__(self, data: bytes):
        super().__init__({"": b""})
        self.tokenizer = Tokenizer.from_buffer(data)
        self.size = max(self.tokenizer.get_vocab().values(), default=0) + 1
        self.used, self.elder = 0, {}
        self.model = self.tokenizer.model
        shown = {c: self._shown(c) for c in re.findall(f"[{_LETTERS}]", "".join(map(chr, range(0x250))))}
        self.letters = {ord(c): s for c, s in shown.items() if s is not None}
        letters = "".join(map(chr, self.letters))
        self.by_chunk = bool(letters)
        if letters:
            self.word, self.plain = re.compile(f"[{letters}]+").fullmatch, re.compile(f"[{letters}0-9{_SIGNS}]+").fullmatch
            self.runs = re.compile(f"[{letters}]+|[0-9]|[{_SIGNS}]+").findall
            self.by_chunk = self.check(letters)

    def _shown(self, letter: str) -> str | None:
        """What the model is given for a letter."""
        one, steps = letter, self.tokenizer
        if steps.normalizer is not None:
            one = steps.normalizer.normalize_str(one)
        if steps.pre_tokenizer is not None:
            parts = steps.pre_tokenizer.pre_tokenize_str(one)
            one = parts[0][0] if len(parts) == 1 else None
        return one

    def check(self, letters: str) -> bool:
        words = [letters[i : i + 7] for i in range(len(letters) - 6)]
        signs = "".join(c for c in map(chr, range(33, 127)) if self.plain(c) and not c.isalnum())
        sample = f"Ab, c'd é;\n 12e.f3-4  g {' '.join(f'a{s}b{s}1{s}{s}2' for s in signs)} x{signs}y7 {signs[::-1]}"
        parts = [p for chunk in re.split("[ \n]+", sample) for p in (self.runs(chunk) if self.plain(chunk) else [chunk])]
        return (
            [self._model(w) for w in words] == self._ids(words)
            and self._ids([sample])[0] == b"".join(self._ids(parts))
            and self._ids([" \n"])[0] == b""
        )

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _model(self, word: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(word.translate(self.letters))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def __missing__(self, chunk: str) -> bytes:
        ids = self.elder.get(chunk)
        if ids is None:
            if self.word(chunk):
                ids = self._model(chunk)
            elif self.plain(chunk) and len(runs := self.runs(chunk)) > 1:
                ids = b"".join([self[r] for r in runs])
            else:
                ids = self._ids([chunk])[0]
        self[chunk] = ids
        self.used += ENTRY_BYTES + len(chunk) + len(ids)
        return ids

    def slices(self, text: str) -> Iterator[str]:
        at = 0
        while len(text) - at > SLICE_CHARS:
            cut = text.find(" ", at + SLICE_CHARS)
            if cut < 0:
                break
            yield text[at:cut]
            at = cut + 1
        yield text[at:] if at else text

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed little-endian 32-bit ids of each text."""
        if not self.by_chunk:
            return self._ids(texts)
        out = []
        for text in texts:
            ids = []
            for one in self.slices(text):
                ids.append(b"".join(map(self.__getitem__, one.replace("\n", " ").split(" "))))
                if self.used > CACHE_BYTES:
                    self.forget()
            out.append(b"".join(ids))
        return out

    def forget(self) -> None:
        self.elder, self.used = dict(self), 0
        self.clear()
        self[""] = b""


@lru_cache(maxsize=1)
def encoder(data: bytes) -> Encoder:
    """One encoder per worker process, so that its cache lasts over tasks."""
    return Encoder(data)


class Ranges:
    """Ranges of ascending ids, nulls first; an id that takes up several ranges has its rows dealt over them."""

    def __init__(self, nulls: int, cuts: list[int]):
        self.nulls, self.cuts, self.count = nulls, np.array(cuts, np.int64), nulls + len(cuts) + 1
        self.seen = 0

    def of(self, ids: pa.Array) -> np.ndarray:
        row = np.arange(self.seen, self.seen + len(ids))
        self.seen += len(ids)
        null = ids.is_null().to_numpy(zero_copy_only=False)
        values = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        first = np.searchsorted(self.cuts, values, "left")
        # rows of an id that is a cut may stand at the end of one range, at the start of another, and in all between
        own = np.searchsorted(self.cuts, values, "right") - first + 1
        return np.where(null, row % max(1, self.nulls), self.nulls + first + row % own)


def ranges(ids: DataFrame, parts: int) -> Ranges:
    """``parts`` ranges of about equally many rows; ``ids`` has the column ``id`` alone, so that nothing else is read."""
    counts = ids.agg(F.count(F.lit(1)).alias("rows"), F.count("id").alias("named")).first()
    nulls = -(-parts * (counts["rows"] - counts["named"]) // max(counts["rows"], 1))
    fractions = [k / max(1, parts - nulls) for k in range(1, parts - nulls)]
    cuts = ids.agg(F.percentile_approx("id", fractions, 10_000).alias("at")).first()["at"] if fractions else None
    return Ranges(nulls, cuts or [])


def encoded(src: DataFrame, data: bytes, end_id: int | None, dealt: Ranges) -> DataFrame:
    """id, ``part`` (the id's range), ``n`` and ``ids``, packed in the vocabulary's width, of every row."""
    sent = src.sparkSession.sparkContext.broadcast((data, dealt))  # the vocabulary file, a few MB, and a number per range
    schema = T.StructType([
        src.schema["id"], T.StructField("part", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("ids", T.BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, dealt = sent.value
        e, to = encoder(data), Ranges(dealt.nulls, dealt.cuts.tolist())
        width, end = width_of(e.size), b"" if end_id is None else np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for part in _parts(batch, 64):
                ids = [np.frombuffer(x + end, "<u4") for x in e.encode([t or "" for t in part.column(1).to_pylist()])]
                columns = [pa.array(to.of(part.column(0)), pa.int32()), pa.array([len(x) for x in ids], pa.int64())]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns, pa.array([pack(x, width) for x in ids], pa.binary())], names=schema.names)

    return src.mapInArrow(run, schema)


def write(
    docs: DataFrame, tokenizer_path: str, end_id: int | None, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text",
    file_ids: int = FILE_IDS,
) -> tuple[str, DataFrame]:
    """Write the token files; returns their folder and the index: id, ``start``, ``n``, ``file`` and ``at`` (the first
    id's place in the file)."""
    src = only(docs, id_col, text_col).toDF("id", "text")
    spark = src.sparkSession
    ship(spark)
    folder = (folder or f"{shared_dir(spark).rstrip('/')}/token-files-{uuid.uuid4().hex}").rstrip("/")
    data = _ranks(tokenizer_path)
    width = width_of(encoder(data).size)
    dealt = ranges(src.select("id"), int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = encoded(src, data, end_id, dealt).repartitionById(dealt.count, "part").sortWithinPartitions(F.col("id").asc_nulls_first())
    schema = T.StructType([
        src.schema["id"], T.StructField("part", T.IntegerType()), T.StructField("rel", T.LongType()), T.StructField("n", T.LongType()),
        T.StructField("file", T.StringType()), T.StructField("at", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        number, rel, name, out = TaskContext.get().partitionId(), 0, None, None
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                rels, files, ats = [], [], []
                for packed, n in zip(part.column("ids"), part.column("n").to_pylist(), strict=True):
                    if out is None or out.ids >= file_ids:
                        if out is not None:
                            out.close()
                        name = f"part-{number:06d}-{rel:014d}-{uuid.uuid4().hex}.bits"
                        out = Writer(fs.open_output_stream(f"{base}/{name}"), width)
                    rels.append(rel)
                    files.append(name)
                    ats.append(out.ids)
                    out.append(unpack(packed.as_buffer(), width, n))
                    rel += n
                numbers = pa.array([number] * part.num_rows, pa.int32())
                columns = [part.column("id"), numbers, pa.array(rels, pa.int64()), part.column("n"), pa.array(files, pa.string()), pa.array(ats, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
        if out is not None:
            out.close()

    index = stored(rows.mapInArrow(run, schema), "token-index")
    totals = index.groupBy("part").agg(F.sum("n").alias("ids")).orderBy("part").collect()  # a row a task
    starts, upto = [], 0
    for r in totals:
        starts += [F.lit(r["part"]), F.lit(upto)]
        upto += r["ids"]
    base = F.element_at(F.create_map(*starts), F.col("part")) if starts else F.lit(0)
    return folder, index.select(F.col("id").alias(id_col), (base + F.col("rel")).cast("long").alias("start"), "n", "file", "at")


def read(folder: str, index: DataFrame, id_col: str = "doc_id", ids: bool = True) -> DataFrame:
    """id, ``start``, ``n``, ``crc`` (CRC-32 of the ids as little-endian unsigned 32-bit integers) and, unless told
    otherwise, ``ids`` (these integers) of every row of the index, from the files."""
    fields = [index.schema[c] for c in (id_col, "start", "n")] + [T.StructField("crc", T.LongType())]
    schema = T.StructType([*fields, *([T.StructField("ids", T.BinaryType())] if ids else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        name, reader = None, None
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part, sums, texts = batch.slice(i, 256), [], []
                for file, at, n in zip(*[part.column(c).to_pylist() for c in ("file", "at", "n")], strict=True):
                    if file != name:
                        if reader is not None:
                            reader.stream.close()
                        path = f"{base}/{file}"
                        name, reader = file, Reader(fs.open_input_file(path), fs.get_file_info(path).size)
                    crc, kept = 0, []
                    for run_ids in reader.runs(at, n):
                        crc = zlib.crc32(run_ids, crc)
                        if ids:
                            kept.append(run_ids.tobytes())
                    sums.append(crc)
                    texts.append(b"".join(kept))
                columns = [*[part.column(f.name) for f in fields[:3]], pa.array(sums, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns + ([pa.array(texts, pa.binary())] if ids else []), names=schema.names)
        if reader is not None:
            reader.stream.close()

    return index.select(*[f"`{f.name}`" for f in fields[:3]], "file", "at").mapInArrow(run, schema)
