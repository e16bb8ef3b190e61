"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` turns documents into index blocks: one row per run of documents (about BLOCK_TOKENS words) that holds,
for every term of the block, the sorted list of its positions, plus the block's documents and where each begins.  The
index is split by document, so building and searching need no shuffle, a term or passage that a third of all documents
hold is spread over all blocks, and a stored index serves any number of benchmark versions.

``search`` looks phrases up in every block: the phrase's rarest term in that block gives the candidate starts, and the
lists of the other terms, rarest first, are intersected after shifting each by its offset in the phrase.  With
``slop`` > 0 a term may lie up to that many words from its place (proximity match); 0 means exact phrases.

The phrases are sent to the tasks in slices of at most SLICE_BYTES of text, so what is broadcast does not grow with
the corpus and is bounded for a benchmark of any size.

Edge cases: null and empty texts have no words and no hits; an item without words has no phrase; items with a null id
are skipped, rows with the same item id are one item; repeated documents give one row each; an empty table gives no
rows (an empty benchmark no hits); extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import only, rest, ship, stored

BLOCK_TOKENS = 1 << 19
WINDOW = 10
SLICE_BYTES = 8 << 20
#: An index row has some 3 MB, so the writer looks at the size of a page and of a row group after each row, not after the
#: usual 100: else a task holds up to 100 rows, writing and reading.
WIDE_ROWS = {
    "parquet.block.size": str(8 << 20), "parquet.block.size.row.check.min": "1", "parquet.block.size.row.check.max": "1",
    "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1",
}

#: Word bytes: 0-9, a-z and everything beyond ASCII, A-Z lower-cased; all other bytes end a word.
_WORD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

INDEX_FIELDS = (
    ("starts", T.BinaryType()),  # int64: first position of each document, and the end
    ("terms", T.ArrayType(T.BinaryType())),
    ("offsets", T.BinaryType()),  # int64: where each term's list begins, and the end
    ("postings", T.BinaryType()),  # int32: all lists, each sorted and delta-coded
)


def tokenize(text: str | None) -> list[bytes]:
    return text.encode().translate(_WORD).split() if text else []


def _block(ids: list, lengths: list[int], tokens: list[int], vocab: dict[bytes, int]) -> dict:
    token_ids = np.array(tokens, np.int32)
    order = np.argsort(token_ids, kind="stable").astype(np.int32)
    offsets = np.zeros(len(vocab) + 1, np.int64)
    np.cumsum(np.bincount(token_ids, minlength=len(vocab)), out=offsets[1:])
    deltas = np.diff(order, prepend=np.int32(0)).astype(np.int32)
    deltas[offsets[:-1]] = order[offsets[:-1]]
    starts = np.concatenate([[0], np.cumsum(lengths)]).astype("<i8")
    return {
        "doc_ids": ids, "starts": starts.tobytes(), "terms": list(vocab), "offsets": offsets.astype("<i8").tobytes(),
        "postings": deltas.astype("<i4").tobytes(),
    }


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Index blocks: block (number), doc_ids (array of the id's type) and INDEX_FIELDS."""
    src = only(docs, id_col, text_col).toDF("id", "text")
    ship(src.sparkSession)
    ids_field = T.StructField("doc_ids", T.ArrayType(src.schema["id"].dataType))
    schema = T.StructType([T.StructField("block", T.LongType()), ids_field, *[T.StructField(*f) for f in INDEX_FIELDS]])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out_schema = to_arrow_schema(schema)
        number = TaskContext.get().partitionId() << 33
        ids, lengths, tokens, vocab = [], [], [], defaultdict(int)
        vocab.default_factory = vocab.__len__

        def flush():
            nonlocal number
            row = {"block": number, **_block(ids, lengths, tokens, vocab)}
            number += 1
            batch = pa.RecordBatch.from_pylist([row], schema=out_schema)
            ids.clear(), lengths.clear(), tokens.clear(), vocab.clear()
            return batch

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                words = tokenize(text.as_py())
                if ids and len(tokens) + len(words) > block_tokens:
                    yield flush()
                ids.append(doc_id.as_py())
                lengths.append(len(words))
                tokens.extend([vocab[w] for w in words])
        if ids:
            yield flush()
        rest()

    return src.mapInArrow(blocks, schema)


def windows(text: str | None, size: int = WINDOW) -> list[tuple[bytes, ...]]:
    """Every run of ``size`` words; a shorter text, if not empty, is one window."""
    words = tokenize(text)
    return [tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []


class Block:
    """One index row, opened."""

    def __init__(self, starts: bytes, terms: list[bytes], offsets: bytes, postings: bytes):
        self.starts = np.frombuffer(starts, "<i8")
        self.vocab = {t: i for i, t in enumerate(terms)}
        self.offsets = np.frombuffer(offsets, "<i8")
        self.deltas = np.frombuffer(postings, "<i4")
        self.lists: dict[int, np.ndarray] = {}

    def postings(self, term: int) -> np.ndarray:
        if term not in self.lists:
            self.lists[term] = np.cumsum(self.deltas[self.offsets[term] : self.offsets[term + 1]], dtype=np.int64)
        return self.lists[term]

    def find(self, phrase: tuple[bytes, ...], slop: int = 0) -> np.ndarray:
        """Starts of the phrase; never across two documents."""
        found = [self.vocab.get(w) for w in phrase]
        if None in found:
            return np.empty(0, np.int64)
        sizes = self.offsets[np.array(found) + 1] - self.offsets[found]
        order = np.argsort(sizes, kind="stable")
        at = self.postings(found[order[0]]) - order[0]
        doc = np.searchsorted(self.starts, at + order[0], "right") - 1
        near = (at >= self.starts[doc] - slop) & (at + len(phrase) <= self.starts[doc + 1] + slop)
        at, doc = at[near], doc[near]
        for k in order[1:]:
            if not len(at):
                break
            own, want = self.postings(found[k]), at + k
            i = np.searchsorted(own, np.maximum(want - slop, self.starts[doc]))
            hit = own[np.minimum(i, len(own) - 1)]
            keep = (i < len(own)) & (hit <= want + slop) & (hit < self.starts[doc + 1])
            at, doc = at[keep], doc[keep]
        return at


def search(index: DataFrame, phrases: list[tuple[tuple[bytes, ...], tuple]], item_type: T.DataType, slop: int = 0) -> DataFrame:
    """Per document: block and place in the index, doc_id, n_words, n_hit (words inside a match), items (distinct, of phrases that match) and spans
    (merged [start, end) word ranges of the matches).  ``phrases``: (words, ids of the items that have them)."""
    spark = index.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(phrases)
    id_type = index.schema["doc_ids"].dataType.elementType
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("place", T.IntegerType()), T.StructField("doc_id", id_type), T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(item_type)), T.StructField("spans", T.ArrayType(span)),
    ])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out_schema = to_arrow_schema(schema)
        for batch in batches:
            for row in range(batch.num_rows):
                number, ids, *parts = (batch.column(c)[row].as_py() for c in range(6))
                block = Block(*parts)
                starts = block.starts
                total = int(starts[-1])
                edges, items = np.zeros(total + 1, np.int64), defaultdict(set)
                for words, owners in sent.value:
                    at = block.find(words, slop)
                    if len(at):
                        docs = np.searchsorted(starts, np.maximum(at, 0), "right") - 1
                        np.add.at(edges, np.maximum(at, starts[docs]), 1)
                        np.add.at(edges, np.minimum(at + len(words), starts[docs + 1]), -1)
                        for d in np.unique(docs).tolist():
                            items[d].update(owners)
                hit = np.cumsum(edges[:total]) > 0
                upto = np.concatenate([[0], np.cumsum(hit)])
                n_hit = (upto[starts[1:]] - upto[starts[:-1]]).tolist()
                spans = []
                for d, n in enumerate(n_hit):
                    if n:
                        own = np.concatenate([[0], hit[starts[d] : starts[d + 1]].view(np.int8), [0]])
                        turns = np.flatnonzero(np.diff(own)).tolist()
                        spans.append([{"start": a, "end": b} for a, b in zip(turns[::2], turns[1::2], strict=True)])
                    else:
                        spans.append([])
                n = len(ids)
                columns = [[number] * n, range(n), ids, np.diff(starts).tolist(), n_hit, [sorted(items.get(d, ())) for d in range(n)], spans]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out_schema, strict=True)], schema=out_schema)
        rest()

    return index.mapInArrow(look, schema)


def phrase_slices(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> Iterator[list]:
    """The benchmark's distinct windows with their items, in slices of bounded size (one slice for any usual size)."""
    src = only(items, id_col, text_col).toDF("id", "text").where("id IS NOT NULL AND text IS NOT NULL")
    total = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // SLICE_BYTES) or 1
    for k in range(n):
        owners = defaultdict(set)
        part = src.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k)
        for item_id, text in part.toLocalIterator():
            for w in windows(text, window):
                owners[w].add(item_id)
        yield [(w, tuple(sorted(o))) for w, o in sorted(owners.items())]


def decontaminate(docs: DataFrame, items: DataFrame, slop: int = 0, window: int = WINDOW, block_tokens: int = BLOCK_TOKENS,
                  id_col: str = "doc_id") -> DataFrame:
    """Index the documents, store the index in the shared folder and search every benchmark window.
    The result's ``doc_id`` is the documents' ``id_col``."""
    index = stored(build_index(docs, id_col, block_tokens=block_tokens), "postings", **WIDE_ROWS)
    item_type = items.schema["item_id"].dataType
    slices = list(phrase_slices(items, window=window))
    if len(slices) == 1:
        return search(index, slices[0], item_type, slop)
    return merge_slices([search(index, s, item_type, slop) for s in slices])


def merge_slices(parts: list[DataFrame]) -> DataFrame:
    """The results of several slices of phrases as one: rows of a document meet by their place in the index."""
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    both = both.groupBy("block", "place").agg(
        F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"),
    )
    n_hit = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], a["upto"]))).alias("n"),
            F.greatest(a["upto"], s["end"]).alias("upto"),
        ),
        lambda a: a["n"],
    )
    return both.select("block", "place", "doc_id", "n_words", n_hit.alias("n_hit"), F.sort_array("items").alias("items"), "spans")
