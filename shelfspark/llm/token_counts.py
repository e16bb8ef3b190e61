"""Token counts without tokens: count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton finds every vocabulary piece that ends at a character, the longest first.  Dynamic programming
keeps, for each prefix of the text, the best score of a segmentation and the number of its pieces; no path is stored.

Tie rules are those of the public unigram encoders: a piece that starts earlier wins, a later start must score strictly
more; a character that is no piece by itself may also be an unknown one, which scores 10 less than the worst piece and
is tried last.  An unknown character counts as its UTF-8 bytes if the vocabulary has byte pieces; if not, a run of
unknown characters counts as one.  Scores are whole multiples of 2^-32 (exact for float scores of 2^-9 or more), so that
sums never round and a text may be cut wherever no piece can cross.  The encoders that add up in double precision do
the same while their sums are exact; those that add up in single precision round, and may differ on long texts.

A text has its spaces written as U+2581 and one put before it.  It is cut before each run of that mark, if no piece
holds the mark after another character, and at line breaks, if they are in no piece and count as bytes.  Counts of
short chunks are cached in the worker; the cache is emptied when full, which changes nothing.

Edge cases: null and empty texts have no tokens; texts of any length, also without a space, take time linear in it and
memory for the longest piece alone; repeated rows are counted alike; an empty table gives no rows; extra columns are
ignored.  Symbols that a user added to a vocabulary, and normalization other than that of spaces, are not supported.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .bpe import _parts, _ranks
from .common import only, ship

MARK = "▁"
UNKNOWN_PENALTY = 10
UNIT = 1 << 32
#: Chunks kept per worker, and the longest that is kept, in characters.
CACHE_CHUNKS, CACHE_CHARS = 400_000, 64
#: Prefixes kept before old ones are let go.
WINDOW = 4096


class Unigram(dict):
    """Piece counts by Viterbi; as a mapping, the cached counts of chunks."""

    def __init__(self, scores: dict[str, float], least: float, byte_pieces: bool):
        """``scores`` of the pieces; ``least`` is the lowest score that the unknown penalty goes from."""
        super().__init__()
        self.longest, self.bytes = max(map(len, scores), default=1), byte_pieces
        self.single = {p for p in scores if len(p) == 1}
        self.unknown = int((least - UNKNOWN_PENALTY) * UNIT)
        self.automaton = ahocorasick.Automaton()
        for p, score in scores.items():
            self.automaton.add_word(p, (len(p), int(score * UNIT)))
        self.automaton.make_automaton()
        marked = (byte_pieces or MARK in self.single) and not any(MARK in p.lstrip(MARK) for p in scores)
        lines = byte_pieces and not any("\n" in p for p in scores)
        if marked:
            self.cut = re.compile(f"{MARK}+[^{MARK}\n]*|\n|[^{MARK}\n]+" if lines else f"{MARK}+[^{MARK}]*|[^{MARK}]+").findall
        else:
            self.cut = re.compile("[^\n]+|\n").findall if lines else lambda text: [text]

    def viterbi(self, text: str) -> int:
        """Pieces of the best segmentation of a text that is already marked."""
        if not text:
            return 0
        matches = self.automaton.iter(text) if len(self.automaton) else iter(())
        match = next(matches, None)
        # of the prefixes so far, the newest last: best score, pieces, and whether the last piece is unknown
        best, count, loose = [0], [0], [False]
        for end, char in enumerate(text):
            top = None
            while match is not None and match[0] == end:
                size, score = match[1]
                if top is None or best[-size] + score > top:
                    top, pieces, odd = best[-size] + score, count[-size] + 1, False
                match = next(matches, None)
            if char not in self.single and (top is None or best[-1] + self.unknown > top):
                top, odd = best[-1] + self.unknown, True
                pieces = count[-1] + (len(char.encode()) if self.bytes else not loose[-1])
            best.append(top)
            count.append(pieces)
            loose.append(odd)
            if len(best) > WINDOW + self.longest:
                del best[: -self.longest], count[: -self.longest], loose[: -self.longest]
        return count[-1]

    def __missing__(self, chunk: str) -> int:
        n = self.viterbi(chunk)
        if len(chunk) <= CACHE_CHARS:
            if len(self) >= CACHE_CHUNKS:
                self.clear()
            self[chunk] = n
        return n

    def count(self, text: str | None) -> int:
        return sum(map(self.__getitem__, self.cut(MARK + text.replace(" ", MARK)))) if text else 0


@lru_cache(maxsize=2)
def from_model(data: bytes) -> Unigram:
    """The pieces and scores of a sentencepiece file; one per worker process, so that its cache lasts over tasks."""
    model = sentencepiece.SentencePieceProcessor(model_proto=data)
    ids = range(model.get_piece_size())
    plain = [i for i in ids if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i))]
    scores = {model.id_to_piece(i): model.get_score(i) for i in plain}
    unused = {model.id_to_piece(i) for i in plain if model.is_unused(i)}
    used = {p: s for p, s in scores.items() if p not in unused}
    return Unigram(used, min(used.values(), default=0.0), any(map(model.is_byte, ids)))


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``n_chars`` (code points) and ``n_tokens`` of every row's whole text."""
    src = only(docs, id_col, text_col).toDF("id", "text")
    schema = T.StructType([
        T.StructField(id_col, src.schema["id"].dataType), T.StructField("n_chars", T.LongType()), T.StructField("n_tokens", T.LongType()),
    ])
    ship(src.sparkSession)
    sent = src.sparkSession.sparkContext.broadcast(_ranks(model_path))  # the vocabulary file: under 1 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = from_model(sent.value)
        for batch in batches:
            for part in _parts(batch):
                texts = part.column(1).to_pylist()
                sizes = pa.array([len(t or "") for t in texts], pa.int64())
                counts = pa.array([counter.count(t) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), sizes, counts], names=schema.names)

    return src.mapInArrow(run, schema)
