"""Byte-level BPE by prefix dynamic programming.

For every prefix of a byte string the BPE encoding ends in exactly one token, and cutting that token off leaves the
encoding of a shorter prefix.  So one token per prefix is a complete table of all prefix encodings: ``last[i]`` is the
only token t ending at i for which the prefix before t is empty or ends in a token u such that (u, t) is *stable*, that
is, BPE of the bytes of u and t joined gives u, t again.  The table gives exact appends (go on from the last entry) and
re-encoding near an edit (keep the entries before it, recompute until they agree with the old ones again).

A text is first split by the tokenizer's pattern and each piece encoded on its own; a piece that is itself a token is
that token, as in the public library.

Edge cases: null and empty texts have no ids and decode to nothing; repeated rows are encoded alike; an empty table
gives no rows; extra columns are ignored; a piece of any length takes time linear in it.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import only, rest, ship

#: Bytes that the caches of pieces and of pairs may take in a worker, about 200 an entry; each is emptied when full, the
#: pieces also when their task ends, which costs time and changes nothing.
PIECES_BYTES, PAIRS_BYTES, ENTRY_BYTES = 64 << 20, 48 << 20, 200
#: Characters of texts whose new pieces are encoded together.
RUN_CHARS = 1 << 20
_NONE = 1 << 40


class Vocabulary:
    """Ranks of a tiktoken-style file: merge priority and id are the same number."""

    def __init__(self, data: bytes):
        pairs = (line.split() for line in data.splitlines() if line.strip())
        self.ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        self.bytes = {i: b for b, i in self.ranks.items()}
        self.longest = max(map(len, self.ranks))
        self._stable: dict[int, bool] = {}
        self._parts: dict[int, tuple[int, int] | None] = {}
        self._edges: dict[tuple[int, int], list[tuple[int, bytes]] | None] = {}
        # finds, for every byte, the tokens that end there, the longest first; tokens that merging never makes stay out
        self.automaton = ahocorasick.Automaton()
        for b, t in self.ranks.items():
            if self.reached(t):
                self.automaton.add_word(b.decode("latin-1"), (len(b), t))
        self.automaton.make_automaton()

    def merge(self, data: bytes, until: int = 1) -> list[int]:
        """Plain BPE for short strings: join the neighbours of lowest rank, leftmost first, down to ``until`` parts."""
        parts = [data[i : i + 1] for i in range(len(data))]
        ranks = [self.ranks.get(a + b, _NONE) for a, b in zip(parts, parts[1:], strict=False)]
        while len(parts) > until:
            low = min(ranks)
            if low == _NONE:
                break
            i = ranks.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            ranks[max(0, i - 1) : i + 2] = [
                self.ranks.get(parts[k] + parts[k + 1], _NONE) for k in (i - 1, i) if 0 <= k < len(parts) - 1
            ]
        return [self.ranks[p] for p in parts]

    def parts(self, token: int) -> tuple[int, int] | None:
        """The two tokens that merging a token's bytes joins last; None if merging never makes the token."""
        if token not in self._parts:
            two = self.merge(self.bytes[token], 2)
            whole = len(two) == 2 and self.bytes[two[0]] + self.bytes[two[1]] in self.ranks
            self._parts[token] = tuple(two) if whole else None
        return self._parts[token]

    def reached(self, token: int) -> bool:
        return len(self.bytes[token]) == 1 or self.parts(token) is not None

    def edge(self, token: int, side: int) -> list[tuple[int, bytes]] | None:
        """The tokens that stand at one edge (0 left, 1 right) while the token is merged, in order of time.
        None if ranks don't rise along it, so that ranks don't tell the time."""
        key = (token, side)
        if key not in self._edges:
            chain, t = [token], token
            while len(self.bytes[t]) > 1 and self.parts(t):
                t = self.parts(t)[side]
                chain.append(t)
            chain.reverse()
            inner = [x for t in chain[1:] for x in self.parts(t)]
            rises = all(a < b for a, b in zip(chain[1:], chain[2:], strict=False)) and all(
                len(self.bytes[x]) == 1 or x < t for t in chain[1:] for x in self.parts(t)
            )
            self._edges[key] = [(t, self.bytes[t]) for t in chain] if rises or not inner else None
        return self._edges[key]

    def stable(self, left: int, right: int) -> bool:
        key = left << 32 | right
        found = self._stable.get(key)
        if found is None:
            if len(self._stable) * ENTRY_BYTES > PAIRS_BYTES:
                self._stable.clear()
            found = self._stable[key] = self._is_stable(left, right)
        return found

    def _is_stable(self, left: int, right: int) -> bool:
        """Whether no merge ever crosses the boundary: go through the pairs of edge tokens that meet there in time."""
        ls, rs = self.edge(left, 1), self.edge(right, 0)
        if ls is None or rs is None:
            return self.merge(self.bytes[left] + self.bytes[right]) == [left, right]
        i = j = 0
        while True:
            next_l = ls[i + 1][0] if i + 1 < len(ls) else _NONE
            next_r = rs[j + 1][0] if j + 1 < len(rs) else _NONE
            cross = self.ranks.get(ls[i][1] + rs[j][1], _NONE)
            # of equal ranks the leftmost goes first: the left token's own merge, then the crossing one
            if cross < next_l and cross <= next_r and cross != _NONE:
                return False
            if next_l == next_r == _NONE:
                return True
            if next_l <= next_r:
                i += 1
            else:
                j += 1


class Prefixes:
    """The last token of every prefix of a byte string; ``last[0]`` stands for the empty prefix."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.v, self.data, self.last = vocabulary, b"", [-1]
        self.append(data)

    def _fill(self, first: int, old: list[int] | None = None, shift: int = 0, edited: int = 0) -> int:
        """Add the last tokens of the prefixes of more than ``first`` bytes; returns how many bytes have theirs.  With an
        ``old`` table, ``shift`` entries off, it stops as soon as that says the same for all that follows."""
        last, longest, known, stable = self.last, self.v.longest, self.v._stable.get, self.v.stable
        at = max(0, first + 1 - longest)
        upto, same = first, 0
        for end, (size, t) in self.v.automaton.iter(self.data[at:].decode("latin-1")):
            end += at + 1
            if end <= upto:
                continue
            if end > upto + 1:
                break
            left = last[end - size]  # -1 for the empty prefix
            if left >= 0:
                fits = known(left << 32 | t)
                if fits is None:
                    fits = stable(left, t)
                if not fits:
                    continue
            upto = end
            last.append(t)
            if old is not None:
                # entries depend on the last `longest` bytes and entries: once so many agree, all later ones do
                same = same + 1 if end > edited and old[end - shift] == t else 0
                if same >= longest:
                    return upto
        if upto < len(self.data):
            raise ValueError("the vocabulary lacks a byte")
        return upto

    def append(self, more: bytes) -> Prefixes:
        first = len(self.data)
        self.data += more
        self._fill(first)
        return self

    def become(self, data: bytes) -> Prefixes:
        """Another byte string; the entries of what both begin with are kept."""
        same = 0
        for a, b in zip(self.data, data, strict=False):
            if a != b:
                break
            same += 1
        del self.last[same + 1 :]
        self.data = data[:same]
        return self.append(data[same:])

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Replace data[start:end]; returns how many entries were computed anew."""
        old, shift = self.last, len(new) - (end - start)
        self.data = self.data[:start] + new + self.data[end:]
        self.last = old[: start + 1]
        upto = self._fill(start, old, shift, start + len(new))
        self.last += old[upto - shift + 1 :]
        return upto - start

    def ids(self) -> list[int]:
        out, i = [], len(self.data)
        while i:
            out.append(self.last[i])
            i -= len(self.v.bytes[self.last[i]])
        return out[::-1]


class Encoder(dict):
    """Little-endian unsigned 32-bit ids of texts; as a mapping, the cached ids of pieces."""

    def __init__(self, data: bytes, pattern: str):
        super().__init__()
        self.v, self.split = Vocabulary(data), regex.compile(pattern).findall
        self.used = 0

    def learn(self, pieces: list[str]) -> None:
        """Cache the ids of new pieces, in order, so that one's table goes on where it parts from the last one's."""
        table, rank = Prefixes(self.v), self.v.ranks.get
        for piece in sorted(pieces):
            raw = piece.encode()
            whole = rank(raw)
            ids = [whole] if whole is not None else table.become(raw).ids()
            self[piece] = packed = struct.pack(f"<{len(ids)}I", *ids)
            self.used += ENTRY_BYTES + len(raw) + len(packed)

    def forget(self) -> None:
        self.clear()
        self.used = 0

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text; new pieces are gathered over runs of texts of about RUN_CHARS."""
        out, run, size = [], [], 0
        for i, text in enumerate(texts):
            run.append(self.split(text) if text else [])
            size += len(text or "")
            if size >= RUN_CHARS or i + 1 == len(texts):
                self.learn([p for p in set().union(*run) if p not in self])
                out += [b"".join(map(self.__getitem__, pieces)) for pieces in run]
                run, size = [], 0
                if self.used > PIECES_BYTES:
                    self.forget()
        return out

    def decode(self, packed: bytes | None) -> bytes:
        table = self.v.bytes
        return b"".join([table[i] for i in np.frombuffer(packed or b"", "<u4").tolist()])


@lru_cache(maxsize=2)
def encoder(data: bytes, pattern: str) -> Encoder:
    """One encoder per worker process, so that the vocabulary is read once."""
    return Encoder(data, pattern)


def _ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens and ``ids`` (packed little-endian unsigned 32-bit integers) of every row."""
    src = only(docs, id_col, text_col).toDF("id", "text")
    schema = T.StructType([
        T.StructField(id_col, src.schema["id"].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()),
    ])
    ship(src.sparkSession)
    sent = src.sparkSession.sparkContext.broadcast(_ranks(ranks_path))  # the vocabulary file: under 1 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(sent.value, pattern)
        try:
            for batch in batches:
                for part in _parts(batch):
                    ids = e.encode_all(part.column(1).to_pylist())
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())], names=schema.names)
        finally:  # an idle worker keeps the vocabulary and the pairs alone
            e.forget()
            rest()

    return src.mapInArrow(run, schema)


def _parts(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """A batch in small runs of rows, so that results of long texts are sent on early."""
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """The columns of ``encode`` plus ``decoded``: the bytes of the ids."""
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())])
    sent = encoded.sparkSession.sparkContext.broadcast(_ranks(ranks_path))
    at = encoded.columns.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(sent.value, pattern)
        for batch in batches:
            for part in _parts(batch):
                out = [e.decode(x.as_py()) for x in part.column(at)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary())], names=schema.names)

    return encoded.mapInArrow(run, schema)
