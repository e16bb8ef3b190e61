"""Fill-in-middle transformation over an indexable skip list.

A text is a row of *units*: code points, or the matches of a pattern, where every stretch between matches is a unit of
its own.  Its skip list has the units as the bottom lane and express lanes above, of which a node spans ``FAN`` nodes of
the lane below.  Every node carries two widths: how many units and how many code points it spans.  To reach a unit of
given rank one goes along the top lane while its unit widths fit, one lane down, and so on; the code-point widths added
up on the way are the place of the cut.  So a cut takes a few dozen steps in a text of any length, and both cuts are
exact whatever the units are.

The cuts, the form and the order come from the SHA-256 of ``<salt>:<id>`` alone (``draws``), never from the layout of
the table: the same document is always cut alike.

Edge cases: a null text counts as empty; an empty text, and one that holds a sentinel, has the form ``plain`` and is its
own output, with null widths; a null id draws from ``<salt>:``; repeated rows are cut alike, each is returned; texts of
any length take time and memory linear in them; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import _parts
from .common import only, ship

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Percent of the texts that stay plain besides those that must, and of the others those with the suffix first.
PLAIN_PERCENT, SPM_PERCENT = 10, 20
#: Nodes of a lane that one node of the lane above spans.
FAN = 32


class SkipList:
    """Lanes of (unit widths, code-point widths), the bottom one first."""

    def __init__(self, points: np.ndarray):
        """``points``: code points of each unit."""
        units = np.broadcast_to(np.int64(1), len(points))
        self.lanes = [(units, points)]
        while len(units) > FAN:
            heads = np.arange(0, len(units), FAN)
            units, points = np.add.reduceat(units, heads), np.add.reduceat(points, heads)
            self.lanes.append((units, points))
        self.units = int(units.sum())

    def point(self, rank: int) -> int:
        """The number of code points before unit ``rank``; all of them for the number of units."""
        left, at, node = rank, 0, 0
        for units, points in reversed(self.lanes):
            last = len(units)
            while node < last and units[node] <= left:
                left -= int(units[node])
                at += int(points[node])
                node += 1
            node *= FAN
        return at


def unit_widths(text: str, pattern: regex.Pattern | None = None) -> np.ndarray:
    """Code points of each unit of the text; without a pattern every code point is a unit."""
    if pattern is None:
        return np.broadcast_to(np.int64(1), len(text))
    ends, upto = [], 0
    for m in pattern.finditer(text):
        if m.end() > m.start():
            if m.start() > upto:
                ends.append(m.start())
            ends.append(upto := m.end())
    if upto < len(text):
        ends.append(len(text))
    return np.diff(np.array(ends, np.int64), prepend=0)


def draws(key: str) -> tuple[int, int, int, int]:
    """Four 32-bit numbers: the first four groups of 8 hex digits of the key's SHA-256."""
    return struct.unpack(">4I", hashlib.sha256(key.encode()).digest()[:16])


def cut(text: str, key: str, pattern: regex.Pattern | None = None) -> tuple[int, str, int | None, int | None, str]:
    """units, form, code points of prefix and middle, output."""
    lanes = SkipList(unit_widths(text, pattern))
    h1, h2, h3, h4 = draws(key)
    n = lanes.units
    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or h3 % 100 >= 100 - PLAIN_PERCENT:
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = lanes.point(low), lanes.point(high)
    if h4 % 100 < SPM_PERCENT:
        return n, "spm", a, b - a, "".join((SUFFIX, text[b:], PREFIX, text[:a], MIDDLE, text[a:b]))
    return n, "psm", a, b - a, "".join((PREFIX, text[:a], SUFFIX, text[b:], MIDDLE, text[a:b]))


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pattern: str | None = None, salt: str = "1") -> DataFrame:
    """id, ``n`` (units), ``form`` (plain, psm or spm), ``prefix_chars``, ``middle_chars`` and ``output`` of every row."""
    src = only(docs, id_col, text_col).toDF("id", "text")
    src = src.select("id", F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).alias("key"), "text")
    fields = [("n", T.LongType()), ("form", T.StringType()), ("prefix_chars", T.LongType()), ("middle_chars", T.LongType()), ("output", T.StringType())]
    schema = T.StructType([T.StructField(id_col, src.schema["id"].dataType), *[T.StructField(*f) for f in fields]])
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    ship(src.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = regex.compile(pattern) if pattern is not None else None
        for batch in batches:
            for part in _parts(batch):
                rows = [cut(t.as_py() or "", k.as_py(), units) for k, t in zip(part.column(1), part.column(2), strict=True)]
                columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=schema.names)

    return src.mapInArrow(run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of: the parts between the sentinels, which no text of these forms holds."""
    rest = F.substring(output, len(PREFIX) + 1, 2_147_483_647)
    middle = F.substring_index(rest, MIDDLE, -1)
    ends = F.substring_index(rest, MIDDLE, 1)
    psm = F.concat(F.substring_index(ends, SUFFIX, 1), middle, F.substring_index(ends, SUFFIX, -1))
    spm = F.concat(F.substring_index(ends, PREFIX, -1), middle, F.substring_index(ends, PREFIX, 1))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
