"""N-gram Jaccard self-join with adaptive multi-match prefixes, and the components of its links.

A document's set are the distinct hashes (64 bits) of its shingles of ``words`` words (4 unless said otherwise).  Documents with equal sets are one *node*,
named by a hash of the set, so a group of copies is one node however large it is.

1. ``postings``: every node's shingles, dealt by shingle; a reducer sees all nodes of a shingle and so knows its exact
   document frequency.  Shingles of one node alone cannot be shared and stay behind; the rest goes back to its nodes.
2. ``prefixes``: shingles are ordered by (frequency, hash).  Two sets of Jaccard t or more share at least k shingles
   among the first n - ceil(t n) + k of either, for any k.  Each node picks its k by estimated cost: a longer prefix
   reads more list entries, but k matches instead of one leave fewer candidates to verify.
3. ``clusters``: nodes that share a shingle of their shortest prefixes (k = 1) are joined to the list's least node:
   as many links as list entries, never the pairs of a list.  Similar nodes always fall into one cluster.
4. ``verified``: tasks hold the nodes of whole clusters (of two blocks each, where a cluster is large), count the
   prefix shingles that pairs share, and verify pairs with min(k, k') or more by their exact overlap, unless the two are
   connected already.  Tasks return the links of a spanning forest, and the components of these are the result.

Edge cases: null and empty texts and texts without words have n_shingles 0 and are linked with nothing; fewer words
than a shingle has are one shingle; repeated rows and repeated ids each get a row; a null id takes its component's least id, null if there
is none; an empty table gives no rows; extra columns are ignored.  Ids are integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import only, rest, ship, stored
from .components import connected_components

WORDS = 4
PERCENT = 85
#: Cost of verifying a candidate in list entries read.
VERIFY_COST = 20
#: Nodes of a task: clusters up to this size stay whole, larger ones are dealt in pairs of blocks of this size.
BLOCK_NODES = 2000
#: Entries (node, shingle) that a task holds before it sends them on, and that it sorts at once.
BUFFER = 1 << 18
#: Entries of a bucket on average: the number of buckets grows with the corpus, so a group stays small.  Smaller buckets
#: would cut documents into so many runs that naming the node of each costs more than the entries.
BUCKET_ENTRIES = 1 << 22
#: Words whose hash a task keeps.
KNOWN_WORDS = 200_000


class _Words(dict):
    """Hash of each word; emptied when large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > KNOWN_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: str | None, known: _Words, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``words`` words of the text, A-Z lower-cased; fewer words are one run."""
    found = text.encode().lower().split() if text else []
    if not found:
        return np.empty(0, np.int64)
    code = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    size = min(words, len(found))
    h = np.full(len(found) - size + 1, size, np.uint64)
    for k in range(size):
        h = (h ^ code[k : k + len(h)]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    return np.unique(h.view(np.int64))


def node_of(tokens: np.ndarray) -> int | None:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())).view(np.int64))) if len(tokens) else None


def doc_nodes(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(id, text) -> id, node, n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Words()
        for batch in batches:
            sets = (shingles(t.as_py(), known, words) for t in batch.column(1))
            rows = [(node_of(s), len(s)) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64())], names=["id", "node", "n"]
            )

    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, node long, n long")


_CHUNK = "bucket int, nodes binary, sizes binary, counts binary, tokens binary"


def postings(docs: DataFrame, buckets: int, words: int = WORDS) -> DataFrame:
    """Chunks of (node, size, shingles) runs, one row per bucket of shingles; a task names each node once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen, held, size = _Words(), set(), [], 0

        def flush() -> pa.RecordBatch:
            token = np.concatenate([s for _, s in held])
            which = np.repeat(np.arange(len(held)), [len(s) for _, s in held])
            bucket = (token.view(np.uint64) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            token, which, bucket = token[order], which[order], bucket[order]
            names = np.array([n for n, _ in held], np.int64)
            sizes = np.array([len(s) for _, s in held], np.int32)
            rows = []
            for part in np.split(np.arange(len(token)), np.flatnonzero(np.diff(bucket)) + 1):
                run_ids, counts = np.unique(which[part], return_counts=True)
                rows.append((int(bucket[part[0]]), names[run_ids].tobytes(), sizes[run_ids].tobytes(), counts.astype(np.int32).tobytes(), token[part].tobytes()))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int32(), *[pa.binary()] * 4], strict=True)],
                names=["bucket", "nodes", "sizes", "counts", "tokens"],
            )

        for batch in batches:
            for text in batch.column(0):
                s = shingles(text.as_py(), known, words)
                if len(s) and (node := node_of(s)) not in seen:
                    seen.add(node)
                    held.append((node, s))
                    size += len(s)
                    if size >= BUFFER:
                        yield flush()
                        held, size = [], 0
        if held:
            yield flush()
        del known, seen, held
        rest()

    return docs.select("text").mapInArrow(run, _CHUNK)


def _joined(batches: Iterator[pa.RecordBatch], **kinds: type) -> list[np.ndarray]:
    """The numbers of each binary column, those of all rows after one another."""
    parts: list[list[np.ndarray]] = [[] for _ in kinds]
    for batch in batches:
        for have, (name, kind) in zip(parts, kinds.items(), strict=True):
            column = batch.column(name)
            ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
            octets = np.frombuffer(column.buffers()[2], np.uint8) if len(column) and ends[-1] else np.empty(0, np.uint8)
            have.append(octets[ends[0] : ends[-1]].copy().view(kind))
    return [np.concatenate(have) if len(have) != 1 else have[0] for have in parts]


def _shares(numbers: np.ndarray) -> Iterator[np.ndarray]:
    """Where the numbers (hashes) of each share are; equal ones are in the same, of about BUFFER entries."""
    count = 1 << (len(numbers) // BUFFER).bit_length()
    share = (numbers >> 40 & count - 1).astype(np.int32)
    for s in range(count):
        yield np.flatnonzero(share == s)


def _cuts(sorted_numbers: np.ndarray) -> np.ndarray:
    """Where a new number begins."""
    return np.flatnonzero(np.concatenate([[True], sorted_numbers[1:] != sorted_numbers[:-1]]))


def shared_tokens(chunks: DataFrame, buckets: int) -> DataFrame:
    """Per bucket of nodes: the entries whose shingle another node has too, with its document frequency."""
    schema = "bucket int, nodes binary, sizes binary, dfs binary, tokens binary"

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, sizes, counts, tokens = _joined(batches, nodes=np.int64, sizes=np.int32, counts=np.int32, tokens=np.int64)
        owner = np.repeat(np.arange(len(nodes), dtype=np.int32), counts)
        for at in _shares(tokens):
            if not len(at):
                continue
            token, mine = tokens[at], owner[at]
            order = np.lexsort((nodes[mine], token))
            token, mine = token[order], mine[order]
            node = nodes[mine]
            fresh = np.ones(len(token), bool)  # the same node may come from several tasks
            fresh[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])
            token, mine, node = token[fresh], mine[fresh], node[fresh]
            df = np.diff(_cuts(token), append=len(token)).astype(np.int32)
            df = np.repeat(df, df)
            kept = np.flatnonzero(df > 1)
            to = (node[kept].view(np.uint64) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(to, kind="stable")
            kept, to = kept[order], to[order]
            if len(kept):
                rows = [
                    (int(to[a]), node[p].tobytes(), sizes[mine[p]].tobytes(), df[p].tobytes(), token[p].tobytes())
                    for a, p in zip(_cuts(to), np.split(kept, _cuts(to)[1:]), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int32(), *[pa.binary()] * 4], strict=True)],
                    names=["bucket", "nodes", "sizes", "dfs", "tokens"],
                )
        rest()

    return chunks.groupBy("bucket").applyInArrow(run, schema)


def choose_matches(df: np.ndarray, n: int, base: int, overlap: int) -> int:
    """The number of prefix matches to ask for.  ``df``: frequencies of the node's shared shingles, least first;
    ``base``: how many of them the shortest prefix holds; ``overlap``: the least overlap of a link."""
    if base <= 0:
        return 1
    upto = np.cumsum(df - 1)
    best, least = 1, None
    k = 1
    while k <= min(overlap, 64) and base + k - 1 <= len(df):
        entries = float(upto[base + k - 2])
        cost = entries + VERIFY_COST * entries / k  # at most entries / k nodes match k times
        if least is None or cost < least:
            best, least = k, cost
        k *= 2
    return best


def prefixes(shared: DataFrame, percent: int = PERCENT) -> DataFrame:
    """node, n, k, base (list of shingles of the shortest prefix), reach (shingles in the chosen prefix), tokens (all
    shared shingles, in order); only nodes that can have a link."""

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, sizes, dfs, tokens = _joined(batches, nodes=np.int64, sizes=np.int32, dfs=np.int32, tokens=np.int64)
        for at in _shares(nodes):
            if not len(at):
                continue
            at = at[np.lexsort((tokens[at], dfs[at], nodes[at]))]
            node, df, token = nodes[at], dfs[at], tokens[at]
            rows, starts = [], _cuts(node)
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(node)], strict=True):
                size, own = int(sizes[at[a]]), b - a
                overlap = -(-percent * size // 100)
                alone = size - own  # shingles that no other node has come first in the order
                base = size - overlap + 1 - alone
                if base > 0:
                    k = choose_matches(df[a:b], size, base, overlap)
                    rows.append((int(node[a]), size, k, token[a : a + base].tolist(), min(own, base + k - 1), token[a:b].tobytes()))
            if rows:
                kinds = [pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["node", "n", "k", "base", "reach", "tokens"]
                )
        rest()

    return shared.groupBy("bucket").applyInArrow(run, "node long, n int, k int, base array<long>, reach int, tokens binary")


def clusters(nodes: DataFrame) -> DataFrame:
    """node, cluster: nodes that share a shingle of their shortest prefixes, directly or over others."""
    entries = nodes.select("node", F.explode("base").alias("token"))
    heads = entries.groupBy("token").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("m")).where("m > 1").drop("m")
    links = entries.join(heads, "token").where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    return connected_components(links).withColumnRenamed("root", "cluster")


class _Lists:
    """Nodes by shingle."""

    def __init__(self, tokens: np.ndarray, owner: np.ndarray):
        self.ids, token_id = np.unique(tokens, return_inverse=True)
        order = np.argsort(token_id, kind="stable")
        self.owner = owner[order]
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(token_id, minlength=len(self.ids)))])

    def counts(self, tokens: np.ndarray, m: int) -> np.ndarray:
        """How many of the shingles each of the m nodes has."""
        at = np.searchsorted(self.ids, tokens)
        at = at[(at < len(self.ids)) & (self.ids[np.minimum(at, len(self.ids) - 1)] == tokens)]
        first, length = self.starts[at], self.starts[at + 1] - self.starts[at]
        spots = np.repeat(first - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(length.sum())
        return np.bincount(self.owner[spots], minlength=m)


def link(n: np.ndarray, k: np.ndarray, reach: np.ndarray, tokens: list[np.ndarray], side: np.ndarray | None = None, percent: int = PERCENT) -> list[tuple[int, int]]:
    """A spanning forest of the links among the nodes (of links between the two sides only, if given)."""
    m = len(n)
    every = np.arange(m)
    near = _Lists(np.concatenate([t[:r] for t, r in zip(tokens, reach, strict=True)]), np.repeat(every, reach))
    full = None
    root, out = every.copy(), []
    for x in range(1, m):
        matches = near.counts(tokens[x][: reach[x]], m)[:x]
        big, small = np.maximum(n[:x], n[x]), np.minimum(n[:x], n[x])
        fits = (matches >= np.minimum(k[:x], k[x])) & (100 * small >= percent * big) & (root[:x] != root[x])
        if side is not None:
            fits &= side[:x] != side[x]
        found = np.flatnonzero(fits)
        if not len(found):
            continue
        if full is None:
            full = _Lists(np.concatenate(tokens), np.repeat(every, [len(t) for t in tokens]))
        both = full.counts(tokens[x], m)[found]
        for y in found[100 * both >= percent * (n[found] + n[x] - both)].tolist():
            if root[y] != root[x]:
                root[root == root[x]] = root[y]
                out.append((x, y))
    return out


def verified(nodes: DataFrame, placed: DataFrame, block: int = BLOCK_NODES, percent: int = PERCENT) -> DataFrame:
    """a, b: links that connect exactly the nodes that the join's links connect."""
    sizes = placed.groupBy("cluster").agg(F.count(F.lit(1)).alias("m"))
    total = placed.count()
    blocks = F.ceil(F.col("m") / block).cast("int")
    rows = nodes.drop("base").join(placed, "node").join(sizes, "cluster").withColumn("blocks", blocks)
    # whole clusters share tasks of about a block; a large cluster's task is a pair of its blocks
    bins = max(1, -(-total // block))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    rows = rows.withColumn("own", F.when(F.col("blocks") > 1, own).otherwise(0))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(
        "node", "n", "k", "reach", "tokens", "own",
        F.when(F.col("blocks") > 1, F.col("cluster")).otherwise(F.pmod(F.xxhash64("cluster"), F.lit(bins))).alias("c"),
        (F.col("blocks") > 1).alias("large"), F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
    )

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        tokens = [np.frombuffer(t, np.int64) for t in pdf["tokens"]]
        cols = [pdf[c].to_numpy(np.int64) for c in ("n", "k", "reach")]
        side = pdf["own"].to_numpy() if pdf["lo"].iloc[0] != pdf["hi"].iloc[0] else None
        node = pdf["node"].to_numpy()
        pairs = link(*cols, tokens, side, percent)
        return pd.DataFrame([(node[x], node[y]) for x, y in pairs], columns=["a", "b"])

    return rows.groupBy("large", "c", "lo", "hi").applyInPandas(run, "a long, b long")


def join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, block: int = BLOCK_NODES, words: int = WORDS
) -> DataFrame:
    """id, n_shingles, component_id (the least id reachable by links) for every row."""
    src = only(docs, id_col, text_col).toDF("id", "text")
    spark = src.sparkSession
    ship(spark)
    members = stored(doc_nodes(src, words), "members")
    entries = members.agg(F.sum("n")).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-entries // BUCKET_ENTRIES))
    nodes = stored(prefixes(shared_tokens(postings(src, buckets, words), buckets), percent), "prefixes")
    roots = connected_components(verified(nodes, clusters(nodes), block, percent))
    least = members.where("node IS NOT NULL").groupBy("node").agg(F.min("id").alias("least"))
    rooted = least.join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    to = rooted.join(named, "root").select("node", "component_id")
    return members.join(to, "node", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id")
    )
