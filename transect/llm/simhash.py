"""SimHash near-duplicates by a self-join of binary tries.

Fingerprints are 64 majority bits over the XXH64 values (seed 42) of word shingles. Two documents are linked when
their fingerprints differ in at most `budget` bits; classes are the connected components of these links.

The join is exact. Equal fingerprints collapse first. The trie is laid out in several bit orders, each with some blocks
of bits on top; by the pigeonhole principle every pair within the budget agrees on all top bits in at least one order,
so those levels are walked with no error allowance and each subtree below is one unit of distributed work. Below, node
pairs are traversed together, differing bits are accumulated, and a pair of nodes is dropped once its bits exceed the
budget. A subtree with more than `hot` fingerprints is split again into pairs of its own children, so that no task gets
an unbounded one. A task returns a spanning forest of the links it found (never all pairs), which loses no connection.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transect.llm.common import arrow_map, as_bytes, columns_of, spread, stored, whole_rows, workspace

BITS = 64
#: Subtree bits by which a hot subtree is split.
SPLIT_BITS = 8
#: Node pairs of at most so many leaf pairs are compared directly.
LEAF_PAIRS = 64
#: Node pairs advanced at once: bounds a worker's memory.
CHUNK = 60_000
#: Rows of a task of the join, about.
TASK_ROWS = 500_000


def fingerprint(text: bytes | None, width: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of a text: a bit is 1 if set in over half of the shingle hashes. No words: 0."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= width:
        return digest(joined, seed)
    ends = list(accumulate(len(w) + 1 for w in words))
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip([0, *ends], (e - 1 for e in ends[width - 1 :]), strict=False)], np.uint64)
    n = len(hashes)
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    whole = n // 255 * 255
    ones = bits[:whole].reshape(-1, 255, BITS).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64) + bits[whole:].sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(id_col, fp bigint): the SimHash of each row's whole text, as a signed 64-bit pattern. A null or empty text has fingerprint 0; repeated rows and null ids keep their row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, width) for t in as_bytes(b.column(1))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], names=[id_col, "fp"])

    few = docs.select(id_col, F.col(text_col).alias("text"))
    return arrow_map(few, work, f"`{id_col}` {few.schema[0].dataType.simpleString()}, fp bigint")


def _unite(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels (least member of each class, fully compressed) after joining i[k] with j[k]."""
    while len(i):
        a, b = labels[i], labels[j]
        differ = a != b
        if not differ.any():
            break
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(labels, up := labels[labels]):
            labels = up
    return labels


def trie_forest(keys: np.ndarray, roots: np.ndarray, budget: int = 3) -> np.ndarray:
    """Class labels of `keys` (sorted uint64, distinct within a root's ranges) under links of at most `budget` differing bits.

    roots: rows (a_low, a_high, b_low, b_high) of index ranges, the node pairs to start from; a range paired with itself is a self-join.
    """
    labels = np.arange(len(keys))
    work = [(BITS - 1, np.hstack([roots, np.zeros((len(roots), 1), np.int64)]))]
    ones: dict[int, np.ndarray] = {}
    while work:
        bit, pairs = work.pop()
        if len(pairs) > CHUNK:
            work += [(bit, pairs[k : k + CHUNK]) for k in range(0, len(pairs), CHUNK)]
            continue
        a0, a1, b0, b1, diff = pairs.T
        small = ((a1 - a0) * (b1 - b0) <= LEAF_PAIRS) | (bit < 0)
        if small.any():
            a, na, b, nb = a0[small], (a1 - a0)[small], b0[small], (b1 - b0)[small]
            count = na * nb
            within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            nb, same = np.repeat(nb, count), np.repeat(a == b, count)
            i, j = np.repeat(a, count) + within // nb, np.repeat(b, count) + within % nb
            near = (np.bitwise_count(keys[i] ^ keys[j]) <= budget) & (~same | (i < j))
            labels = _unite(labels, i[near], j[near])
            a0, a1, b0, b1, diff = pairs[~small].T
        if not len(a0):
            continue
        if bit not in ones:
            ones[bit] = np.concatenate([[0], np.cumsum((keys >> np.uint64(bit)) & np.uint64(1)).astype(np.int64)])
        up = ones[bit]
        am, bm, itself = a1 - (up[a1] - up[a0]), b1 - (up[b1] - up[b0]), a0 == b0
        after = np.concatenate([
            np.stack([a0, am, b0, bm, diff], 1),
            np.stack([am, a1, bm, b1, diff], 1),
            np.stack([a0, am, bm, b1, diff + 1], 1),
            np.stack([am, a1, b0, bm, diff + 1], 1)[~itself],
        ])
        after = after[(after[:, 1] > after[:, 0]) & (after[:, 3] > after[:, 2]) & (after[:, 4] <= budget)]
        if len(after):
            work.append((bit - 1, after))
    return labels


def _plan(n: int, budget: int) -> tuple[list[tuple[int, int]], int]:
    """Blocks (shift, width) of the 64 bits, and how many of them come on top in a bit order: more, the more fingerprints there are, so that subtrees stay small."""
    top = 1 if n < 1 << 24 else 2 if n < 1 << 30 else 3
    blocks = budget + top
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)], top


def links(distinct: DataFrame, n: int, budget: int = 3, hot: int = 20_000) -> DataFrame:
    """(a, b) bigint: a spanning forest, for each subtree, of the links between the distinct fingerprints in column fp. n: their number, by which the layout is chosen; the links are the same with any."""
    blocks, top = _plan(n, budget)
    tops = []
    for k, on_top in enumerate(combinations(range(len(blocks)), top)):
        value = F.lit(0).cast("bigint")
        for s, w in (blocks[x] for x in on_top):
            value = F.shiftleft(value, w).bitwiseOR(F.shiftrightunsigned("fp", s).bitwiseAND(F.lit((1 << w) - 1)))
        s, w = blocks[max(set(range(len(blocks))) - set(on_top))]
        child = F.shiftrightunsigned("fp", s + w - SPLIT_BITS).bitwiseAND(F.lit((1 << SPLIT_BITS) - 1)).cast("int")
        tops.append(F.struct(F.lit(k).alias("order"), value.alias("value"), child.alias("child")))
    rows = distinct.select("fp", F.inline(F.array(*tops)))
    sizes = rows.groupBy("order", "value").count().filter(F.col("count") > 1)
    at = workspace(distinct.sparkSession, "trie")
    crowded = stored(sizes.filter(F.col("count") > hot).select("order", "value"), at)
    one, parts = F.lit(-1), None
    if crowded.isEmpty():
        parts = rows.select("order", "value", one.alias("low"), one.alias("high"), "child", "fp")
    else:
        calm = rows.join(crowded, ["order", "value"], "left_anti").select("order", "value", one.alias("low"), one.alias("high"), "child", "fp")
        masks = F.array(*[F.lit(m) for m in range(1 << SPLIT_BITS) if m.bit_count() <= budget])
        split = rows.join(crowded, ["order", "value"]).withColumn("mask", F.explode(masks)).withColumn("other", F.col("child").bitwiseXOR(F.col("mask")))
        parts = calm.unionByName(split.select("order", "value", F.least("child", "other").alias("low"), F.greatest("child", "other").alias("high"), "child", "fp"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        order, value, low, high, child, fp = (np.concatenate([np.asarray(b.column(k)) for b in got]) for k in range(6))
        keys = fp.view(np.uint64)
        at = np.lexsort((keys, high, low, value, order))
        order, value, low, high, child, keys = (x[at] for x in (order, value, low, high, child, keys))
        new = np.ones(len(keys), bool)
        new[1:] = (order[1:] != order[:-1]) | (value[1:] != value[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
        start = np.flatnonzero(new)
        end = np.append(start[1:], len(keys))
        alone = low[start] == high[start]
        roots = [np.stack([start, end, start, end], 1)[alone & (end - start > 1)]]
        if not alone.all():
            first = np.concatenate([[0], np.cumsum(child == low)])
            s, e = start[~alone], end[~alone]
            mid = s + first[e] - first[s]
            roots.append(np.stack([s, mid, mid, e], 1)[(mid > s) & (e > mid)])
        labels = trie_forest(keys, np.concatenate(roots).astype(np.int64), budget)
        moved = labels != np.arange(len(keys))
        a, b = keys[moved].view(np.int64), keys[labels[moved]].view(np.int64)
        for k in range(0, len(a), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(a[k : k + (1 << 16)]), pa.array(b[k : k + (1 << 16)])], names=["a", "b"])

    tasks = max(spread(distinct.sparkSession), -(-distinct.count() * len(tops) // TASK_ROWS))
    return arrow_map(parts.repartition(tasks, "order", "value", "low", "high"), work, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): each node of the links (a, b) with the least node of its component, by alternating large and small stars.

    Each round is written to the shared folder; minima are aggregated before the shuffle, so a node with very many links is no burden.
    """
    at, k, before = workspace(edges.sparkSession, "stars"), 0, None
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), f"{at}/0")
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = stored(large, f"{at}/{k}-large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b <> m").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        k += 1
        now = stored(small.distinct(), f"{at}/{k}")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, budget: int = 3) -> DataFrame:
    """(id_col, fp, component_id): one row for each row of docs with the smallest id reachable over links, its own included.

    Null ids keep their row and never become a component's id unless it has no other (then it is null). Null and empty
    texts share fingerprint 0. Repeated rows appear again. An empty table gives an empty one. Other columns of docs are
    not read, so their names don't matter.
    """
    at = workspace(docs.sparkSession, "simhash")
    prints = stored(fingerprints(docs, id_col, text_col, width), f"{at}/prints")
    distinct = stored(prints.groupBy("fp").agg(F.min(id_col).alias("least")), f"{at}/distinct")
    stars = components(links(distinct, distinct.count(), budget))
    members = stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct()).join(distinct, F.col("node") == F.col("fp"))
    least = members.groupBy("root").agg(F.min("least").alias("component"))
    joined = members.select(F.col("fp"), "root").join(least, "root").select("fp", "component")
    # Written first, so that the join below has plain shuffles on both sides, which Spark splits where one fingerprint has very many rows.
    of_print = stored(distinct.join(joined, "fp", "left").select("fp", F.coalesce("component", "least").alias("component_id")), f"{at}/labels")
    return prints.join(of_print, "fp", "left").select(id_col, "fp", "component_id")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, budget: int = 3) -> DataFrame:
    """The rows of docs, with their columns, that stand for their component: of each component one row, that of the least id, whatever the ids are.

    Rows are told apart by id and hash of the text, so an id on rows of different components stands for each of them. Among
    rows of the least id the least hash decides; of rows that share both one stays. A null id comes after all others.
    """
    key = lambda id, text: F.struct(id.isNull().alias("none"), id.alias("id"), F.xxhash64(text).alias("h")).alias("key")
    keyed = docs.select(key(F.col(id_col), F.col(text_col)), F.col(text_col).alias("text"))
    found = stored(near_duplicates(keyed, "key", "text", width, budget), workspace(docs.sparkSession, "dedup"))
    gone = found.filter("key <> component_id").select("key").distinct()
    kept = whole_rows(docs).select("row", key(F.col(f"row.`{id_col}`"), F.col(f"row.`{text_col}`"))).join(gone, "key", "left_anti").select("row", "key")
    again = found.filter("key = component_id").groupBy("key").count().filter("count > 1").select("key")
    if not again.isEmpty():
        kept = kept.join(again, "key", "left_anti").unionByName(kept.join(again, "key", "left_semi").dropDuplicates(["key"]))
    return columns_of(kept, docs.columns)
