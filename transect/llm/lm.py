"""Interpolated modified Kneser-Ney bigram model, counted in Spark, kept as sorted hash arrays, mapped by the workers.

Training: each task counts the word pairs of its texts by array operations and sends them out as packed blocks, one for
each range of pair keys. The owner of a range merges its blocks, writes the sorted keys and counts as a file in the shared
folder, and sends on, by ranges of word hashes, what its pairs say about words: token counts, distinct left neighbours,
and how many followers were seen once, twice, and more often. A second round merges these into sorted word files. A frequent
word's pairs are spread over 256 places of the key space, so no range holds a third of the rows. Every pair and word counts;
nothing is pruned. There are as many ranges as the texts have RANGE_BYTES, so that a range's share, and with it a task's, stays
the same whatever the size of the table. The driver gets one row of totals for each range.

Scoring: a worker maps the files and looks up the sorted, distinct keys of some MB of texts at a time.

Words are A-Z lower-cased and split at ASCII white space; each text ends with one end token, which is a token like others.
Words are compared by 64-bit hash.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transect.llm.common import Filled, Opened, arrow_map, as_bytes, groups, put_file, workspace

#: Bytes that are no UTF-8 text, for the end of a text and for what stands before its first word.
END, START = b"\xff/", b"\xff"
#: Text counted or scored at once in a worker.
CHUNK_BYTES = 8 << 20
#: Bytes of text for which there is one range of keys; their pairs are merged in one worker, at most about so many at a time.
RANGE_BYTES, MERGE_PAIRS = 16 << 20, 1 << 20
WORD_COLUMNS = (("key", "<u8"), ("count", "<u8"), ("left", "<u4"), ("once", "<u4"), ("twice", "<u4"), ("more", "<u4"))


def _tokens(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Local ids of each token and of the one before it, starts of the texts, hash of each local id."""
    ids: dict[bytes, int] = defaultdict(count().__next__)
    start, end = ids[START], ids[END]
    split = [(t or b"").lower().split() for t in texts]
    sizes = np.array([len(w) + 1 for w in split])
    first = np.cumsum(sizes) - sizes
    token = np.full(sizes.sum(), end, np.int64)
    for at, words in zip(first.tolist(), split, strict=True):
        token[at : at + len(words)] = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
    before = np.empty_like(token)
    before[1:] = token[:-1]
    before[first] = start
    return token, before, first, np.fromiter(map(xxhash.xxh64_intdigest, ids), np.uint64, len(ids))


def pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """64-bit keys of pairs of word hashes. The top 16 bits, by which pairs are dealt out, mix bits of both words, so that a frequent word is spread."""
    with np.errstate(over="ignore"):
        mixed = (left * np.uint64(0x9E3779B97F4A7C15)) ^ (right * np.uint64(0xC2B2AE3D27D4EB4F))
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0x94D049BB133111EB)
        top = ((left >> np.uint64(48)) + ((right >> np.uint64(56)) << np.uint64(8))) & np.uint64(0xFFFF)
    return (top << np.uint64(48)) | (mixed >> np.uint64(16))


def _range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    """The equal part of the key space that a key lies in."""
    return ((keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[list[bytes | None]]:
    """The texts of batches, put together to CHUNK_BYTES and more: larger chunks have fewer distinct pairs in all."""
    texts: list[bytes | None] = []
    size = 0
    for b in batches:
        texts += as_bytes(b.column(0))
        size += b.nbytes
        if size >= CHUNK_BYTES:
            yield texts
            texts, size = [], 0
    if texts:
        yield texts


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays as one block; unpacked() is the inverse."""
    head = np.array([len(arrays), *(x for a in arrays for x in (a.itemsize, len(a)))], "<i8")
    return b"".join([head.tobytes(), *(a.tobytes() for a in arrays)])


def _unpacked(block) -> list[np.ndarray]:
    n = int(np.frombuffer(block, "<i8", 1)[0])
    shape = np.frombuffer(block, "<i8", 2 * n, 8).reshape(n, 2)
    out, at = [], 8 + 16 * n
    for width, size in shape.tolist():
        out.append(np.frombuffer(block, f"<u{width}", size, at))
        at += width * size
    return out


def _narrow(x: np.ndarray) -> np.ndarray:
    """The same numbers in the least unsigned type that holds them."""
    most = int(x.max()) if len(x) else 0
    return x.astype("<u1" if most < 1 << 8 else "<u2" if most < 1 << 16 else "<u4" if most < 1 << 32 else "<u8")


def _summed(key: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """Distinct keys in order and the sums of their values; the last array gives where each key came first in that order."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    at = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return [key[at], *(np.add.reduceat(v[order].astype(np.uint64), at) if len(at) else np.zeros(0, np.uint64) for v in values), order[at]]


def _merged(blocks: Iterator[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys in order, their counts, left and right words, of blocks of pairs; blocks are merged as they come, so what is held is in proportion to the distinct pairs."""
    held: list[tuple[np.ndarray, ...]] = []
    size, most = 0, MERGE_PAIRS

    def together() -> tuple[np.ndarray, ...]:
        left, right, times = (np.concatenate(x) for x in zip(*held, strict=True))
        key, times, first = _summed(pair_keys(left, right), times)
        return key, left[first], right[first], times

    for left, runs, right, times in blocks:
        held.append((np.repeat(left, runs.astype(np.int64)), right, times.astype(np.uint64)))
        size += len(right)
        if size > most:
            held[:] = [together()[1:]]
            size = len(held[0][0])
            most = max(MERGE_PAIRS, 2 * size)
    key, left, right, times = together()
    return key, times, left, right


@dataclass
class Model:
    """Where the arrays lie, in how many ranges of pairs and of words, and the totals from which probabilities follow."""

    uri: str
    ranges: int
    word_ranges: int
    tokens: int
    types: int
    pairs: int
    texts: int
    discount: tuple[float, float, float]
    low_discount: tuple[float, float, float]
    low_rest: float
    filled: Filled
    word_filled: Filled


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the numbers of things counted once, twice, three and four times; where those give none, 0.5, 1 and 1.5. Each is at least 0 and at most what it is taken from."""
    n1, n2, n3, n4 = n
    y = n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0.0
    if not (n1 and n2 and n3):
        return 0.5, 1.0, 1.5
    out = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.0), k + 1.0) for k, d in enumerate(out))


def train(docs: DataFrame, text_col: str = "text") -> Model:
    """Model of all texts of docs; null is empty. An empty table gives a model that knows nothing. Only the texts are read."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(F.col(text_col)).cast("bigint"))).first()[0] or 0
    ranges, uri = max(1, min(-(-size // RANGE_BYTES), 1 << 24)), workspace(spark, "bigrams")
    word_ranges = -(-ranges // 4)  # there is less to say about words than about pairs

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in gathered(batches):
            token, before, _, hashes = _tokens(texts)
            pair, times = np.unique(before * len(hashes) + token, return_counts=True)
            left, right = hashes[pair // len(hashes)], hashes[pair % len(hashes)]
            part = _range_of(pair_keys(left, right), ranges)
            order = np.argsort(part, kind="stable")
            left, right, times, part = left[order], right[order], times[order], part[order]
            cuts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            blocks = []
            for a, z in zip(cuts, np.append(cuts[1:], len(part)), strict=True):
                new = np.flatnonzero(np.append(True, left[a + 1 : z] != left[a : z - 1]))
                blocks.append(_packed(left[a:z][new], _narrow(np.diff(np.append(new, z - a))), right[a:z], _narrow(times[a:z])))
            yield pa.RecordBatch.from_arrays([pa.array(part[cuts], pa.int32()), pa.array(blocks, pa.binary())], names=["part", "block"])

    def pairs(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        key, times, left, right = _merged(_unpacked(x.as_buffer()) for x in table.column("block"))
        put_file(uri, f"pairs-{part}", [np.array([len(key)], "<u8"), key.astype("<u8"), times.astype("<u8" if len(times) and times.max() >= 1 << 32 else "<u4")])
        word, seen, _ = _summed(right, times)
        _, lefts, _ = _summed(right, np.ones(len(right), np.uint64))
        context, once, twice, more, _ = _summed(left, times == 1, times == 2, times > 2)
        of_word, of_context = _range_of(word, word_ranges), _range_of(context, word_ranges)
        parts, blocks = [], []
        for k in np.union1d(of_word, of_context).tolist():
            a, z = np.searchsorted(of_word, [k, k + 1])
            c, d = np.searchsorted(of_context, [k, k + 1])
            parts.append(k)
            blocks.append(_packed(word[a:z], _narrow(seen[a:z]), _narrow(lefts[a:z]), context[c:d], _narrow(once[c:d]), _narrow(twice[c:d]), _narrow(more[c:d])))
        # Totals of the pairs and the range's number, a block of two arrays, go along with some range of words.
        parts.append(part % word_ranges)
        blocks.append(_packed(np.array([(times == k).sum() for k in (1, 2, 3, 4)] + [len(times)], "<u8"), np.array([part], "<u8")))
        return pa.table([pa.array(parts, pa.int32()), pa.array(blocks, pa.binary())], names=["part", "block"])

    def words(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        got = [_unpacked(x.as_buffer()) for x in table.column("block")]
        of_pairs = [int(x) for x in np.sum([g[0] for g in got if len(g) == 2] or [np.zeros(5, np.uint64)], axis=0)]
        ranges_told = [int(g[1][0]) for g in got if len(g) == 2]
        empty = [np.zeros(0, "<u8")] * 7
        word, seen, left, context, once, twice, more = (np.concatenate([g[k].astype("<u8") for g in got if len(g) > 2] or [empty[k]]) for k in range(7))
        none_w, none_c = np.zeros(len(word), np.uint64), np.zeros(len(context), np.uint64)
        key, seen, left, once, twice, more, _ = _summed(np.concatenate([word, context]), *(np.concatenate(x) for x in ((seen, none_c), (left, none_c), (none_w, once), (none_w, twice), (none_w, more))))
        put_file(uri, f"words-{part}", [x.astype(t) for x, (_, t) in zip((key, seen, left, once, twice, more), WORD_COLUMNS, strict=True)])
        of_words = [int(seen.sum()), int((seen > 0).sum()), *(int((left == k).sum()) for k in (1, 2, 3, 4)), int((left > 2).sum())]
        return pa.table([pa.array([part], pa.int32()), pa.array([of_words], pa.list_(pa.int64())), pa.array([of_pairs], pa.list_(pa.int64())), pa.array([ranges_told], pa.list_(pa.int64()))], names=["part", "words", "pairs", "ranges"])

    schema = "part int, block binary"
    # One partition for each range, so that a task's share follows neither the session's setting nor the size of the table.
    sent = arrow_map(docs.select(text_col), counted, schema).repartitionById(ranges, F.col("part")).groupBy("part").applyInArrow(pairs, schema)
    rows = sent.repartitionById(word_ranges, F.col("part")).groupBy("part").applyInArrow(words, "part int, words array<bigint>, pairs array<bigint>, ranges array<bigint>").collect()
    of_pairs = [sum(x) for x in zip(*(r.pairs for r in rows), strict=True)] or [0] * 5
    of_words = [sum(x) for x in zip(*(r.words for r in rows), strict=True)] or [0] * 7
    low = discounts(of_words[2:6])
    rest = (low[0] * of_words[2] + low[1] * of_words[3] + low[2] * of_words[6]) / of_pairs[4] if of_pairs[4] else 1.0
    model = Model(uri, ranges, word_ranges, of_words[0], of_words[1], of_pairs[4], 0, discounts(of_pairs[:4]), low, rest, Filled(ranges, (k for r in rows for k in r.ranges)), Filled(word_ranges, (r.part for r in rows)))
    model.texts = int(Arrays(model).words(np.array([xxhash.xxh64_intdigest(END)], np.uint64))["count"][0])
    return model


class Arrays:
    """A worker's view of a model: sorted arrays mapped from the shared folder, opened when needed; a bounded number of them stay open."""

    def __init__(self, model: Model, most: int = 1024):
        self.model, self.files = model, Opened(model.uri, most)

    def _file(self, kind: str, part: int) -> np.ndarray:
        """A range's file; empty if no key fell into the range. A file that should be there and isn't is an error."""
        return self.files[f"{kind}-{part}"] if part in (self.model.filled if kind == "pairs" else self.model.word_filled) else np.zeros(0, np.uint8)

    def _each(self, keys: np.ndarray, ranges: int):
        part = _range_of(keys, ranges)
        cuts = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.zeros(0, np.int64)
        for a, z in zip(cuts.tolist(), [*cuts[1:].tolist(), len(part)], strict=False):
            yield int(part[a]), a, z

    def words(self, keys: np.ndarray) -> dict[str, np.ndarray]:
        """WORD_COLUMNS but the key, for each of these hashes (in any order); 0 for unknown ones."""
        order = np.argsort(keys, kind="stable")
        asked = keys[order]
        out = {name: np.zeros(len(keys), np.int64) for name, _ in WORD_COLUMNS[1:]}
        for part, a, z in self._each(asked, self.model.word_ranges):
            raw, at, columns = self._file("words", part), 0, []
            n = len(raw) // 32
            for _, kind in WORD_COLUMNS:
                columns.append(raw[at : at + n * int(kind[2])].view(kind))
                at += n * int(kind[2])
            if n:
                slot = np.minimum(np.searchsorted(columns[0], asked[a:z]), n - 1)
                known = columns[0][slot] == asked[a:z]
                for (name, _), column in zip(WORD_COLUMNS[1:], columns[1:], strict=True):
                    out[name][order[a:z][known]] = column[slot[known]]
        return out

    def pairs(self, keys: np.ndarray) -> np.ndarray:
        """Counts of these pair keys, 0 for unknown ones; keys in order."""
        out = np.zeros(len(keys), np.int64)
        for part, a, z in self._each(keys, self.model.ranges):
            raw = self._file("pairs", part)
            if len(raw):
                n = int(raw[:8].view("<u8")[0])
                key, seen = raw[8 : 8 + 8 * n].view("<u8"), raw[8 + 8 * n :].view(f"<u{(len(raw) - 8 - 8 * n) // n}")
                slot = np.minimum(np.searchsorted(key, keys[a:z]), n - 1)
                known = key[slot] == keys[a:z]
                out[a:z][known] = seen[slot[known]]
        return out

    def score(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """For each text: tokens, known tokens, base score, score."""
        m = self.model
        token, before, first, hashes = _tokens(texts)
        w = self.words(hashes)
        low = np.array([0.0, *m.low_discount])
        cont = np.maximum(w["left"] - low[np.minimum(w["left"], 3)], 0) / max(m.pairs, 1) + m.low_rest / (m.types + 1)
        total = w["count"].copy()
        total[0] = m.texts
        d = np.array([0.0, *m.discount])
        gamma = np.where(total > 0, (d[1] * w["once"] + d[2] * w["twice"] + d[3] * w["more"]) / np.maximum(total, 1), 1.0)
        pair, inverse = np.unique(before * len(hashes) + token, return_inverse=True)
        left, right = pair // len(hashes), pair % len(hashes)
        key = pair_keys(hashes[left], hashes[right])
        order = np.argsort(key)
        seen = np.empty(len(key), np.int64)
        seen[order] = self.pairs(key[order])
        p = np.maximum(seen - d[np.minimum(seen, 3)], 0) / np.maximum(total[left], 1) + gamma[left] * cont[right]
        base = np.log10((w["count"] + 0.5) / (m.tokens + 0.5 * (m.types + 1)))
        sizes = np.diff(np.append(first, len(token)))
        sums = [np.add.reduceat(x, first) for x in ((w["count"] > 0)[token].astype(np.int64), base[token], np.log10(p)[inverse])]
        return [sizes, *sums]


def scored(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """keep..., n_tokens, n_known, train_tokens, base_score, score, perplexity for each row of docs.

    A null or empty text is one end token. Repeated rows and null ids keep their row; an empty table gives an empty one.
    Columns not named aren't read.
    """
    few = docs.select(F.struct(*[F.col(c) for c in keep]).alias("kept"), F.col(text_col).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = Arrays(model)
        for b in batches:
            texts = as_bytes(b.column(1))
            found = [arrays.score(texts[i:j]) for i, j in groups(texts, CHUNK_BYTES)]
            if not found:
                continue
            n, known, base, score = (np.concatenate(x) for x in zip(*found, strict=True))
            columns = [pa.array(x) for x in (n.astype(np.int64), known, np.full(len(n), model.tokens, np.int64), base, score, np.power(10.0, np.minimum(-score / n, 300.0)))]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], names=["kept", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

    out = arrow_map(few, work, f"kept {few.schema[0].dataType.simpleString()}, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, perplexity double")
    return out.select(*[F.col(f"kept.`{c}`").alias(c) for c in keep], *out.columns[1:])
