"""Quality rules and an isolation forest on their statistics.

Each text is described by rule statistics (word length, symbols, repeated lines and words, variety, capitals, line ends).
A forest of random splits is grown on small subsamples of a bounded sample of labelled rows; documents that few splits
isolate (short paths) are anomalous. The threshold on that score is set on labelled rows that grew no tree, as scores of those
that did are flattered, and that the base rules pass, as only those are the forest's to judge: it has the best net gain while
at most `max_good_loss` of the good ones go.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transect.llm.common import Shipped, arrow_map, as_bytes, columns_of, least_hashed, whole_rows

SPACE = b" \t\n\x0b\x0c\r"
CONTINUATION = bytes(range(0x80, 0xC0))
SYMBOLS = b"#*$%&|<>"
CAPITALS = bytes(range(65, 91))
WINDOW = 8
#: Base rules: too few words; percent of words in repeated windows.
MIN_WORDS, MAX_REPEATED = 20, 30
STATS = ("word_length", "symbol_share", "repeated_line_share", "repeated_word_share", "variety", "capital_share", "line_end_share", "shout_share")
#: The most good rows that the forest may lose. On sf0.1 (20 forests of different halves and seeds) limits of 0.4, 1, 2 and 3 %
#: caught 64, 89, 99.8 and 100 % of the bad rows, in the median; without any limit the best net gain loses 1.7 % of the good ones.
MAX_GOOD_LOSS = 0.02
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[bytes], window: int = WINDOW) -> tuple[int, int]:
    """Words inside windows that occur twice or more in the text (the first occurrence included), and distinct words.

    Windows are compared by hash; only if two hashes agree are they told apart exactly, by ids of doubling length.
    """
    known: dict[bytes, int] = {}
    ids = [known.setdefault(w, len(known)) for w in words]
    n = len(ids) - window + 1
    if n < 2:
        return 0, len(known)
    code = np.array(ids, np.uint64)
    with np.errstate(over="ignore"):
        h = (code + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        for step, factor in ((1, 0xBF58476D1CE4E5B9), (2, 0x94D049BB133111EB), (4, 0xD6E8FEB86659FD93)):
            h = h[:-step] * np.uint64(factor) + h[step:]
            h ^= h >> np.uint64(32)
    ordered = np.sort(h)
    if not (ordered[1:] == ordered[:-1]).any():
        return 0, len(known)
    exact = code.astype(np.int64)
    for step in (1, 2, 4):
        _, exact = np.unique(exact[:-step] * (len(exact) + len(known)) + exact[step:], return_inverse=True)
    again = np.bincount(exact)[exact] > 1
    change = np.zeros(len(ids) + 1, np.int64)
    change[:n] += again
    change[window : window + n] -= again
    return int((np.cumsum(change) > 0).sum()), len(known)


def describe(text: bytes | None) -> tuple[list[int], list[float]]:
    """COUNTS and STATS of a text."""
    text = text or b""
    words = text.split()
    n = len(words)
    if not n:
        return [0] * len(COUNTS), [0.0] * len(STATS)
    chars = len(text.translate(None, SPACE + CONTINUATION))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip()]
    repeats = len(lines) - len(set(lines))
    again, distinct = repeated_words(words)
    ends = sum(x.rstrip()[-1:] in b".!?" for x in lines)
    capitals = len(text) - len(text.translate(None, CAPITALS))
    stats = [chars / n, symbols / n, repeats / len(lines), again / n, np.log1p(distinct) / np.log1p(n), capitals / chars, ends / len(lines), text.count(b"!") / n]
    return [n, chars, symbols, repeats, again], stats


@dataclass
class Forest:
    """Isolation trees in arrays: a split's statistic and value, its children, and the path length where a leaf ends."""

    feature: np.ndarray
    value: np.ndarray
    child: np.ndarray
    path: np.ndarray
    roots: np.ndarray
    scale: float
    threshold: float = np.inf

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 to the power of minus the mean path over the usual one: near 1 is anomalous."""
        total = np.zeros(len(x))
        every = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            live = every
            while len(live):
                at = node[live]
                live = live[inner := self.feature[at] >= 0]
                at = at[inner]
                node[live] = self.child[at, (x[live, self.feature[at]] >= self.value[at]).astype(np.int64)]
            total += self.path[node]
        return np.exp2(-total / (len(self.roots) * self.scale))


def _usual(n: int) -> float:
    """Mean path of an unsuccessful search among n."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n


def grow(x: np.ndarray, trees: int = 100, subsample: int = 256, seed: int = 7) -> Forest:
    """A forest on rows x; each tree sees `subsample` of them and is grown to the usual depth."""
    rng = np.random.default_rng(seed)
    size = min(subsample, len(x))
    most = int(np.ceil(np.log2(max(size, 2))))
    feature, value, child, path, roots = [], [], [], [], []

    def build(rows: np.ndarray, depth: int) -> int:
        at = len(feature)
        feature.append(-1), value.append(0.0), child.append([at, at]), path.append(depth + _usual(len(rows)))
        low, high = (rows.min(0), rows.max(0)) if len(rows) else (np.zeros(0), np.zeros(0))
        able = np.flatnonzero(high > low)
        if depth < most and len(rows) > 1 and len(able):
            f = int(rng.choice(able))
            v = float(rng.uniform(low[f], high[f]))
            right = rows[:, f] >= v
            if right.any() and not right.all():
                feature[at], value[at] = f, v
                child[at] = [build(rows[~right], depth + 1), build(rows[right], depth + 1)]
        return at

    for _ in range(trees):
        roots.append(build(x[rng.choice(len(x), size, replace=False)] if len(x) else x, 0))
    return Forest(np.array(feature), np.array(value), np.array(child), np.array(path), np.array(roots), max(_usual(size), 1.0))


def calibrate(score: np.ndarray, good: np.ndarray, max_good_loss: float) -> float:
    """The score above which rows are rejected: the one with the most correct rejections net of wrong ones, of those that lose at most max_good_loss of the good rows. Infinite without rows of both kinds."""
    if not good.any() or good.all():
        return np.inf
    order = np.argsort(-score, kind="stable")
    s, g = score[order], good[order]
    lost, caught = np.cumsum(g) / good.sum(), np.cumsum(~g) / (~good).sum()
    last = np.append(s[1:] < s[:-1], True)  # only whole groups of ties can be rejected
    able = last & (lost <= max_good_loss)
    if not able.any():
        return float(s[0])
    k = int(np.argmax(np.where(able, caught - lost, -1)))
    return float((s[k] + s[k + 1]) / 2) if k + 1 < len(s) else float(np.nextafter(s[k], -1))


def base_failed(n: np.ndarray, again: np.ndarray) -> np.ndarray:
    """Whether the base rules reject a text of n words of which `again` lie in repeated windows."""
    return (n < MIN_WORDS) | (100 * again > MAX_REPEATED * n)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = 8192, max_good_loss: float = MAX_GOOD_LOSS, seed: int = 7) -> Forest:
    """Forest and threshold from at most `sample` labelled rows, those whose id has the least hash.

    Every other one of them, in the order of that hash, grows the trees; the rest, where the base rules pass it, sets the
    threshold. Labels other than 0 and 1, null ids and texts with few words are left out; of rows that share an id the one
    with the least hash of its text counts, of labels the least.
    """
    usable = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.min(label_col).alias("good"))
    few = least_hashed(usable.withColumn("h", F.xxhash64(F.col(id_col))), "h", sample).drop("h")
    joined = docs.select(id_col, text_col).join(F.broadcast(few), id_col).select(F.col(id_col).alias("id"), F.col("good").cast("int"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("tie"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [describe(t) for t in as_bytes(b.column(2))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(3), b.column(1), *(pa.array([f[0][k] for f in found], pa.int64()) for k in (0, 4)), pa.array([f[1] for f in found], pa.list_(pa.float64()))], names=["id", "tie", "good", "n", "again", "stats"])

    kind = joined.schema["id"].dataType.simpleString()
    each = arrow_map(joined, work, f"id {kind}, tie bigint, good int, n bigint, again bigint, stats array<double>").filter(F.col("n") >= MIN_WORDS)
    rows = each.groupBy("id").agg(F.min(F.struct("tie", "n", "again", "good", "stats")).alias("r")).orderBy(F.xxhash64("id"), "id").select("r.*").collect()
    x = np.array([r.stats for r in rows]).reshape(-1, len(STATS))
    good = np.array([r.good == 1 for r in rows], bool)
    forest = grow(x[::2], seed=seed)
    judged = ~base_failed(*(np.array([r[k] for r in rows], np.int64) for k in ("n", "again"))) & (np.arange(len(rows)) % 2 == 1)
    forest.threshold = calibrate(forest.score(x[judged]), good[judged], max_good_loss)
    return forest


def _judge(texts: list[bytes | None], forest: Forest) -> tuple[list[list[int]], np.ndarray, np.ndarray, np.ndarray]:
    """COUNTS, base_failed, score, kept of each text."""
    found = [describe(t) for t in texts]
    counts = [f[0] for f in found]
    failed = base_failed(*(np.array([c[k] for c in counts], np.int64) for k in (0, 4)))
    score = forest.score(np.array([f[1] for f in found]).reshape(-1, len(STATS)))
    return counts, failed, score, ~failed & ~(score > forest.threshold)


def judged(docs: DataFrame, forest: Forest, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, COUNTS..., base_failed, score, kept) of each row of docs; score is 0 to 1, above the forest's threshold the row is rejected.

    A null or empty text has no words and fails. Repeated rows, ties and null ids keep their row; an empty table gives
    an empty one; other columns aren't read.
    """
    shared = Shipped(docs.sparkSession, forest)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, failed, score, kept = _judge(as_bytes(b.column(1)), shared.value)
            columns = [pa.array([c[k] for c in counts], pa.int64()) for k in range(len(COUNTS))]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns, pa.array(failed), pa.array(score), pa.array(kept)], names=["id", *COUNTS, "base_failed", "score", "kept"])

    few = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = few.schema[0].dataType.simpleString()
    return arrow_map(few, work, f"id {kind}, {', '.join(f'{c} bigint' for c in COUNTS)}, base_failed boolean, score double, kept boolean").withColumnRenamed("id", id_col)


def filtered(docs: DataFrame, forest: Forest, text_col: str = "text") -> DataFrame:
    """The rows of docs, with their columns, that the rules and the forest keep."""
    shared, at, rows = Shipped(docs.sparkSession, forest), docs.columns.index(text_col), whole_rows(docs)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(_judge(as_bytes(b.column(0).field(at)), shared.value)[3], pa.bool_()))

    return columns_of(arrow_map(rows, work, rows.schema), docs.columns)
