"""Language identification by known words first, then shorter and shorter character n-grams.

Words are runs of letters, lower-cased. Spark counts every word of the training texts by language, and from these counts every
character n-gram of up to ORDER characters. All counts are kept, as sorted arrays of hashes in the shared folder, which the
workers map; nothing is cut off, so the model grows with the texts while a worker holds only what its texts need. A known word,
one that training has seen in any language, scores by its log frequency in each language; an unknown one by the longest order
of n-grams of which training has seen any, the mean log frequency of those, one order less for each step back. Words and
n-grams are compared by 64-bit hash.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transect.llm.common import Filled, Opened, arrow_map, groups, put_file, stored, workspace
from transect.llm.lm import _narrow, _packed, _range_of, _unpacked

#: Longest n-grams; words are padded by a space on each side.
ORDER = 4
#: Distinct items that a task holds before it sends their counts on, or forgets their scores.
FLUSH = 200_000
#: Counts in one file, about; more of them are more files.
FILE_ROWS = 1_000_000
#: Added to each count; seed of the hashes, that of Spark's xxhash64; what tells an n-gram's hash from a word's.
ALPHA, SEED, GRAM = 0.5, 42, "\0"
UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters of a text, lower-cased."""
    return WORD.findall((text or "").lower())


def grams_of(word: str, n: int) -> list[str]:
    """The n-grams of a padded word, but for a lone space."""
    padded = f" {word} "
    return [padded[i : i + n] for i in range(n == 1, len(padded) - n + 1 - (n == 1))]


@dataclass
class Model:
    """Where the counts lie and in how many files; by number of characters, 0 for words: all counts of each language, distinct items; which ranges have a file."""

    langs: list[str]
    uri: str = ""
    files: int = 1
    totals: dict[int, list[int]] = field(default_factory=dict)
    types: dict[int, int] = field(default_factory=dict)
    filled: Filled = field(default_factory=lambda: Filled(1, ()))


class Counts:
    """A worker's view of the counts: hash, language and count, sorted by hash, mapped from the shared folder when needed; a bounded number of files stay open."""

    def __init__(self, model: Model, most: int = 1024):
        self.model, self.files = model, Opened(model.uri, most)

    def _file(self, part: int) -> list[np.ndarray]:
        """A range's arrays; empty if nothing fell into it. A file that should be there and isn't is an error."""
        if part not in self.model.filled:
            return [np.zeros(0, np.uint64), np.zeros(0, np.uint8), np.zeros(0, np.uint8)]
        return _unpacked(self.files[f"counts-{part}"])

    def of(self, items: list[str], mark: str = "") -> np.ndarray:
        """Count of each item in each language; all 0 for one that training hasn't seen. mark: GRAM for n-grams."""
        out = np.zeros((len(items), len(self.model.langs)))
        keys = np.fromiter((xxhash.xxh64_intdigest((x + mark).encode(), SEED) for x in items), np.uint64, len(items))
        order = np.argsort(keys)
        keys = keys[order]
        part = _range_of(keys, self.model.files)
        cuts = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.zeros(0, np.int64)
        for a, z in zip(cuts.tolist(), [*cuts[1:].tolist(), len(part)], strict=False):
            key, lang, n = self._file(int(part[a]))
            low, high = np.searchsorted(key, keys[a:z], "left"), np.searchsorted(key, keys[a:z], "right")
            sizes = high - low
            at = np.arange(sizes.sum()) + np.repeat(low - (np.cumsum(sizes) - sizes), sizes)
            out[np.repeat(order[a:z], sizes), lang[at]] = n[at]
        return out


class Rows(dict):
    """Row of each item in a table of scores that grows as items come."""

    def __init__(self, score: Callable[[list[str]], np.ndarray], width: int):
        super().__init__()
        self._score, self.size, self.table = score, 0, np.zeros((1024, width))

    def add(self, items: Iterable[str]) -> None:
        """Score those of the items that have no row yet."""
        new = [x for x in set(items) if x not in self]
        if self.size + len(new) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros((len(self.table) + len(new), self.table.shape[1]))])
        if new:
            self.table[self.size : self.size + len(new)] = self._score(new)
            self.update(zip(new, range(self.size, self.size + len(new)), strict=True))
            self.size += len(new)

    def trim(self) -> None:
        """Forget the items if there are too many; not while their rows are in use."""
        if self.size > FLUSH:
            self.clear()
            self.size, self.table = 0, self.table[:1024].copy()


class Scorer:
    """What a worker knows of a model: scores of words and of n-grams (with a last column that is 1 for those seen), as they are needed."""

    def __init__(self, model: Model):
        self.model, self.counts = model, Counts(model)
        self.words = Rows(self._words, len(model.langs))
        self.grams = {n: Rows(lambda items, n=n: self._grams(items, n), len(model.langs) + 1) for n in range(1, ORDER + 1)}

    def _logs(self, counts: np.ndarray, n: int) -> np.ndarray:
        return np.log(counts + ALPHA) - np.log(np.array(self.model.totals[n]) + ALPHA * (self.model.types[n] + 1))

    def _grams(self, items: list[str], n: int) -> np.ndarray:
        counts = self.counts.of(items, GRAM)
        seen = counts.any(axis=1, keepdims=True)
        return np.hstack([self._logs(counts, n) * seen, seen])

    def _words(self, items: list[str]) -> np.ndarray:
        counts = self.counts.of(items)
        scores = self._logs(counts, 0)
        rest = np.flatnonzero(~counts.any(axis=1))
        scores[rest] = 0.0
        for n in range(ORDER, 0, -1):
            rows, each = self.grams[n], [grams_of(items[k], n) for k in rest]
            rows.add(chain.from_iterable(each))
            sizes = np.array([len(g) for g in each], np.int64)
            able = np.flatnonzero(sizes)
            if len(able):
                at = np.fromiter(map(rows.__getitem__, chain.from_iterable(each)), np.int64, int(sizes.sum()))
                total = np.add.reduceat(rows.table[at], (np.cumsum(sizes) - sizes)[able], axis=0)
                done = total[:, -1] > 0
                scores[rest[able[done]]] = total[done, :-1] / total[done, -1:]
                rest = np.delete(rest, able[done])
            rows.trim()
        return scores

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and probability of each text; UNKNOWN and 0 for one without a letter, or if the model has no language."""
        split = [words_of(t) for t in texts]
        split = [w if any(c.isalpha() for x in w for c in x) else [] for w in split]
        sizes = np.array([len(w) for w in split], np.int64)
        out = [(UNKNOWN, 0.0)] * len(texts)
        if not self.model.langs or not sizes.any():
            return out
        self.words.trim()
        self.words.add(chain.from_iterable(split))
        at = np.fromiter(map(self.words.__getitem__, chain.from_iterable(split)), np.int64, int(sizes.sum()))
        able = np.flatnonzero(sizes)
        score = np.add.reduceat(self.words.table[at], (np.cumsum(sizes) - sizes)[able], axis=0)
        share = np.exp(score - score.max(axis=1, keepdims=True))
        best = share.argmax(axis=1)
        sure = share[np.arange(len(able)), best] / share.sum(axis=1)
        for k, b, p in zip(able.tolist(), best.tolist(), sure.tolist(), strict=True):
            out[k] = (self.model.langs[b], p)
        return out


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Model of the texts that have a language; counts cover all of them. Null texts and languages are left out; without any the model has no language."""
    few = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    uri = workspace(docs.sparkSession, "words")

    def sent(counts: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, c in counts.items():
            if c:
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(c), pa.string()), pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], names=["lang", "item", "n"])
        counts.clear()

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = defaultdict(Counter)
        for b in batches:
            langs, texts = b.column(0).to_pylist(), b.column(1)
            for i, j in groups(texts.cast(pa.binary()).to_pylist(), 2 << 20):
                for lang, text in zip(langs[i:j], texts[i:j].to_pylist(), strict=True):
                    counts[lang].update(words_of(text))
                if sum(map(len, counts.values())) > FLUSH:
                    yield from sent(counts)
        yield from sent(counts)

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = defaultdict(Counter)
        for b in batches:
            for lang, word, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                of_lang = counts[lang]
                for size in range(1, ORDER + 1):
                    for g in grams_of(word, size):
                        of_lang[g] += n
                if sum(map(len, counts.values())) > FLUSH:
                    yield from sent(counts)
        yield from sent(counts)

    def summed(work, rows: DataFrame) -> DataFrame:
        return arrow_map(rows, work, "lang string, item string, n bigint").groupBy("lang", "item").agg(F.sum("n").alias("n"))

    counts = stored(summed(words, few), f"{uri}/counted")
    langs = sorted(r.lang for r in counts.select("lang").distinct().collect())
    if not langs:
        return Model([])
    found = stored(summed(grams, counts), f"{uri}/grams")
    files = max(1, min(-(-(counts.count() + found.count()) // FILE_ROWS), 1 << 24))

    def written(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        key, n = table.column("h").to_numpy().view(np.uint64), table.column("n").to_numpy().astype(np.uint64)
        lang, size = pc.index_in(table.column("lang"), pa.array(langs)).to_numpy().astype(np.uint64), table.column("size").to_numpy()
        order = np.argsort(key)
        key = key[order]
        put_file(f"{uri}/model", f"counts-{part}", [_packed(key, _narrow(lang[order]), _narrow(n[order]))])
        new = np.append(True, key[1:] != key[:-1])
        rows = [(s, -1, int(new[size[order] == s].sum())) for s in np.unique(size).tolist()]
        rows += [(s, k, int(n[(size == s) & (lang == k)].sum())) for s in np.unique(size).tolist() for k in np.unique(lang[size == s]).tolist()]
        rows.append((-1, part, 1))
        return pa.table([pa.array([r[0] for r in rows], pa.int32()), pa.array([int(r[1]) for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int64())], names=["size", "lang", "n"])

    rows = counts.select("lang", F.xxhash64("item").alias("h"), F.lit(0).alias("size"), "n").unionByName(found.select("lang", F.xxhash64(F.concat("item", F.lit(GRAM))).alias("h"), F.length("item").alias("size"), "n"))
    of_range = F.shiftrightunsigned(F.shiftrightunsigned("h", 32) * files, 32).cast("int")
    sums = rows.withColumn("part", of_range).repartitionById(files, F.col("part")).groupBy("part").applyInArrow(written, "size int, lang int, n bigint").groupBy("size", "lang").agg(F.sum("n").alias("n")).collect()
    n = {(r["size"], r["lang"]): r["n"] for r in sums}
    return Model(langs, f"{uri}/model", files, {s: [n.get((s, k), 0) for k in range(len(langs))] for s in range(ORDER + 1)}, {s: n.get((s, -1), 0) for s in range(ORDER + 1)}, Filled(files, (part for s, part in n if s == -1)))


def predicted(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """keep..., lang_pred, score for each row of docs.

    A null text or one without a letter is UNKNOWN with score 0. Ties go to the first language by code point. Repeated rows
    and null ids keep their row; an empty table gives an empty one. Only columns named are read.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for b in batches:
            raw, texts = b.column(1).cast(pa.binary()).to_pylist(), b.column(1).to_pylist()
            found = [x for i, j in groups(raw, 2 << 20) for x in scorer.predict(texts[i:j])]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], names=["kept", "lang_pred", "score"])

    few = docs.select(F.struct(*[F.col(c) for c in keep]).alias("kept"), F.col(text_col).alias("text"))
    out = arrow_map(few, work, f"kept {few.schema[0].dataType.simpleString()}, lang_pred string, score double")
    return out.select(*[F.col(f"kept.`{c}`").alias(c) for c in keep], "lang_pred", "score")
