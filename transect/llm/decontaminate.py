"""Benchmark decontamination with a generalised suffix automaton of the test items.

Items and texts are lower-cased (A-Z) and cut into words of letters, digits and non-ASCII characters. The automaton holds
every run of words of every item. A text is streamed through it while the longest match that ends at each word is
tracked; where that reaches `window` words, these words are hit, and so is a whole item shorter than the window.
Runs of words whose neighbours follow each other in no item can hold no match, so they are skipped by array operations
first; the rest is streamed. Executors build one automaton for each block of at most `block_words` words of items and write
it to the shared folder; a longer item is cut into parts that overlap by all but one word of a window. Documents are read
once, whatever the number of blocks: a worker takes some of them and runs them through one automaton after the other.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from transect.llm.common import arrow_map, columns_of, groups, mapped, put_file, workspace

_KEEP = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(0x80, 0x100))
#: Bytes of documents that a worker holds where there is more than one automaton, each of which it loads for them.
HELD_BYTES = 64 << 20
#: Lower-cases A-Z and turns what is not part of a word into a space.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c in _KEEP else 32 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Normalised words of a text."""
    return (text or b"").translate(WORD_BYTES).split()


class Automaton:
    """Generalised suffix automaton over word ids, with the items of each window and of each short item."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [(name, [self.vocab.setdefault(w, len(self.vocab)) for w in words]) for name, words in items if words]
        for _, ids in coded:
            last = 0
            for t in ids:
                last = self._extend(last, t)
        at_window: dict[int, set[str]] = {}
        whole: dict[int, dict[int, set[str]]] = {}
        for name, ids in coded:
            state = 0
            for k, t in enumerate(ids):
                state = self.next[state][t]
                if k + 1 >= window:
                    while self.length[self.link[state]] >= window:
                        state = self.link[state]
                    at_window.setdefault(state, set()).add(name)
            if len(ids) < window:
                whole.setdefault(state, {}).setdefault(len(ids), set()).add(name)
        self.at_window = {s: sorted(x) for s, x in at_window.items()}
        self.short: dict[int, list[tuple[int, list[str]]]] = {}
        if whole:
            for s in sorted(range(len(self.link)), key=self.length.__getitem__):
                found = [(n, sorted(x)) for n, x in whole.get(s, {}).items()] + (self.short.get(self.link[s], []) if s else [])
                if found:
                    self.short[s] = found
        self.least = min([window, *(len(ids) for _, ids in coded)])
        n = len(self.vocab)
        self.follows = np.unique(np.array([a * n + b for _, ids in coded for a, b in zip(ids, ids[1:], strict=False)], np.int64))

    def _extend(self, last: int, t: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if t in nxt[last]:
            q = nxt[last][t]
            return q if length[q] == length[last] + 1 else self._clone(last, t, q)
        new = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and t not in nxt[p]:
            nxt[p][t] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][t]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, t, q)
        return new

    def _clone(self, p: int, t: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        copy = len(nxt)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        while p >= 0 and nxt[p].get(t) == q:
            nxt[p][t] = copy
            p = link[p]
        link[q] = copy
        return copy

    def stream(self, ids: list[int]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit ranges of positions (merged, end exclusive) and the items that occur."""
        nxt, link, length, window = self.next, self.link, self.length, self.window
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        state = matched = 0
        for k, t in enumerate(ids):
            while state and t not in nxt[state]:
                state = link[state]
                matched = length[state]
            if t in nxt[state]:
                state = nxt[state][t]
                matched += 1
            size = 0
            if matched >= window:
                size, s = matched, state
                while length[link[s]] >= window:
                    s = link[s]
                items.update(self.at_window[s])
            for n, names in self.short.get(state, ()):
                if n <= matched:
                    size = max(size, n)
                    items.update(names)
            if size:
                a = k + 1 - size
                while spans and spans[-1][1] >= a:
                    a = min(a, spans.pop()[0])
                spans.append((a, k + 1))
        return spans, items

    def scan(self, texts: list[bytes | None]) -> list[tuple[int, list[tuple[int, int]], set[str]]]:
        """For each text: its number of words, hit ranges of words, items that occur."""
        get, n = self.vocab.get, len(self.vocab)
        split = [words_of(t) for t in texts]
        counts = [len(w) for w in split]
        found: list = [(c, [], set()) for c in counts]
        if not n or not sum(counts):
            return found
        ids = np.full(sum(counts) + len(counts) + 1, -1, np.int64)
        starts = np.cumsum([1, *(c + 1 for c in counts[:-1])])
        for at, words in zip(starts, split, strict=True):
            ids[at : at + len(words)] = np.fromiter(map(get, words, repeat(-1)), np.int64, len(words))
        known = ids >= 0
        pairs = np.flatnonzero(known[:-1] & known[1:])
        code = ids[pairs] * n + ids[pairs + 1]
        joined = np.zeros(len(ids), bool)
        if len(self.follows):
            slot = np.minimum(np.searchsorted(self.follows, code), len(self.follows) - 1)
            joined[pairs[self.follows[slot] == code]] = True
        first = np.flatnonzero(known & ~np.concatenate([[False], joined[:-1]]))
        last = np.flatnonzero(known & ~joined)
        long = last - first + 1 >= self.least
        for a, b in zip(first[long].tolist(), last[long].tolist(), strict=True):
            spans, items = self.stream(ids[a : b + 1].tolist())
            if spans:
                k = int(np.searchsorted(starts, a, "right")) - 1
                at = a - int(starts[k])
                found[k][1].extend((at + x, at + y) for x, y in spans)
                found[k][2].update(items)
        return found


def cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words in these ranges and what stands between them."""
    words = [m.span() for m in re.finditer(rb"[^ ]+", text.translate(WORD_BYTES))]
    kept, at = [], 0
    for a, b in spans:
        kept.append(text[at : words[a][0]])
        at = words[b - 1][1]
    return b"".join([*kept, text[at:]])


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


class Automata:
    """The automata of all blocks, in the shared folder; a worker keeps one of them at a time."""

    def __init__(self, uri: str, names: list[str]):
        self.uri, self.names, self._name, self._value = uri, names, None, None

    def scan(self, texts: list[bytes | None]) -> list[tuple[int, list[tuple[int, int]], set[str]]]:
        """Automaton.scan() for all of them together."""
        if not self.names:
            return [(len(words_of(t)), [], set()) for t in texts]
        found: list = [(0, [], set())] * len(texts)
        for name in self.names:
            if name != self._name:
                self._value = None  # the old one goes first
                self._name, self._value = name, cloudpickle.loads(mapped(self.uri, name).tobytes())
            got = [x for i, j in groups(texts) for x in self._value.scan(texts[i:j])]
            found = [(n, [*a, *b], x | y) for (n, a, x), (_, b, y) in zip(got, found, strict=True)]
        return [(n, _merged(a), x) if a else (n, a, x) for n, a, x in found]


def automata(items: DataFrame, id_col: str, text_col: str, window: int, block_words: int) -> Automata:
    """Build the automata of items in tasks, each from blocks of at most block_words words. The driver gets their names."""
    uri, part_words = workspace(items.sparkSession, "automata"), max(block_words, 2 * window)
    few = items.filter(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    size = few.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
        for b in batches:
            for name, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), strict=True):
                words = words_of(text)
                for k in range(0, max(1, len(words) - window + 1), part_words - window + 1):
                    yield name, words[k : k + part_words]

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, words, names = [], 0, []

        def close() -> None:
            names.append(f"automaton-{TaskContext.get().partitionId()}-{len(names)}")
            put_file(uri, names[-1], [cloudpickle.dumps(Automaton(block, window))])
            block.clear()

        for name, part in parts(batches):
            if words and words + len(part) > block_words:
                close()
                words = 0
            block.append((name, part))
            words += len(part)
        if words:
            close()
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], names=["name"])

    # In a fixed order, so that a task that runs again leaves the same files.
    dealt = few.repartition(max(1, -(-size // (6 * block_words))), "id", "text").sortWithinPartitions("id", "text")
    return Automata(uri, sorted(r.name for r in arrow_map(dealt, built, "name string").collect()))


_FOUND = [
    StructField("n_words", IntegerType()),
    StructField("spans", ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType())]))),
    StructField("items", ArrayType(StringType())),
]
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _found(docs: DataFrame, columns: list[str], shared: Automata, text_col: str, finish: Callable[[pa.RecordBatch, Automata], pa.RecordBatch] | None = None) -> DataFrame:
    """(row struct<columns>, n_words, spans, items), one row for each row of docs; or (row) of what finish makes of such a batch."""
    at, field = columns.index(text_col), F.struct(*[F.col(f"`{c}`") for c in columns])
    now = docs.select(field.alias("row"))
    schema = StructType([now.schema["row"], *_FOUND])
    most = HELD_BYTES if len(shared.names) > 1 else 0

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
        some, size = [], 0
        for b in batches:
            some.append(b)
            size += b.nbytes
            if size >= most:
                yield some
                some, size = [], 0
        if some:
            yield some

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in held(batches):
            found = iter(shared.scan(list(chain.from_iterable(b.column(0).field(at).cast(pa.binary()).to_pylist() for b in some))))
            for b in some:
                each = [next(found) for _ in range(b.num_rows)]
                spans = [[{"start": x, "end": y} for x, y in f[1]] for f in each]
                arrays = [b.column(0), pa.array([f[0] for f in each], pa.int32()), pa.array(spans, _SPANS), pa.array([sorted(f[2]) for f in each], pa.list_(pa.string()))]
                out = pa.RecordBatch.from_arrays(arrays, names=["row", "n_words", "spans", "items"])
                yield finish(out, shared) if finish else out

    return arrow_map(now, work, StructType(schema.fields[:1]) if finish else schema)


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", window: int = 10, block_words: int = 200_000) -> DataFrame:
    """(id_col, n_words, spans, items): words of each row, ranges of hit words (end exclusive), ids of occurring items as strings.

    A null or empty text has no words and no hits; so has a null or empty item. Items without an id are left out, repeated
    ones count once. Rows of docs are kept one to one, repeated or with a null id; an empty table gives an empty one.
    Other columns aren't read.
    """
    found = _found(docs, list(dict.fromkeys([id_col, text_col])), automata(items, item_id_col, item_text_col, window, block_words), text_col)
    return found.select(F.col(f"row.`{id_col}`").alias(id_col), "n_words", "spans", "items")


def cleaned(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", window: int = 10, max_coverage: float = 0.5, block_words: int = 200_000) -> DataFrame:
    """The rows of docs, with their columns, without the hit spans in their texts; rows of which more than max_coverage of the words are hit go. What a cut brings together is scanned again until nothing is hit. n_chars, where there is one, is counted again. Null and empty texts stay as they are."""
    names = docs.columns
    at = names.index(text_col)

    def finish(b: pa.RecordBatch, shared: Automata) -> pa.RecordBatch:
        rows, spans = b.column(0), b.column(2).to_pylist()
        fields = rows.flatten()
        texts = fields[at].cast(pa.binary()).to_pylist()
        hit = [sum(s["end"] - s["start"] for s in x) for x in spans]
        keep = [h <= max_coverage * n for h, n in zip(hit, b.column(1).to_pylist(), strict=True)]
        if any(hit):
            texts = [cut(t, [(s["start"], s["end"]) for s in x]) if x else t for t, x in zip(texts, spans, strict=True)]
            again = [k for k, x in enumerate(spans) if x]
            while again:
                found = shared.scan([texts[k] for k in again])
                hits = {k: x for k, (_, x, _) in zip(again, found, strict=True) if x}
                again = list(hits)
                for k in again:
                    texts[k] = cut(texts[k], hits[k])
            fields[at] = pa.array([None if t is None else t.decode() for t in texts], pa.string())
            if "n_chars" in names:
                k = names.index("n_chars")
                fields[k] = pa.array([len(t.decode()) if x else n for t, x, n in zip(texts, spans, fields[k].to_pylist(), strict=True)], fields[k].type)
        row = pa.StructArray.from_arrays(fields, fields=list(rows.type))
        return pa.RecordBatch.from_arrays([row], names=["row"]).filter(pa.array(keep, pa.bool_()))

    return columns_of(_found(docs, names, automata(items, item_id_col, item_text_col, window, block_words), text_col, finish), names)
