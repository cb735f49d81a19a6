"""Packing of token streams into fixed windows, in order, by dynamic programming.

The texts of a partition, each ended by a separator id, are one stream. It is cut at a document's end, at a sentence's end
or, inside a longer stretch, at every GAP-th token. A window between two cuts costs its padding, a fixed amount for being
one, and a penalty for what its end truncates: nothing, a sentence's document, a sentence. The cheapest chain of windows is
found in one pass: of all windows that are filled up, the best one's start is the front of a monotone queue (the least cost
less what padding it saves, over the starts within reach); windows whose length needs no padding are looked up beside it.

No document moves: a task takes the rows of its partition as they come, so there is no shuffle, and what a worker holds is
a stretch of stream and one text. Ids of words are found once: a text is split at ASCII white space, which no token of
the tokenizer spans, an Arrow dictionary names each word of a batch once, and only those that a worker has not seen go
through the tokenizer.
"""

from __future__ import annotations

import re
from array import array
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from transect.llm.common import Shipped, arrow_map, groups

VOCABULARY = "word_bpe_49k.json"
#: What ends a sentence, as a token's last character.
ENDS = (".", "!", "?", "…")
#: Words that a worker process knows at most, bytes of one that is kept (so all take some 50 MB, rarely up to 100), tokens of stream solved at once.
KEPT_WORDS, LONGEST_KEPT, STRETCH = 1_000_000, 64, 1 << 20
#: Fixed values of the tokenizer file: its pattern for parts, here for words of lower-case Latin letters, and its letters for bytes that don't print.
PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\na-zß-öø-ÿ0-9]+|\n")
PLAIN_WORD = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
BYTES = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if not (33 <= b < 127 or 161 <= b < 173 or b > 173))}


@dataclass(frozen=True)
class Costs:
    """size: tokens of a window. free: lengths that need no padding. opening, sentence, word: what a window, a cut after a sentence and a cut inside one cost, in tokens of padding. gap: tokens without a border after which a cut is allowed."""

    size: int = 4096
    free: tuple[int, ...] = tuple(1 << k for k in range(13))
    opening: int = 8
    sentence: int = 8
    word: int = 32
    gap: int = 64

    def __post_init__(self):
        if not 0 < self.gap <= self.size or any(not 0 < x <= self.size for x in self.free):
            raise ValueError("gap and the free lengths must lie between 1 and size")


def cheapest(at: np.ndarray, penalty: np.ndarray, costs: Costs) -> list[int]:
    """Which candidates (places `at`, rising from 0, no two more than a window apart) are cut on the cheapest way from the first to the last, both included. A tie is won by the window that begins earlier, a filled one before a free one."""
    if len(at) < 2:
        return [0]
    source, target = [], []
    for length in costs.free:
        i = np.searchsorted(at, at - length)
        hit = np.flatnonzero((at >= length) & (at[i] == at - length))
        source.append(i[hit])
        target.append(hit)
    source, target = np.concatenate(source) if source else np.zeros(0, int), np.concatenate(target) if target else np.zeros(0, int)
    order = np.lexsort((source, target))
    starts, first = source[order].tolist(), np.searchsorted(target[order], np.arange(len(at) + 1)).tolist()
    size, opening, places = costs.size, costs.opening, at.tolist()
    best, back, queue = [0.0], [0], deque()
    for j, fine in enumerate(penalty.tolist()[1:], 1):
        here, key = places[j], best[-1] + places[j - 1]
        while queue and queue[-1][0] > key:
            queue.pop()
        queue.append((key, j - 1))
        while places[queue[0][1]] < here - size:
            queue.popleft()
        low, start = queue[0]
        low += size - here
        for i in starts[first[j] : first[j + 1]]:
            if best[i] < low:
                low, start = best[i], i
        best.append(low + opening + fine)
        back.append(start)
    way = [len(places) - 1]
    while way[-1]:
        way.append(back[way[-1]])
    return way[::-1]


def candidates(ids: np.ndarray, ends: np.ndarray, sentence_ends: np.ndarray, costs: Costs, final: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places where a stream may be cut and the penalty of each. ends: places after the last id of each document; sentence_ends: whether a sentence ends after an id of the vocabulary. In a final stream every place of the last window is one, so that it can be cut to lengths that need no padding."""
    fine = np.full(len(ids) + 1, -1)
    fine[1:][sentence_ends[ids]] = costs.sentence
    fine[ends] = 0
    fine[[0, len(ids)]] = 0
    borders = np.flatnonzero(fine >= 0)
    # Between two borders every gap-th place is one, too.
    steps = (np.diff(borders) - 1) // costs.gap
    inner = np.repeat(borders[:-1], steps) + costs.gap * (np.arange(steps.sum()) - np.repeat(np.cumsum(steps) - steps, steps) + 1)
    fine[inner] = costs.word
    if final:
        tail = fine[max(0, len(ids) - costs.size) :]
        tail[tail < 0] = costs.word
    at = np.flatnonzero(fine >= 0)
    return at, fine[at]


def gathered(flat: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(runs, sizes) of the runs `which` of flat, whose runs have these sizes one after the other."""
    starts, each = np.cumsum(sizes) - sizes, sizes[which]
    ends = np.cumsum(each)
    return flat[np.repeat(starts[which] - ends + each, each) + np.arange(each.sum())], each


class Known:
    """What a worker process has loaded and learned of a tokenizer file: the tokenizer, and words with their ids, end to end."""

    def __init__(self, vocabulary: str):
        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.model = self.tokenizer.model
        self.words, self.ids, self.sizes = pa.array([], pa.string()), np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def ids_of(self, part: str) -> bytes:
        """Ids of a part of a word, as the bytes of 32-bit numbers."""
        if not part.isascii():
            part = part.encode().decode("latin-1").translate(BYTES)
        return array("I", [t.id for t in self.model.tokenize(part)]).tobytes()

    def encode(self, words: list[str]) -> list[bytes]:
        """Ids of words: by the merge model if their letters are simple, else by the whole tokenizer."""
        simple = [PLAIN_WORD.fullmatch(w) is not None and "<|" not in w for w in words]
        found, now = [], []
        parts = PARTS.findall("\n".join([*compress(words, simple), ""]).lower())
        known = {p: self.ids_of(p) for p in set(parts) if p != "\n"}
        for p in parts:
            if p == "\n":
                found.append(now[0] if len(now) == 1 else b"".join(now))
                now = []
            else:
                now.append(known[p])
        others = self.tokenizer.encode_batch_fast([w for w, s in zip(words, simple, strict=True) if not s], add_special_tokens=False)
        rest, easy = iter(others), iter(found)
        return [next(easy) if s else array("I", next(rest).ids).tobytes() for s in simple]

    def look_up(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, sizes, place of each word among them) of different words; those that are new are learned. When there are too many, only these are kept."""
        at = pc.index_in(words, value_set=self.words)
        new = pc.filter(words, pc.is_null(at))
        encoded = self.encode(new.to_numpy(zero_copy_only=False).tolist())
        place = np.asarray(pc.fill_null(at, -1)).astype(np.int64)
        place[place < 0] = len(self.words) + np.arange(len(encoded))
        ids = np.concatenate([self.ids, np.frombuffer(b"".join(encoded), np.uint32)])
        sizes = np.concatenate([self.sizes, np.fromiter(map(len, encoded), np.int64, len(encoded)) // 4])
        names, kept = (pa.concat_arrays([self.words, new]), None) if len(sizes) <= KEPT_WORDS else (words, place)
        short = np.asarray(pc.less_equal(pc.binary_length(names), LONGEST_KEPT), bool)
        if kept is not None or not short.all():
            kept = np.arange(len(names)) if kept is None else kept
            self.words = names.filter(pa.array(short))
            self.ids, self.sizes = gathered(ids, sizes, kept[short])
        else:
            self.words, self.ids, self.sizes = names, ids, sizes
        return ids, sizes, place


#: The tokenizer file that this process used last, and what it knows of it; it outlives a task.
_LAST: dict[str, Known] = {}


class Words:
    """Ids of texts by a tokenizer file, word by word; equal to encoding each whole text.

    A new word of printable ASCII and Latin letters is split by the file's own pattern and its parts go to the file's merge
    model; normal form and lower case are simple for these. Any other word goes through the whole tokenizer.
    """

    def __init__(self, vocabulary: str):
        self.vocabulary = vocabulary

    def known(self) -> Known:
        if self.vocabulary not in _LAST:
            _LAST.clear()
            _LAST[self.vocabulary] = Known(self.vocabulary)
        return _LAST[self.vocabulary]

    def sentence_ends(self) -> np.ndarray:
        """Whether a token's text ends a sentence, by id."""
        tokens = self.known().tokenizer.get_vocab()
        out = np.zeros(max(tokens.values()) + 1, bool)
        for token, k in tokens.items():
            out[k] = token.removesuffix("</w>").endswith(ENDS)
        return out

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): the ids of text i are ids[offsets[i]:offsets[i + 1]]."""
        split = pc.ascii_split_whitespace(texts.cast(pa.string()).fill_null(""))
        words = split.flatten().dictionary_encode()
        ids, sizes, place = self.known().look_up(words.dictionary)
        out, each = gathered(ids, sizes, place[np.asarray(words.indices)])
        borders = np.asarray(split.offsets).astype(np.int64)
        return out, np.concatenate([[0], np.cumsum(each)])[borders - borders[0]]


class Stream:
    """The stream of one task: ids that are not yet in a window, and the documents that they are of."""

    def __init__(self, sentence_ends: np.ndarray, costs: Costs):
        self.costs, self.sentence_ends = costs, sentence_ends
        self._parts: list[np.ndarray] = []
        self._docs: deque[tuple[object, int, int, int]] = deque()  # id, tokens, place of its first id in the stream (negative if that has left), end
        self.waiting = 0

    def add(self, key: object, ids: np.ndarray) -> None:
        self._docs.append((key, len(ids), self.waiting, self.waiting + len(ids)))
        self._parts.append(ids)
        self.waiting += len(ids)

    def windows(self, final: bool) -> Iterator[tuple[np.ndarray, list[tuple[object, int, int, int, int]]]]:
        """(ids, pieces) of the windows that are settled, pieces as (id, start, length, doc_tokens, offset). Unless it is the final stretch, the last windows wait for what follows."""
        ids = np.concatenate([np.zeros(0, np.uint32), *self._parts])
        at, fine = candidates(ids, np.array([d[3] for d in self._docs], np.int64), self.sentence_ends, self.costs, final)
        cuts = at[cheapest(at, fine, self.costs)].tolist()
        if not final:
            cuts = [c for c in cuts if c <= max(0, len(ids) - 8 * self.costs.size)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            pieces, x = [], a
            while x < b:
                key, tokens, first, last = self._docs[0]
                y = min(b, last)
                pieces.append((key, x - first, y - x, tokens, x - a))
                if y == last:
                    self._docs.popleft()
                x = y
            yield ids[a:b], pieces
        left = cuts[-1]
        self._parts, self.waiting = [ids[left:].copy()], len(ids) - left
        self._docs = deque((key, tokens, first - left, last - left) for key, tokens, first, last in self._docs)


def packed(docs: DataFrame, vocabulary: str | None = None, separator: int = 2, costs: Costs = Costs(), id_col: str = "doc_id", text_col: str = "text", stretch: int = STRETCH) -> DataFrame:
    """(sequence_id, ids, pieces), one row for each sequence; no shuffle.

    ids: the sequence's token ids, little-endian unsigned 32-bit, without padding. pieces: array of (id, start, length,
    doc_tokens, offset), what it holds of which row: `length` ids from number `start` of the row's `doc_tokens`, from
    `offset` on in the sequence; offsets leave no gap. Rows stay in the order in which their partition has them, so equal
    splits of equal files give equal sequences; ids of sequences rise from task to task and leave gaps. A null or empty
    text is a separator alone; null ids and repeated rows are documents of their own; an empty table gives an empty one.
    Other columns aren't read. A worker holds about `stretch` tokens of stream, or one text where that is longer.
    """
    if vocabulary is None:
        vocabulary = public_tokenizers.path(VOCABULARY)
    with open(vocabulary, encoding="utf-8") as f:
        shared = Shipped(docs.sparkSession, Words(f.read()))
    few = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = few.schema["id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, number, rows = shared.value, TaskContext.get().partitionId() << 33, []
        stream, end, id_type = Stream(words.sentence_ends(), costs), np.array([separator], np.uint32), None

        def flushed(final: bool, least: int) -> Iterator[pa.RecordBatch]:
            nonlocal number, rows
            for ids, pieces in stream.windows(final):
                rows.append((number, ids.astype("<u4").tobytes(), pieces))
                number += 1
                if len(rows) >= least:
                    yield batch(rows)
                    rows = []
            if final and rows:
                yield batch(rows)

        def batch(rows: list) -> pa.RecordBatch:
            each = [p for r in rows for p in r[2]]
            columns = [pa.array([p[k] for p in each], pa.int64() if k else id_type) for k in range(5)]
            pieces = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(r[2]) for r in rows)]), pa.int32()), pa.StructArray.from_arrays(columns, ["id", "start", "length", "doc_tokens", "offset"]))
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()), pieces], names=["sequence_id", "ids", "pieces"])

        for b in batches:
            id_type = b.column(0).type
            keys, texts = b.column(0).to_pylist(), b.column(1)
            for i, j in groups(pc.fill_null(texts.cast(pa.binary()), b"").to_pylist()):
                ids, offsets = words(texts.slice(i, j - i))
                for k in range(j - i):
                    stream.add(keys[i + k], np.concatenate([ids[offsets[k] : offsets[k + 1]], end]))
                    if stream.waiting >= stretch + 8 * costs.size:
                        yield from flushed(False, 64)
        if id_type is not None:
            yield from flushed(True, 64)

    return arrow_map(few, work, f"sequence_id bigint, ids binary, pieces array<struct<id:{kind},start:bigint,length:bigint,doc_tokens:bigint,offset:bigint>>")


def pieces_of(sequences: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id_col, start, length, doc_tokens, sequence_id, offset, ids), one row for each piece of packed()'s sequences, with the piece's ids."""
    each = sequences.select("sequence_id", F.col("ids").alias("__ids"), F.explode("pieces").alias("p"))
    ids = F.substring("__ids", (4 * F.col("p.offset") + 1).cast("int"), (4 * F.col("p.length")).cast("int"))
    return each.select(F.col("p.id").alias(id_col), "p.start", "p.length", "p.doc_tokens", "sequence_id", "p.offset", ids.alias("ids"))


def padding(sequences: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """(n_sequences, n_tokens, n_padding, n_truncated) of packed()'s sequences: padding up to the window's size but for lengths that need none; documents cut across sequences are counted once a cut."""
    length = (F.octet_length("ids") / 4).cast("bigint")
    pad = F.when(length.isin(*costs.free), 0).otherwise(costs.size - length) if costs.free else costs.size - length
    cut = F.size(F.filter("pieces", lambda p: p["start"] + p["length"] < p["doc_tokens"]))
    return sequences.agg(F.count("*").alias("n_sequences"), F.coalesce(F.sum(length), F.lit(0)).alias("n_tokens"), F.coalesce(F.sum(pad), F.lit(0)).cast("bigint").alias("n_padding"), F.coalesce(F.sum(cut), F.lit(0)).cast("bigint").alias("n_truncated"))
