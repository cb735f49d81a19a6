"""Mixing sources to target weights, over fixed-length blocks.

Each source's words, in the order of (hash chunk, id), are packed into blocks of one length; only a source's last block is
shorter. Targets share a multiple of all words by weight and stop at a multiple of their source's size. A source gives as many
whole passes over its blocks as fit its target and then so many blocks of one more pass, of which the last is cut to the
word. Output shards draw their source counts from a multinomial over what each source still owes, so that the totals come out
as targeted. A source's k-th slot is mapped to a block by a pseudorandom permutation of the numbers of its full blocks (a
keyed Feistel network, walked until it falls into range), a new one for each pass; the short block ends a pass. Slots and
blocks are joined by block number.

Positions come from sums over chunks of about `chunk_docs` rows of one source, then over chunks, so a source that holds most
of the rows is dealt out in as many more chunks, of the same size as others'. A row that is repeated more than MOST_COPIES
times has a chunk of its own, whose rows are made from its count. The driver holds one row for each source and, for slots,
one count for each source and group of SHARD_GROUP shards; executors draw the shards of a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transect.llm.common import spread, stored, workspace

#: Fixed values of the mix: weights by rank of the source, repeating; share of all words; most times a source is taken.
WEIGHTS, SHARE, MOST_TIMES = (3, 1, 2), 1.5, 2
WORD = r"[^\x20\x09-\x0D]+"
#: A word with the white space after it, so that pieces keep their lines.
WORD_AND_SPACE = WORD + r"[\x20\x09-\x0D]*"
#: Equal rows (id, source and text) that are placed one by one; shards whose counts one task draws; words in a task's share of the texts.
MOST_COPIES, SHARD_GROUP, TASK_WORDS = 10_000, 1024, 4 << 20
#: Sources whose few numbers are broadcast; more of them are joined by shuffles.
MOST_BROADCAST = 100_000


@dataclass
class Source:
    """A source: full blocks and words of the short one; slots, and words of the last slot where it is cut (else 0)."""

    name: str | None
    rank: int
    size: int
    target: float
    chunks: int
    full: int = 0
    short: int = 0
    slots: int = 0
    cut: int = 0

    def cover(self, block_words: int, most: float) -> None:
        """Lay out blocks and slots so that the words of all slots are the target, rounded."""
        self.full, self.short = divmod(self.size, block_words)
        if self.size:
            passes, rest = divmod(min(round(self.target), int(most * self.size)), self.size)
            more = -(-rest // block_words)
            self.slots = passes * self.blocks + more
            length = block_words if more <= self.full else self.short
            self.cut = (rest - (more - 1) * block_words) % length if more else 0

    @property
    def blocks(self) -> int:
        return self.full + (self.short > 0)


def targets(sizes: list[int], weights: list[float], share: float = SHARE, most: float = MOST_TIMES) -> list[float]:
    """Shares of `share` times all sizes by weight, none above `most` times its size; what is cut goes to the others by weight."""
    out, left, active = [0.0] * len(sizes), share * sum(sizes), set(range(len(sizes)))
    while active:
        weight = sum(weights[k] for k in active)
        over = {k for k in active if left * weights[k] / weight > most * sizes[k]}
        for k in over or active:
            out[k] = float(most * sizes[k]) if over else left * weights[k] / weight
        if not over:
            break
        left -= sum(out[k] for k in over)
        active -= over
    return out


def draw(slots: list[int], shard_slots: int, seed: int) -> list[tuple[int, int, int, int]]:
    """(shard, rank, first, count): how many slots of each source a shard holds, and the number of the first of them among the source's. Each shard draws from a multinomial over what is left; the last takes the rest."""
    left = np.array(slots, np.int64)
    rng, out, shard = np.random.default_rng(seed), [], 0
    while (total := int(left.sum())) > 0:
        take = np.zeros_like(left)
        need = min(shard_slots, total)
        if need == total:
            take = left.copy()
        while (more := need - int(take.sum())) > 0:
            rest = left - take
            take += np.minimum(rng.multinomial(more, rest / rest.sum()), rest)
        out += [(shard, k, slots[k] - int(left[k]), int(take[k])) for k in np.flatnonzero(take).tolist()]
        left -= take
        shard += 1
    return out


def permuted(rank: np.ndarray, n: np.ndarray, j: np.ndarray, seed: int) -> np.ndarray:
    """Where the permutation number (rank, j // n) of 0..n-1 sends j % n, for arrays of each."""
    with np.errstate(over="ignore"):
        half = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2))).astype(np.int64) + 1) // 2).astype(np.uint64)
        mask = (np.uint64(1) << half) - np.uint64(1)
        key = rank.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + (j // n).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(seed)
        x, live, out = (j % n).astype(np.uint64), np.arange(len(j)), np.empty(len(j), np.int64)
        while len(live):
            low, high = x & mask[live], x >> half[live]
            for turn in range(4):
                f = (low + key[live] + np.uint64(turn)) * np.uint64(0xBF58476D1CE4E5B9)
                f ^= f >> np.uint64(27)
                f *= np.uint64(0x94D049BB133111EB)
                low, high = high ^ (f >> np.uint64(31)) & mask[live], low
            x = high << half[live] | low
            done = x < n[live].astype(np.uint64)
            out[live[done]] = x[done].astype(np.int64)
            live, x = live[~done], x[~done]
    return out


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


class Mix:
    """The mix of a table of documents. Null sources are a source of their own, ranked last; the names of other columns don't matter."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights=WEIGHTS, share: float = SHARE, most: float = MOST_TIMES, block_words: int = 256, chunk_docs: int = 1000, shard_slots: int = 4096, seed: int = 11, most_copies: int = MOST_COPIES):
        self.spark, self.seed, self.block_words, self.shard_slots = docs.sparkSession, seed, block_words, shard_slots
        self._at = at = workspace(self.spark, "mix")
        self._rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text")).withColumn("tie", F.xxhash64("text"))
        self._sizes = stored(self._rows.select("id", "source", word_count(F.col("text")).alias("size"), "tie"), f"{at}/sizes")
        found = {r.source: (r.size, r.n) for r in self._sizes.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()}
        names = sorted(found, key=lambda s: (s is None, s or ""))
        given = targets([found[s][0] for s in names], [weights[k % len(weights)] for k in range(len(names))], share, most)
        self.sources = [Source(s, k, found[s][0], t, -(-found[s][1] // chunk_docs)) for k, (s, t) in enumerate(zip(names, given, strict=True))]
        for s in self.sources:
            s.cover(block_words, most)
        #: Partitions of a shuffle of the texts.
        self.parts = max(spread(self.spark), -(-sum(s.size for s in self.sources) // TASK_WORDS))
        alike = self._with_chunk(self._sizes.groupBy("id", "source", "size", "tie").agg(F.count("*").alias("copies")).filter(F.col("copies") > most_copies))
        own = F.col("chunks") + F.row_number().over(Window.partitionBy("rank").orderBy("id", "size", "tie")) - 1
        copied = stored(alike.withColumn("chunk", own), f"{at}/copied")
        self._copied = None if copied.isEmpty() else copied
        chunk = self._with_chunk(self._single(self._sizes)).groupBy("rank", "chunk").agg(F.sum("size").alias("words")).unionByName(copied.select("rank", "chunk", (F.col("size") * F.col("copies")).alias("words")))
        chunk = stored(chunk, f"{at}/chunks").withColumn("thousand", F.expr("chunk div 1000"))
        within = Window.partitionBy("rank", "thousand").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
        across = Window.partitionBy("rank").orderBy("thousand").rowsBetween(Window.unboundedPreceding, -1)
        thousands = chunk.groupBy("rank", "thousand").agg(F.sum("words").alias("all")).select("rank", "thousand", F.coalesce(F.sum("all").over(across), F.lit(0)).alias("base"))
        inner = chunk.withColumn("inside", F.coalesce(F.sum("words").over(within), F.lit(0)))
        self._first = stored(inner.join(thousands, ["rank", "thousand"]).select("rank", "chunk", (F.col("base") + F.col("inside")).alias("first")), f"{at}/first")

    def _plan(self) -> DataFrame:
        rows = [(s.name, s.rank, s.size, s.target, s.chunks) for s in self.sources]
        return self.spark.createDataFrame(rows, "source string, rank int, source_size bigint, target double, chunks bigint")

    def _with_chunk(self, rows: DataFrame) -> DataFrame:
        plan = self._plan().withColumnRenamed("source", "of")
        plan = F.broadcast(plan) if len(self.sources) <= MOST_BROADCAST else plan
        return rows.join(plan, F.col("source").eqNullSafe(F.col("of")), "left").withColumn("chunk", F.pmod(F.xxhash64("id", "tie"), F.col("chunks"))).drop("of")

    def _same(self, a: str, b: str) -> Column:
        return F.expr(f"{a}.id <=> {b}.id AND {a}.source <=> {b}.source AND {a}.tie <=> {b}.tie")

    def _single(self, rows: DataFrame) -> DataFrame:
        """rows but for those that have a chunk of their own."""
        return rows if self._copied is None else rows.alias("a").join(self._copied.alias("b"), self._same("a", "b"), "left_anti")

    def _placed(self, rows: DataFrame) -> DataFrame:
        """rows with `start`, the place of their first word among their source's words."""
        keyed = self._with_chunk(self._single(rows)).repartition(self.parts, "rank", "chunk")
        order = Window.partitionBy("rank", "chunk").orderBy("id", "size", "tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        inside = keyed.withColumn("inside", F.sum("size").over(order) - F.col("size"))
        if self._copied is not None:
            copied = self._copied
            if "text" in rows.columns:  # one text of each
                texts = rows.alias("a").join(copied.alias("b"), self._same("a", "b"), "left_semi").groupBy("id", "source", "tie").agg(F.first("text").alias("text"))
                copied = copied.alias("a").join(texts.alias("b"), self._same("a", "b")).select("a.*", "b.text")
            some = copied.withColumn("some", F.explode(F.expr("sequence(0L, copies - 1, 1000L)"))).repartition("rank", "chunk", "some")
            each = some.withColumn("copy", F.explode(F.expr("sequence(some, least(some + 1000, copies) - 1)"))).withColumn("inside", F.col("copy") * F.col("size"))
            inside = inside.unionByName(each.select(inside.columns))
        return inside.join(self._first, ["rank", "chunk"]).withColumn("start", F.col("first") + F.col("inside")).drop("first", "inside", "chunk", "chunks")

    def _pieces(self, placed: DataFrame, with_text: bool) -> DataFrame:
        """(rank, block, start, at, words[, id, piece]): what each row puts into each block that it touches, from word `at` of the block on."""
        length, start, size = F.lit(self.block_words), F.col("start"), F.col("size")
        numbers = F.sequence(F.expr(f"start div {self.block_words}"), F.expr(f"(start + size - 1) div {self.block_words}"))

        def piece(words=None):
            def of(b):
                low = F.greatest(start, b * length)
                high = F.least(start + size, (b + 1) * length)
                text = [] if words is None else [F.array_join(F.slice(words, (low - start + 1).cast("int"), (high - low).cast("int")), "").alias("piece")]
                return F.struct(b.alias("block"), (low - b * length).alias("at"), (high - low).alias("words"), *text)

            return F.transform(numbers, of)

        every = piece() if not with_text else F.flatten(F.transform(F.array(F.regexp_extract_all("text", F.lit(WORD_AND_SPACE), F.lit(0))), piece))
        return placed.filter("size > 0").select("rank", "start", *(["id"] if with_text else []), F.inline(every))

    def slots(self) -> DataFrame:
        """(shard, rank, slot, block, take): every slot of the mix; slot counts a source's slots; take: words from the block's begin."""
        counts = draw([s.slots for s in self.sources], self.shard_slots * SHARD_GROUP, self.seed)
        rows = pd.DataFrame(counts, columns=["shards", "rank", "first", "n"]).astype("int64")
        each = rows.groupby("shards", as_index=False)[["rank", "first", "n"]].agg(list)
        table = self.spark.createDataFrame(each, "shards bigint, rank array<bigint>, first array<bigint>, n array<bigint>").repartition(max(1, min(len(each), 1 << 14)))
        seed, shard_slots, length = self.seed, self.shard_slots, self.block_words
        full, short, slots, cut = (np.array([getattr(s, c) for s in self.sources], np.int64) for c in ("full", "short", "slots", "cut"))

        def drawn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for g in b.itertuples():
                    got = pd.DataFrame(draw(list(g.n), shard_slots, seed + 1 + g.shards), columns=["shard", "k", "more", "n"]).astype("int64")
                    k = got.k.to_numpy()
                    yield pd.DataFrame({"shard": got.shard + g.shards * SHARD_GROUP, "rank": np.array(g.rank)[k], "first": np.array(g.first)[k] + got.more, "n": got.n})

        def mapped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                r, j = b["rank"].to_numpy(), b["slot"].to_numpy()
                whole, part, every = full[r], short[r], full[r] + (short[r] > 0)
                turn, at = j // every, j % every
                inner = at < whole
                some = np.maximum(whole, 1)
                number = np.where(inner, permuted(r, some, turn * some + np.minimum(at, some - 1), seed), whole)
                yield b.assign(block=number, take=np.where((j == slots[r] - 1) & (cut[r] > 0), cut[r], np.where(inner, length, part)))

        shards = table.mapInPandas(drawn, "shard bigint, rank bigint, first bigint, n bigint").repartition(self.parts, "shard", "rank")
        each = shards.select("shard", F.col("rank").cast("int").alias("rank"), F.explode(F.sequence("first", F.expr("first + n - 1"))).alias("slot"))
        return each.mapInPandas(mapped, "shard bigint, rank int, slot bigint, block bigint, take bigint")

    def documents(self, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
        """(id_col, source_col, size, source_size, target, taken) of each row of docs: the words of it that the mix takes, repeats counted.

        Null and empty texts have no words and none is taken. Repeated rows appear again, each with words of its own; an
        empty table gives an empty one.
        """
        placed = stored(self._placed(self._sizes), f"{self._at}/placed")
        times = self.slots().groupBy("rank", "block").agg(F.collect_list("take").alias("takes"))
        words = F.aggregate("takes", F.lit(0).cast("bigint"), lambda n, take: n + F.greatest(F.least(take - F.col("at"), F.col("words")), F.lit(0)))
        taken = self._pieces(placed, False).join(times, ["rank", "block"]).groupBy("rank", "start").agg(F.sum(words).alias("taken"))
        got = placed.join(taken, ["rank", "start"], "left")
        mine = F.when(F.col("size") > 0, F.coalesce("taken", F.lit(0))).otherwise(F.lit(0)).cast("bigint")
        return got.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", mine.alias("taken"))

    def blocks(self) -> DataFrame:
        """(shard, slot, source, block, n_words, doc_ids, text): the mixed blocks themselves, one row for each slot; an empty line stands between texts.

        Texts are shuffled twice: into their chunks and into their blocks.
        """
        rows = self._rows.withColumn("size", word_count(F.col("text")))
        one = F.array_sort(F.collect_list(F.struct("at", "id", "words", "piece")))
        packed = self._pieces(self._placed(rows), True).repartition(self.parts, "rank", "block").groupBy("rank", "block").agg(one.alias("p"))
        names = self._plan().select("rank", "source")
        def front(x):
            """A piece's part of a slot: all of it, or its first words where the slot is cut."""
            room = (F.col("take") - x["at"]).cast("int")
            return F.when(x["words"] <= room, x["piece"]).otherwise(F.array_join(F.slice(F.regexp_extract_all(x["piece"], F.lit(WORD_AND_SPACE), F.lit(0)), 1, room), ""))

        kept = F.transform(F.filter("p", lambda x: x["at"] < F.col("take")), lambda x: F.struct(x["id"].alias("id"), front(x).alias("piece")))
        joined = self.slots().repartition(self.parts, "rank", "block").join(packed, ["rank", "block"]).join(F.broadcast(names) if len(self.sources) <= MOST_BROADCAST else names, "rank").withColumn("kept", kept)
        return joined.select("shard", "slot", "source", "block", F.col("take").alias("n_words"), F.col("kept.id").alias("doc_ids"), F.array_join(F.col("kept.piece"), "\n\n").alias("text"))
