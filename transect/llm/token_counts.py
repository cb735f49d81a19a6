"""Token counts by a separator scan over flat token files that have no index.

A token file is nothing but token ids in two or four bytes each, texts one after the other, each ended by a separator id.
Files are read in blocks of equal length, wherever texts begin or end; array comparison finds a block's separators. A
prefix scan over the blocks of a file (separators so far, place of the last one) stitches texts that cross borders, and
then each text's ordinal, first token and length follow. What crosses the network is one small row for each block and
the places of separators.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from transect.llm.common import Shipped, arrow_map, as_bytes, folder, groups, spread, stored, workspace

#: The pattern that splits text before the merges of the rank file; the free id that ends a text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SEPARATOR = 50256
RANKS = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Tokens of a block, and bytes after which a task begins a new file.
BLOCK_TOKENS, FILE_BYTES = 4 << 20, 256 << 20


class Tokenizer:
    """Byte-level BPE from the bytes of a rank file, so that workers need no such file."""

    def __init__(self, ranks: bytes):
        self.ranks, self._encoding = ranks, None

    def __getstate__(self):
        return {"ranks": self.ranks, "_encoding": None}

    def __call__(self, text: str) -> list[int]:
        if self._encoding is None:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, self.ranks.splitlines())}
            self._encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        return self._encoding.encode_ordinary(text)


def write_tokens(docs: DataFrame, uri: str, ranks: str = RANKS, separator: int = SEPARATOR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the texts of docs to flat token files under `uri`; (file, ordinal, id), one row for each row of docs, says what was written where.

    A null or empty text is a separator alone. Files of attempts that failed are named by no row. Ids above two bytes'
    range make four-byte files.
    """
    with open(ranks, "rb") as f:
        shared = Shipped(docs.sparkSession, Tokenizer(f.read()))
    kind = token_type(separator)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, out, name, size, ordinal = shared.value, None, "", 0, 0
        fs, path = folder(uri)
        fs.create_dir(path, recursive=True)
        try:
            for b in batches:
                raw = as_bytes(b.column(1))
                files, ordinals = [], []
                for i, j in groups(raw):
                    if out is None or size >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        name, size, ordinal = f"{uuid.uuid4().hex}.bin", 0, 0
                        out = fs.open_output_stream(f"{path}/{name}")
                    ids: list[int] = []
                    for t in raw[i:j]:
                        if t:
                            ids += encode(t.decode())
                        ids.append(separator)
                    data = np.array(ids, kind)
                    out.write(data)
                    size += data.nbytes
                    files += [name] * (j - i)
                    ordinals += range(ordinal, ordinal + j - i)
                    ordinal += j - i
                yield pa.RecordBatch.from_arrays([pa.array(files, pa.string()), pa.array(ordinals, pa.int64()), b.column(0)], names=["file", "ordinal", "id"])
        finally:
            if out is not None:
                out.close()

    few = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return arrow_map(few, work, f"file string, ordinal bigint, id {few.schema[0].dataType.simpleString()}")


def token_type(separator: int) -> str:
    """Type of a file's ids: two bytes if the separator, the largest id, fits."""
    return "<u2" if separator < 1 << 16 else "<u4"


def separators(block: np.ndarray, separator: int, first: int) -> np.ndarray:
    """Places of the separators of a block whose first token is number `first` of its file."""
    return np.flatnonzero(block == separator) + first


def scan_tokens(files: DataFrame, uri: str, separator: int = SEPARATOR, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(file, ordinal, start, n_tokens) of each text in the token files under `uri` that column `file` names (repeated names count once).

    n_tokens leaves out the separator. An empty file has no text; tokens after the last separator are a text, too.
    """
    kind = token_type(separator)
    width = int(kind[2])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = folder(uri)
        for b in batches:
            rows = [(name, k, n) for name in b.column(0).to_pylist() for n in [fs.get_file_info(f"{path}/{name}").size // width] for k in range(-(-n // block_tokens))]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64())], names=["file", "block", "tokens"])

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = folder(uri)
        for b in batches:
            for name, block, tokens in zip(*(c.to_pylist() for c in b.columns), strict=True):
                first = block * block_tokens
                with fs.open_input_file(f"{path}/{name}") as f:
                    data = np.frombuffer(f.read_at(min(block_tokens, tokens - first) * width, first * width), kind)
                found = separators(data, separator, first)
                if first + len(data) == tokens and data[-1] != separator:
                    found = np.append(found, tokens)
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([block]), pa.array([found], pa.list_(pa.int64()))], names=["file", "block", "at"])

    spark = files.sparkSession
    plan = files.select("file").distinct().mapInArrow(blocks, "file string, block bigint, tokens bigint").repartition(spread(spark), "file", "block")
    found = stored(plan.mapInArrow(scanned, "file string, block bigint, at array<bigint>"), workspace(spark, "separators"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    stitch = found.select("file", "block", F.size("at").cast("bigint").alias("n"), F.element_at(F.when(F.size("at") > 0, F.col("at")), -1).alias("last")).select(
        "file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ordinals"), F.coalesce(F.max("last").over(before), F.lit(-1)).alias("carried")
    )
    starts = F.concat(F.array(F.col("carried") + 1), F.transform(F.slice("at", 1, F.greatest(F.size("at") - 1, F.lit(0))), lambda x: x + 1))
    texts = F.zip_with(starts, "at", lambda first, x: F.struct(first.alias("start"), (x - first).alias("n_tokens")))
    each = found.filter(F.size("at") > 0).join(stitch, ["file", "block"]).select("file", "ordinals", F.posexplode(texts).alias("place", "text"))
    return each.select("file", (F.col("ordinals") + F.col("place")).alias("ordinal"), "text.start", "text.n_tokens")


def counted(docs: DataFrame, ranks: str = RANKS, separator: int = SEPARATOR, id_col: str = "doc_id", text_col: str = "text", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(id_col, n_tokens) of each row of docs, by writing its texts to token files and scanning these.

    Null and empty texts have no tokens. Repeated rows and null ids keep their row; an empty table gives an empty one.
    Other columns aren't read.
    """
    at = workspace(docs.sparkSession, "tokens")
    written = stored(write_tokens(docs, f"{at}/files", ranks, separator, id_col, text_col), f"{at}/written")
    found = scan_tokens(written, f"{at}/files", separator, block_tokens)
    return written.join(found, ["file", "ordinal"]).select(F.col("id").alias(id_col), "n_tokens")


def totals(spark: SparkSession, uri: str, files: list[str], separator: int = SEPARATOR) -> DataFrame:
    """(file, texts, n_tokens): what the token files under `uri` hold."""
    named = spark.createDataFrame([(f,) for f in files], "file string")
    return scan_tokens(named, uri, separator).groupBy("file").agg(F.count("*").alias("texts"), F.sum("n_tokens").alias("n_tokens"))
