"""Fill-in-the-middle rewriting of documents: two cuts at token borders, then prefix, suffix and middle in another order.

One NumPy kernel works on the UTF-8 buffer of a whole Arrow batch. A table of byte classes tells letters, other first bytes
and continuation bytes apart; comparing each class with the one before it marks where a token begins (a run of ASCII
letters, or any other code point); a running sum of the marks, less its value at a document's first byte, numbers the
tokens of every document; and one search in that sum finds the cuts of all rows together. Which rows are rewritten, how,
and where they are cut follows from a hash of the row's id alone, so it doesn't depend on partitions or order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transect.llm.common import arrow_map

#: Byte classes: continuation bytes, ASCII letters, other bytes that begin a code point.
CONTINUES, LETTER, OTHER = 0, 1, 2
CLASSES = np.full(256, OTHER, np.uint8)
CLASSES[0x80:0xC0] = CONTINUES
CLASSES[ord("A") : ord("Z") + 1] = CLASSES[ord("a") : ord("z") + 1] = LETTER

PLAIN, PSM, SPM = 0, 1, 2
FORMS = ("plain", "psm", "spm")


@dataclass(frozen=True)
class Format:
    """Marks of the three parts, the percentage of rows that are rewritten, that of the rewritten ones with the suffix first, and the seed of all draws."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    percent: int = 90
    suffix_first: int = 20
    seed: int = 1

    def __post_init__(self):
        marks = (self.prefix, self.suffix, self.middle)
        if not all(marks) or len(set(marks)) < 3 or any(a != b and b in a or any(a[-k:] == b[:k] for k in range(1, len(b))) for a in marks for b in marks):
            raise ValueError("the marks must differ, none may be part of another, and none may begin as another or itself ends")


@dataclass
class Cuts:
    """Of each document: its tokens, the bytes at which the middle begins and ends, and the code points of prefix and middle."""

    n: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    prefix_chars: np.ndarray
    middle_chars: np.ndarray


def cut(data: np.ndarray, offsets: np.ndarray, one: np.ndarray, two: np.ndarray) -> Cuts:
    """Cut all documents of a batch, data[offsets[i]:offsets[i + 1]], after one % (n + 1) and two % (n + 1) of their n tokens; the smaller is the prefix's end."""
    kind = CLASSES[data]
    marks = kind != CONTINUES
    firsts = np.zeros(len(data) + 1, np.int32)
    np.cumsum(marks, out=firsts[1:])
    marks[1:] &= (kind[1:] != LETTER) | (kind[:-1] != LETTER)
    marks[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    seen = np.zeros(len(data) + 1, np.int32)
    np.cumsum(marks, out=seen[1:])
    before = seen[offsets[:-1]].astype(np.int64)
    n = seen[offsets[1:]] - before
    units = np.sort(np.stack([one % (n + 1), two % (n + 1)]), axis=0)
    # The token with k tokens of its document before it begins just before the running sum passes k; after the last one the document ends.
    begin, end = np.minimum(np.searchsorted(seen, (before + units + 1).ravel().astype(np.int32)).reshape(2, -1) - 1, offsets[1:])
    return Cuts(n, begin, end, firsts[begin] - firsts[offsets[:-1]], firsts[end] - firsts[begin])


def holding(data: np.ndarray, offsets: np.ndarray, words: list[bytes]) -> np.ndarray:
    """Which documents contain one of the words, none of which is empty."""
    found = np.zeros(len(offsets) - 1, bool)
    for word in words:
        at = np.flatnonzero(data[: max(len(data) - len(word) + 1, 0)] == word[0])
        for k, byte in enumerate(word[1:], 1):
            at = at[data[at + k] == byte]
        row = np.searchsorted(offsets, at, "right") - 1
        found[row[at + len(word) <= offsets[row + 1]]] = True
    return found


def rewritten(texts: pa.Array, draws: np.ndarray, how: Format) -> tuple[Cuts, np.ndarray, pa.Array]:
    """Cuts, forms and outputs of the texts of one Arrow batch; draws: four numbers of each."""
    texts = texts.cast(pa.string()).fill_null("")
    _, places, held = texts.buffers()
    offsets = np.frombuffer(places, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held is not None else np.zeros(0, np.uint8)
    offsets -= offsets[0]
    marks = [m.encode() for m in (how.prefix, how.suffix, how.middle)]
    done = cut(data, offsets, draws[0], draws[1])
    plain = (offsets[1:] == offsets[:-1]) | holding(data, offsets, marks) | (draws[2] % 100 >= how.percent)
    form = np.where(plain, PLAIN, np.where(draws[3] % 100 < how.suffix_first, SPM, PSM))
    view, (p, s, m), parts = memoryview(data), marks, []
    for kind, x, a, b, y in zip(form.tolist(), offsets[:-1].tolist(), done.begin.tolist(), done.end.tolist(), offsets[1:].tolist(), strict=True):
        if kind == PLAIN:
            parts.append(view[x:y])
        elif kind == PSM:
            parts += (p, view[x:a], s, view[b:y], m, view[a:b])
        else:
            parts += (s, view[b:y], p, view[x:a], m, view[a:b])
    sizes = offsets[1:] - offsets[:-1] + np.where(plain, 0, sum(map(len, marks)))
    ends = np.concatenate([[0], np.cumsum(sizes)])
    kind, width = (pa.large_string(), np.int64) if ends[-1] >= 1 << 31 else (pa.string(), np.int32)
    return done, form, pa.Array.from_buffers(kind, len(texts), [None, pa.py_buffer(ends.astype(width)), pa.py_buffer(b"".join(parts))])


def draws_of(id: Column, seed: int) -> list[Column]:
    """Four numbers below 2 ** 32 of an id: the first 8-digit groups of the SHA-256 of seed:id; a null id counts as an empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint").alias(f"h{k + 1}") for k in range(4)]


def transformed(docs: DataFrame, how: Format = Format(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n, form, prefix_chars, middle_chars, output), one row for each row of docs; no shuffle.

    n: tokens of the text. form: plain (output is the text: it is empty, contains one of the marks, or wasn't drawn), psm
    (prefix, suffix, middle, each after its mark) or spm (suffix, prefix, middle). prefix_chars and middle_chars count code
    points and are null for plain. A null text is an empty one; of a null id the draws are those of an empty id; repeated
    rows and ids keep a row each, with the same draws; an empty table gives an empty one. Other columns aren't read. A
    worker holds one Arrow batch (4 MB), or one text where that is longer, and about ten times its bytes.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done, form, output = rewritten(b.column(1), np.stack([np.asarray(b.column(k)) for k in range(2, 6)]), how)
            cut_up = form == PLAIN
            columns = [pa.array(done.n.astype(np.int64)), pa.array(FORMS).take(pa.array(form)), *(pa.array(x.astype(np.int64), mask=cut_up) for x in (done.prefix_chars, done.middle_chars)), output]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], names=["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    few = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *draws_of(F.col(id_col), how.seed))
    kind = few.schema["id"].dataType.simpleString()
    return arrow_map(few, work, f"id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string").withColumnRenamed("id", id_col)


def restored(form: Column, output: Column, how: Format = Format()) -> Column:
    """The text that an output was made of, as an expression: no part holds a mark, so the marks tell the parts apart."""

    def between(left, right):
        inside = F.substring_index(output, right, 1) if right else output
        return F.substring_index(inside, left, -1)

    middle = between(how.middle, None)
    psm = F.concat(between(how.prefix, how.suffix), middle, between(how.suffix, how.middle))
    spm = F.concat(between(how.prefix, how.middle), middle, between(how.suffix, how.prefix))
    return F.when(form == FORMS[PSM], psm).when(form == FORMS[SPM], spm).otherwise(output)


#: DuckDB SQL of op11's rows.
SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS s, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w FROM documents),
h AS (SELECT doc_id, text, w, len(w) AS n, CAST('0x' || s[1:8] AS BIGINT) AS h1, CAST('0x' || s[9:16] AS BIGINT) AS h2, CAST('0x' || s[17:24] AS BIGINT) AS h3, CAST('0x' || s[25:32] AS BIGINT) AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, array_to_string(w[1:a], '') AS prefix, array_to_string(w[a + 1:b], '') AS middle, array_to_string(w[b + 1:], '') AS suffix FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""
