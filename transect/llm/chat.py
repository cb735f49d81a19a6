"""Chat formatting by incremental black-box rendering.

A template is a function from turns (role, text) to a string, and nothing more is known of it. Each prefix of a
conversation is rendered and compared with the one before: if it only adds to it, what it adds is the new turn's span; if
not, the template rewrites history, which is reported with the first position that changed. A text's place is found by
rendering the same turns with two probe texts in its stead: what they share at the front stands before it, what they share
at the end behind it. After a rewrite every turn up to it is located anew in the last rendering; a text that can't be found
there is reported. The loss mask covers the assistant texts only.

A conversation of n turns is rendered once for each prefix and twice for each text to be placed; only one with rewrites has
more renderings, two or four for each turn before the last rewrite. It is one row, as the template takes it whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transect.llm.common import Shipped, arrow_map

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

#: Fixed values of the template: what marks turns. A backslash comes before these strings, and before itself, inside texts.
HEAD, MID, TAIL = "### ", ": ", " </turn>\n"
CONTROL = r"\\|###|</turn>"
ROLE_CONTROL = CONTROL + "|:"
#: Texts that no template has to quote or escape.
PROBES = ("Q", "Z")


def escape(text: str, control: str = CONTROL) -> str:
    """text with a backslash before each control string."""
    return re.sub(f"({control})", r"\\\1", text)


def unescape(text: str, control: str = CONTROL) -> str:
    """The inverse of escape."""
    return re.sub(rf"\\({control})", r"\1", text)


def turn_template(turns: list[Turn]) -> str:
    """The registered template: every turn as HEAD role MID text TAIL, with roles and texts escaped."""
    return "".join(f"{HEAD}{escape(role, ROLE_CONTROL)}{MID}{escape(text)}{TAIL}" for role, text in turns)


def read_back(formatted: str) -> list[Turn]:
    """The turns of a formatted conversation."""
    out, at = [], 0
    token = re.compile(rf"\\(?:{ROLE_CONTROL})|###|</turn>|: ")
    while at < len(formatted):
        if not formatted.startswith(HEAD, at):
            raise ValueError(f"no turn at {at}")
        marks, want, role_end = token.finditer(formatted, at + len(HEAD)), MID, 0
        for m in marks:
            if m[0] == MID and want == MID:
                role_end, want = m.start(), "</turn>"
            elif m[0] == "</turn>" and want == "</turn>":
                text = formatted[role_end + len(MID) : m.start() - 1]
                out.append((unescape(formatted[at + len(HEAD) : role_end], ROLE_CONTROL), unescape(text)))
                at = m.start() - 1 + len(TAIL)
                break
        else:
            raise ValueError(f"no end of the turn at {at}")
    return out


@dataclass
class Rendering:
    """A formatted conversation: spans of turns and of assistant texts (code points, end exclusive), turns whose rendering changed what stood before, with where, and turns whose text can't be found in the result."""

    text: str
    spans: list[tuple[int, int]] = field(default_factory=list)
    loss: list[tuple[int, int]] = field(default_factory=list)
    rewrites: list[tuple[int, int]] = field(default_factory=list)
    lost: list[int] = field(default_factory=list)


def shared_prefix(a: str, b: str) -> int:
    """How many characters two strings share at the front."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def place(turns: list[Turn], k: int, now: str, template: Template) -> tuple[int, int] | None:
    """Where the text of turn k stands in `now`, the rendering of turns: between what is the same for both probes. Probes of one character, then of the text's length, for templates that count characters. None where neither tells."""
    role, text = turns[k]
    for size in dict.fromkeys((1, max(1, len(text)))):
        one, two = (template([*turns[:k], (role, p * size), *turns[k + 1 :]]) for p in PROBES)
        if one == two:
            return None
        head = shared_prefix(one, two)
        foot = shared_prefix(one[:head:-1] + one[head], two[:head:-1] + two[head])
        end = len(now) - foot
        if head <= end and now.startswith(one[:head]) and now.endswith(one[len(one) - foot :]):
            return head, end
    return None


def render(turns: list[Turn], template: Template = turn_template, trained_roles: tuple[str, ...] = ("assistant",)) -> Rendering:
    """Render all prefixes of a conversation and locate its turns.

    A turn's span is what it adds, a trained turn's loss span its text as rendered. If the template rewrites history at turn
    j, the turns up to j are located again in the last rendering: then their span is the place of their text alone, and a
    turn whose text isn't there or can't be placed has the span (-1, -1), no loss span, and its number in `lost`.
    """
    before, out = template([]), Rendering("")
    texts: list[tuple[int, int] | None] = []
    for k, (role, _) in enumerate(turns):
        now = template(turns[: k + 1])
        start = len(before)
        if not now.startswith(before):
            start = shared_prefix(before, now)
            out.rewrites.append((k, start))
        out.spans.append((start, len(now)))
        texts.append(place(turns[: k + 1], k, now, template) if role in trained_roles else None)
        before = now
    out.text = before
    again = out.rewrites[-1][0] + 1 if out.rewrites else 0
    for k in range(again):
        texts[k] = place(turns, k, before, template)
        out.spans[k] = texts[k] or (-1, -1)
    for k, (role, _) in enumerate(turns):
        if texts[k] is None and (k < again or role in trained_roles):
            out.lost.append(k)
        elif role in trained_roles:
            out.loss.append(texts[k])
    return out


def formatted(turns: DataFrame, template: Template = turn_template, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", trained_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(id_col, formatted, spans, loss, rewrites, lost), one row for each conversation; see Rendering.

    Rows are ordered by turn (null first), ties by role and text; repeated rows are turns of their own. A null role or text
    is empty. Rows with a null id are one conversation, like those of any other id. A long conversation is one row and is
    rendered once a turn, so its cost grows with the square of its turns. An empty table gives an empty one. Other columns aren't read.
    """
    shared = Shipped(turns.sparkSession, (template, trained_roles))
    row = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    grouped = turns.select(F.col(id_col).alias("id"), row.alias("t")).groupBy("id").agg(F.array_sort(F.collect_list("t"), _turn_order).alias("t"))
    pair = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template, trained = shared.value
        for b in batches:
            done = [render([(t["role"], t["text"]) for t in c], template, trained) for c in b.column(1).to_pylist()]
            lists = [pa.array([[{"start": x, "end": y} for x, y in getattr(r, name)] for r in done], pair) for name in ("spans", "loss", "rewrites")]
            lost = pa.array([r.lost for r in done], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r.text for r in done], pa.string()), *lists, lost], names=["id", "formatted", "spans", "loss", "rewrites", "lost"])

    kind, spans = grouped.schema["id"].dataType.simpleString(), "array<struct<start:int,end:int>>"
    return arrow_map(grouped, work, f"id {kind}, formatted string, spans {spans}, loss {spans}, rewrites {spans}, lost array<int>").withColumnRenamed("id", id_col)


def _turn_order(a, b):
    def less(x, y, then):
        return F.when(x < y, -1).when(x > y, 1).otherwise(then)

    same = less(a["role"], b["role"], less(a["text"], b["text"], F.lit(0)))
    null = F.when(a["turn"].isNull() & b["turn"].isNotNull(), -1).when(a["turn"].isNotNull() & b["turn"].isNull(), 1)
    return null.when(a["turn"] < b["turn"], -1).when(a["turn"] > b["turn"], 1).otherwise(same)


def digests(done: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(id_col, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, rewrites) as read back from formatted()'s output."""
    from hashlib import sha256

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text, loss in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                turns = read_back(text)
                trained = "".join(unescape(text[s["start"] : s["end"]]) for s in loss)
                rows.append((len(turns), sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(trained), sha256(trained.encode()).hexdigest(), len(text)))
            columns = [pa.array([r[k] for r in rows], pa.int64() if k in (0, 2, 4) else pa.string()) for k in range(5)]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns, b.column(3)], names=["id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewrites"])

    few = done.select(F.col(id_col).alias("id"), "formatted", "loss", F.size("rewrites").cast("bigint").alias("rewrites"))
    kind = few.schema["id"].dataType.simpleString()
    return arrow_map(few, work, f"id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, rewrites bigint").withColumnRenamed("id", id_col)
