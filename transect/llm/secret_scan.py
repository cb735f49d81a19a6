"""Secret scans over a trigram inverted index, in DataFrame functions only.

Each rule's regex is parsed on the driver into a Boolean query over the trigrams that any match must hold. One pass writes
the postings (trigram, id) of just those trigrams to the shared folder. A rule's candidates are the ids whose postings,
intersected and united as its query says, satisfy it; only there is the regex run. Rules without a mandatory trigram run
on every text. Trigrams are taken from lower-cased text, which can only add candidates.
"""

from __future__ import annotations

import re._constants as K
import re._parser as parser
from dataclasses import dataclass
from functools import reduce
from itertools import product
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transect.llm.common import stored, workspace


@dataclass(frozen=True)
class Rule:
    """A regex (syntax common to Java and RE2); a match counts if its group has `least` characters or more."""

    kind: str
    regex: str
    group: int = 0
    least: int = 1


#: The base kinds in their order, then the kinds added.
RULES = (
    Rule("assign", r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]+", 0, 16),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("google", r"AIza[0-9A-Za-z_-]+", 0, 39),
    Rule("stripe", r"sk_live_[0-9a-zA-Z]+", 0, 24),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
)

#: Most strings that a part of a regex may stand for before it counts as unknown.
MOST_STRINGS = 64
#: Items of an array that are run through one by one when sums are carried along it.
BLOCK = 128
SPANS = "array<struct<start:int,order:int,end:int,kind:string,low:int,high:int>>"


def _all(parts: list):
    parts = [p for p in parts if p is not True]
    flat = [x for p in parts for x in (p[1] if isinstance(p, tuple) and p[0] == "and" else [p])]
    return ("and", list(dict.fromkeys(map(_frozen, flat)))) if flat else True


def _any(parts: list):
    return True if any(p is True for p in parts) else ("or", list(dict.fromkeys(map(_frozen, parts)))) if len(parts) > 1 else parts[0]


def _frozen(q):
    return (q[0], tuple(q[1])) if isinstance(q, tuple) else q


def _of_strings(strings: set[str]):
    """What holds where one of these strings stands: for any of them, all its trigrams."""
    return _any([_all(sorted({s[i : i + 3] for i in range(len(s) - 2)})) if len(s) > 2 else True for s in sorted(strings)])


def _strings(op, arg) -> set[str] | None:
    """All strings, lower-cased, that a node stands for, if they are few."""
    if op is K.LITERAL:
        return {chr(arg).lower()}
    if op is K.IN and all(x[0] in (K.LITERAL, K.RANGE) for x in arg):
        chars = {chr(c).lower() for x in arg for c in ([x[1]] if x[0] is K.LITERAL else range(x[1][0], x[1][1] + 1))}
        return chars if len(chars) <= 8 else None
    if op is K.AT:
        return {""}
    if op is K.SUBPATTERN:
        return _sequence_strings(arg[3])
    if op is K.BRANCH:
        each = [_sequence_strings(x) for x in arg[1]]
        return None if None in each else set().union(*each)
    if op in (K.MAX_REPEAT, K.MIN_REPEAT) and arg[0] == arg[1] <= 8 or op is K.MAX_REPEAT and (arg[0], arg[1]) == (0, 1) and arg[2][0][0] is K.LITERAL:
        inner = _sequence_strings(arg[2])
        if inner is not None:
            return {"".join(x) for n in range(arg[0], arg[1] + 1) for x in product(inner, repeat=n)} if len(inner) ** max(1, arg[1]) <= MOST_STRINGS else None
    return None


def _sequence_strings(nodes) -> set[str] | None:
    out = {""}
    for op, arg in nodes:
        more = _strings(op, arg)
        if more is None or len(out) * len(more) > MOST_STRINGS:
            return None
        out = {a + b for a in out for b in more}
    return out


def _query(nodes):
    parts, run = [], {""}
    for op, arg in nodes:
        more = _strings(op, arg)
        if more is not None and len(run) * len(more) <= MOST_STRINGS:
            run = {a + b for a in run for b in more}
            continue
        parts.append(_of_strings(run))
        run = more if more is not None else {""}
        if more is None:
            if op is K.SUBPATTERN:
                parts.append(_query(arg[3]))
            elif op is K.BRANCH:
                parts.append(_any([_query(x) for x in arg[1]]))
            elif op in (K.MAX_REPEAT, K.MIN_REPEAT) and arg[0] > 0:
                parts.append(_query(arg[2]))
    return _all([*parts, _of_strings(run)])


def trigram_query(regex: str):
    """The Boolean query of a regex: True (nothing is mandatory), a trigram, or ("and" | "or", queries)."""
    return _query(parser.parse(regex))


def _trigrams(q) -> set[str]:
    return set() if q is True else {q} if isinstance(q, str) else set().union(*map(_trigrams, q[1]))


def _any_of(trigrams: list[str]) -> str:
    """A regex whose group 1 is the trigram at a position, if it is one of these. Classes of characters, then groups of first characters, turn most positions down at once, so the cost of a position hardly follows the number of trigrams."""

    def plain(c: str) -> str:
        return c if c.isalnum() else "\\" + c

    def one_of(chars) -> str:
        return "[" + "".join(map(plain, sorted(set(chars)))) + "]"

    tree: dict[str, dict[str, list[str]]] = {}
    for a, b, c in sorted(trigrams):
        tree.setdefault(a, {}).setdefault(b, []).append(c)
    first = list(tree)
    each = {a: f"{plain(a)}(?:{'|'.join(plain(b) + one_of(cs) for b, cs in under.items())})" for a, under in tree.items()}
    groups = [first[k : k + 5] for k in range(0, len(first), 5)]
    some = "".join(one_of(t[k] for t in trigrams) for k in range(3))
    return f"(?={some})(?=(" + "|".join(f"(?={one_of(g)})(?:{'|'.join(each[a] for a in g)})" for g in groups) + "))"


def postings(docs: DataFrame, trigrams: list[str], id_col: str, text_col: str) -> DataFrame:
    """(trigram, id): the inverted index of docs for these trigrams of lower-cased text, found in one pass over each text; null ids left out."""
    present = F.array_distinct(F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(_any_of(trigrams)), F.lit(1)))
    return docs.filter(F.col(id_col).isNotNull()).select(F.explode(present).alias("trigram"), F.col(id_col).alias("id"))


def _holds(q, has) -> Column:
    """Whether the postings of a text satisfy a query; has gives the column that tells of a trigram whether it is there."""
    if isinstance(q, str):
        return has(q)
    parts = [_holds(x, has) for x in q[1]]
    return reduce(and_ if q[0] == "and" else or_, parts)


def candidates(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, set[int]]:
    """((id, rules array<int>), numbers of the rules that have a query): ids of which some rule's query holds, and the numbers of those rules. Neither rules nor trigrams have a limit."""
    asked = {k: q for k, r in enumerate(rules) if (q := trigram_query(r.regex)) is not True}
    trigrams = sorted(set().union(*map(_trigrams, asked.values())))
    if not asked:
        return docs.select(F.col(id_col).alias("id"), F.array().cast("array<int>").alias("rules")).limit(0), set()
    at = workspace(docs.sparkSession, "trigrams")
    index = stored(postings(docs, trigrams, id_col, text_col), f"{at}/postings")
    number = F.create_map(*[x for k, t in enumerate(trigrams) for x in (F.lit(t), F.lit(k))])[F.col("trigram")]
    # One bit for each trigram, 62 to a word.
    words = range(0, len(trigrams), 62)
    bit = F.expr("shiftleft(1L, number % 62)")
    masks = index.select("id", number.alias("number")).groupBy("id").agg(*[F.bit_or(F.when(F.expr("number div 62 * 62") == w, bit).otherwise(F.lit(0).cast("bigint"))).alias(f"m{w}") for w in words])

    def has(t: str) -> Column:
        k = trigrams.index(t)
        return F.col(f"m{k // 62 * 62}").bitwiseAND(F.lit(1 << k % 62)) != 0

    met = F.filter(F.array(*[F.when(_holds(q, has), F.lit(k)) for k, q in asked.items()]), lambda k: k.isNotNull())
    return stored(masks.select("id", met.alias("rules")).filter(F.size("rules") > 0), f"{at}/candidates"), set(asked)


def _let(value: Column, use) -> Column:
    """use(value), with value computed once however often use names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _blocks(items: Column) -> Column:
    """The items of an array in arrays of BLOCK of them."""
    last = F.floor(F.greatest(F.size(items) - 1, F.lit(0)) / BLOCK).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(items, b * BLOCK + 1, BLOCK))


def _before(values: Column, zero: Column, join, levels: int = 3) -> Column:
    """For each item of an array, join over all items before it (zero for the first).

    Blocks of BLOCK items are run through one by one; what lies before a block comes from the same over the blocks' totals.
    With three levels the work is in proportion to the items up to some millions, and no array grows item by item beyond a block.
    """

    def step(acc, v):
        return F.struct(join(acc["now"], v).alias("now"), F.concat(acc["out"], F.array(acc["now"])).alias("out"))

    def through(block, start):
        return F.aggregate(block, F.struct(start.alias("now"), F.slice(F.array(start), 1, 0).alias("out")), step, lambda acc: acc["out"])

    def joined(blocks):
        return _let(F.transform(blocks, lambda b: F.aggregate(b, zero, join)), lambda totals: F.flatten(F.zip_with(blocks, _before(totals, zero, join, levels - 1), through)))

    return through(values, zero) if levels == 1 else _let(_let(values, _blocks), joined)


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """SPANS of the rule's matches: leftmost, non-overlapping, failing ones dropped; code points and bytes, ends exclusive.

    The text between the matches and the matches themselves, in turn, give the positions: first inside blocks of them, then
    each block's spans are moved to where it begins.
    """
    regex, none = F.lit(rule.regex), F.array().cast(SPANS)
    whole = F.regexp_extract_all(text, regex, F.lit(0))
    checked = F.regexp_extract_all(text, regex, F.lit(rule.group)) if rule.group else whole
    parts = F.arrays_zip(F.split(text, rule.regex, -1).alias("gap"), whole.alias("whole"), checked.alias("checked"))

    def at(chars, bytes):
        return chars.alias("chars"), bytes.alias("bytes")

    def span(start, end, low, high):
        return F.struct(start.alias("start"), F.lit(order).alias("order"), end.alias("end"), F.lit(rule.kind).alias("kind"), low.alias("low"), high.alias("high"))

    def step(acc, p):
        start, low = acc["chars"] + F.length(p["gap"]), acc["bytes"] + F.octet_length(p["gap"])
        end, high = start + F.coalesce(F.length(p["whole"]), F.lit(0)), low + F.coalesce(F.octet_length(p["whole"]), F.lit(0))
        good = F.coalesce(F.length(p["checked"]) >= rule.least, F.lit(False))
        return F.struct(*at(end, high), F.when(good, F.concat(acc["out"], F.array(span(start, end, low, high)))).otherwise(acc["out"]).alias("out"))

    def moved(run, base):
        return F.transform(run["out"], lambda s: span(s["start"] + base["chars"], s["end"] + base["chars"], s["low"] + base["bytes"], s["high"] + base["bytes"]))

    def placed(runs):
        sizes = F.transform(runs, lambda r: F.struct(*at(r["chars"], r["bytes"])))
        return F.flatten(F.zip_with(runs, _before(sizes, F.struct(*at(F.lit(0), F.lit(0))), lambda a, b: F.struct(*at(a["chars"] + b["chars"], a["bytes"] + b["bytes"])), 2), moved))

    runs = F.transform(_let(parts, _blocks), lambda block: F.aggregate(block, F.struct(*at(F.lit(0), F.lit(0)), none.alias("out")), step))
    # A text without a long enough match costs one search.
    return F.when(text.rlike(with_least(rule)), _let(runs, placed)).otherwise(none)


def with_least(rule: Rule) -> str:
    """A regex that finds something in every text in which the rule has a match that counts: the rule's, and where it is a part of fixed length and then a repeated character, that many of them."""
    nodes = list(parser.parse(rule.regex))
    low, high = parser.parse(rule.regex[:-1]).getwidth() if rule.regex.endswith("+") else (0, 1)
    if rule.group or low != high or nodes[-1][0] is not K.MAX_REPEAT or nodes[-1][1][2].getwidth() != (1, 1):
        return rule.regex
    return f"{rule.regex[:-1]}{{{max(1, rule.least - low + 1)}}}"


def _scanned(docs: DataFrame, rules, id_col: str, text_col: str) -> DataFrame:
    """(row struct of docs, spans SPANS): the rows of docs with the spans of all rules, by start, then kind as listed."""
    found, asked = candidates(docs, rules, id_col, text_col)
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    one = row.schema["row"].dataType[id_col].dataType
    joined = row.join(found.select(F.col("id").cast(one), "rules"), F.col(f"row.`{id_col}`") == F.col("id"), "left")
    unknown, text = F.col(f"row.`{id_col}`").isNull(), F.coalesce(F.col(f"row.`{text_col}`"), F.lit(""))
    spans = []
    for k, rule in enumerate(rules):
        got = _spans(text, rule, k)
        spans.append(F.when(unknown | F.coalesce(F.array_contains("rules", k), F.lit(False)), got).otherwise(F.array().cast(SPANS)) if k in asked else got)
    return joined.select("row", F.array_sort(F.concat(*spans)).alias("spans"))


def scan(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, spans array<struct<start, order, end, kind>>), one row for each row of docs.

    A null text is empty. Rows with a null id can't be in the index and are scanned fully; rows that repeat an id share
    its candidates, which each row's text then decides. An empty table gives an empty one. Other columns aren't read.
    A text with very many matches takes time in proportion to them.
    """
    few = docs.select(*dict.fromkeys([id_col, text_col]))
    return _scanned(few, rules, id_col, text_col).select(F.col(f"row.`{id_col}`").alias(id_col), F.transform("spans", lambda s: s.dropFields("low", "high")).alias("spans"))


def redacted(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The rows of docs, with their columns, every span in their texts replaced by `mark` (overlapping ones by one). n_chars, where there is one, is counted again."""
    found = _scanned(docs, rules, id_col, text_col)
    text = F.col(f"row.`{text_col}`")

    def pieces(raw):
        """What is kept, in bytes, before each span that no span before it reaches, and its mark; then the rest."""

        def piece(s, reached):
            return F.when(s["low"] >= reached, F.concat(F.substring(raw, reached + 1, s["low"] - reached).cast("string"), F.lit(mark))).otherwise(F.lit(""))

        reached = _before(F.transform("spans", lambda s: s["high"]), F.lit(0), lambda a, b: F.greatest(a, b))
        last = F.array_max(F.transform("spans", lambda s: s["high"]))
        rest = F.substring(raw, last + 1, F.greatest(F.octet_length(raw) - last, F.lit(0))).cast("string")
        return F.concat(F.array_join(F.zip_with("spans", reached, piece), ""), rest)

    found = found.select("row", F.when(F.size("spans") > 0, _let(text.cast("binary"), pieces)).alias("clean"))
    out = []
    for f in docs.schema:
        column = F.col(f"row.`{f.name}`")
        if f.name == text_col:
            column = F.coalesce("clean", column)
        elif f.name == "n_chars":
            column = F.coalesce(F.length("clean").cast(f.dataType), column)
        out.append(column.alias(f.name))
    return found.select(*out)


def _duck(rules=RULES) -> str:
    """DuckDB SQL for (doc_id, k, spans): k a row number, spans a list of {start, order, end, kind}."""
    each = []
    for k, r in enumerate(rules):
        regex = r.regex.replace("'", "''")
        each.append(
            f"SELECT k, {k} AS o, '{r.kind}' AS kind, CAST(list_sum(list_transform(gaps[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(whole[1:i - 1], lambda x: len(x))), 0) AS BIGINT) AS s, len(whole[i]) AS n "
            f"FROM (SELECT *, unnest(range(1, len(whole) + 1)) AS i FROM (SELECT k, regexp_split_to_array(t, '{regex}') AS gaps, regexp_extract_all(t, '{regex}') AS whole, regexp_extract_all(t, '{regex}', {r.group}) AS checked FROM doc)) WHERE len(checked[i]) >= {r.least}"
        )
    base = [r.kind for r in rules[:3]]
    listed = "string_agg(kind || ':' || s || ':' || (s + n), ',' ORDER BY s, o, n)"
    return (
        "WITH doc AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS k FROM documents), span AS (" + " UNION ALL ".join(each) + ") "
        "SELECT any_value(doc_id) AS doc_id, " + ", ".join(f"count(*) FILTER (kind = '{b}') AS n_{b}" for b in base) + f", sha256(coalesce({listed} FILTER (o < 3), '')) AS base_sha256, coalesce({listed}, '') AS spans FROM doc LEFT JOIN span USING (k) GROUP BY k"
    )


SQL = _duck()
