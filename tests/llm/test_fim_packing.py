"""Fill-in-the-middle and packing against brute force, exact round trips, and on odd rows."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_edges import CLASHING, EXTRA, LONG, SCHEMA, rows
from tokenizers import Tokenizer

from transect.llm import catalog, fim, packing

ODD = ["", None, "abc", "ab1 cd", "é", "aéb", "日本語abc", "x <P> y", "<S", ">", "<M>", "a\nb\r\n", "\x00", "zz" * 500, "🙂a🙂", "A", " "]


def by_hand(doc_id, text, how=fim.Format()):
    """What op11 asks for, one row at a time."""
    text, w = text or "", re.findall("[A-Za-z]+|[^A-Za-z]", text or "")
    digest = hashlib.sha256(f"{how.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(w) + 1), h[1] % (len(w) + 1)))
    p, m, s = "".join(w[:a]), "".join(w[a:b]), "".join(w[b:])
    if not text or any(x in text for x in (how.prefix, how.suffix, how.middle)) or h[2] % 100 >= how.percent:
        return len(w), "plain", None, None, text
    if h[3] % 100 < how.suffix_first:
        return len(w), "spm", len(p), len(m), how.suffix + s + how.prefix + p + how.middle + m
    return len(w), "psm", len(p), len(m), how.prefix + p + how.suffix + s + how.middle + m


@pytest.fixture(scope="module")
def odd(spark):
    given = [(k, t, *EXTRA) for k, t in enumerate(ODD * 6)] + [(None, "abc def", *EXTRA), (None, None, *EXTRA), (-3, LONG, *EXTRA), (-3, LONG, *EXTRA)]
    return spark.createDataFrame(given, "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in CLASHING)).repartition(3)


@pytest.mark.parametrize("how", [fim.Format(), fim.Format("[pre]", "[suf]", "[mid]", 100, 50, 7)])
def test_fim_by_hand(odd, how):
    texts = {r.doc_id: r.text for r in odd.collect() if r.doc_id is not None}
    got = fim.transformed(odd, how).withColumn("text", fim.restored(F.col("form"), F.col("output"), how)).collect()
    assert len(got) == 6 * len(ODD) + 4 and {r.form for r in got} == {"plain", "psm", "spm"}
    for r in got:
        given = [None, "abc def"] if r.doc_id is None else [texts[r.doc_id]]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.text) in [(*by_hand(r.doc_id, t, how), t or "") for t in given]


def test_fim_on_slices_of_a_batch():
    texts = pa.array(["skipped", *ODD, "skipped"])
    draws = np.random.default_rng(3).integers(0, 1 << 32, (4, len(ODD)))
    whole = fim.rewritten(pa.array(ODD), draws, fim.Format())
    part = fim.rewritten(texts.slice(1, len(ODD)), draws, fim.Format())
    assert whole[2].to_pylist() == part[2].to_pylist() and (whole[0].begin == part[0].begin).all()
    assert fim.rewritten(pa.array([], pa.string()), np.zeros((4, 0), np.int64), fim.Format())[2].to_pylist() == []


def test_fim_marks_must_tell_parts_apart():
    for marks in (("<P>", "<P>", "<M>"), ("", "<S>", "<M>"), ("<P>", "P>x", "<M>"), ("aba", "<S>", "<M>"), ("<P>", "P", "<M>")):
        with pytest.raises(ValueError):
            fim.Format(*marks)


def test_fim_of_no_rows(spark, odd):
    assert fim.transformed(odd.limit(0)).count() == 0
    plan = fim.transformed(odd)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan


# 12


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))


@pytest.fixture(scope="module")
def words():
    with open(public_tokenizers.path(packing.VOCABULARY), encoding="utf-8") as f:
        return packing.Words(f.read())


def price(at, penalty, way, costs):
    """Cost of a chain of windows."""
    total = 0
    for i, j in zip(way, way[1:], strict=False):
        length = at[j] - at[i]
        assert 0 < length <= costs.size
        total += (0 if length in costs.free else costs.size - length) + costs.opening + penalty[j]
    return total


def test_cheapest_against_all_chains():
    rng = np.random.default_rng(5)
    for k in range(300):
        costs = packing.Costs(16, (1, 2, 4, 8, 16) if k % 2 else (), int(rng.integers(0, 4)), gap=8)
        at = np.concatenate([[0], np.cumsum(rng.integers(1, 9, rng.integers(0, 40)))])
        penalty = rng.integers(0, 12, len(at))
        best = [0] + [10**9] * (len(at) - 1)
        for j in range(1, len(at)):
            best[j] = min(best[i] + price(at, penalty, [i, j], costs) for i in range(j) if at[j] - at[i] <= costs.size)
        way = packing.cheapest(at, penalty, costs)
        assert way[0] == 0 and way[-1] == len(at) - 1 and price(at, penalty, way, costs) == best[-1]


def test_candidates_by_hand():
    costs = packing.Costs(16, (16,), gap=3)
    ends = np.zeros(5, bool)
    ends[4] = True
    ids = np.array([0, 1, 4, 0, 0, 0, 0, 0, 0, 0, 2, 0], np.uint32)
    at, fine = packing.candidates(ids, np.array([11, 12]), ends, costs, False)
    assert at.tolist() == [0, 3, 6, 9, 11, 12] and fine.tolist() == [0, costs.sentence, costs.word, costs.word, 0, 0]
    assert packing.candidates(ids, np.array([11, 12]), ends, costs, True)[0].tolist() == list(range(13))


def test_words_equal_whole_texts(words, tokenizer, sf_small):
    import pandas as pd

    texts = pd.read_parquet(f"{sf_small}/documents.parquet").text.tolist()
    texts += ["a\x0bb Hi there. <|endoftext|>x", "", None, " ́ é Ωmega ÅΣ it's 's 12 34", "\x1cfoo\u0085bar　baz \x00", "''s 'tis I'll x'Re", "a<|b", "º ª µ ² ½ × ÷ ß ÿ ŒUVRE İ", "$$$&&&''' don't.'d", "A" * 300]
    for _ in range(2):  # unknown words, then known ones
        ids, offsets = words(pa.array(texts, pa.string()))
        for k, t in enumerate(texts):
            assert ids[offsets[k] : offsets[k + 1]].tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids


def held(sequences, given, tokenizer, size=4096):
    """Check that sequences hold each row's ids once, in order and without gaps; padding as a share of the ids."""
    found, got = {}, sequences.collect()
    for s in got:
        ids, at = np.frombuffer(bytes(s.ids), "<u4"), 0
        assert 0 < len(ids) <= size
        for p in s.pieces:
            assert p.offset == at and p.length > 0
            found.setdefault(p.id, []).append((p.start, p.doc_tokens, ids[at : at + p.length]))
            at += p.length
        assert at == len(ids)
    assert len({s.sequence_id for s in got}) == len(got) and set(found) == {k for k, _ in given}
    for key in found:
        want = sorted([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for k, t in given if k == key)
        docs = []
        for start, tokens, part in sorted(found[key], key=lambda x: (x[1], x[0])) if len(want) == 1 else []:
            assert start == sum(map(len, docs)) and tokens == len(want[0])
            docs.append(part)
        if len(want) == 1:
            assert np.concatenate(docs).tolist() == want[0]
        else:
            assert sum(len(x[2]) for x in found[key]) == sum(map(len, want))
    lengths = [len(s.ids) // 4 for s in got]
    return sum(0 if x & (x - 1) == 0 else size - x for x in lengths) / max(1, sum(lengths))


def test_packed_documents(spark, sf_small, tokenizer):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    given = [(r.doc_id, r.text) for r in docs.collect()]
    sequences = packing.packed(docs).cache()
    assert held(sequences, given, tokenizer) < 0.01
    told = packing.padding(sequences).first()
    assert told.n_tokens == sum(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in given)
    # Less than half the padding of windows filled greedily with whole documents, at fewer cuts than windows of equal length.
    greedy, room = 0, 0
    for _, t in given:
        n = len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1
        if n > room:
            greedy, room = greedy + room, 4096 * -(-n // 4096)
        room -= n
    assert told.n_padding < greedy / 2 and told.n_truncated <= told.n_tokens / 4096 + 13
    # Order: documents follow each other as in the table.
    keys = [p.id for s in sequences.orderBy("sequence_id").collect() for p in s.pieces if p.start == 0]
    assert keys == [r.doc_id for r in docs.collect()]


def test_packing_in_short_stretches(spark, sf_small, tokenizer):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    given = [(r.doc_id, r.text) for r in docs.collect()]
    costs = packing.Costs(64, tuple(1 << k for k in range(7)), gap=8)
    assert held(packing.packed(docs, costs=costs, stretch=256), given, tokenizer, 64) < 0.1


def test_packing_odd_rows(spark, tokenizer):
    docs = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    given = [(r.doc_id, r.text) for r in docs.collect()]
    held(packing.packed(docs), given, tokenizer)
    assert packing.packed(docs.limit(0)).count() == 0
    none = spark.createDataFrame([(None, None), (None, "")], "doc_id long, text string").coalesce(1)
    assert [(bytes(s.ids), len(s.pieces)) for s in packing.packed(none).collect()] == [(b"\x02\0\0\0\x02\0\0\0", 2)]
    assert packing.padding(packing.packed(docs.limit(0))).first().asDict() == {"n_sequences": 0, "n_tokens": 0, "n_padding": 0, "n_truncated": 0}
    with pytest.raises(ValueError):
        packing.Costs(16, (32,))


def test_pieces_of_the_query(spark, sf_small, tokenizer):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    got = catalog.queries()["op12_packing"](spark, sf_small).collect()
    assert {r.doc_id for r in got} == set(texts)
    for r in got:
        ids = np.array([*tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 2], "<u4")
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
