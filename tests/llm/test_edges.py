"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names, for every operator and stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from transect.llm import chat, decontaminate, langid, lm, mixing, pii, quality, secret_scan, simhash, token_counts
from transect.llm.catalog import remainder

#: Names that the operators use for columns of their own.
CLASHING = ["id", "fp", "rules", "row", "spans", "items", "size", "target", "kept", "rank", "start", "__fp", "component_id", "held_out", "at", "word", "n", "h", "tie", "chunk", "block", "clean", "a.b"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)
EXTRA = ("z",) * len(CLASHING)
ITEM = "one two three four five six seven eight nine ten eleven"
LONG = " ".join(f"word{k % 997} {k}" for k in range(60_000))


def rows():
    text = "The quick brown fox jumps over the lazy dog near the river bank, and then it goes home to sleep well. " * 2
    base = [
        (1, text, "en", "a", 10), (1, text, "en", "a", 10), (2, text, "en", "b", None), (3, None, None, None, None), (4, "", "en", "a", 0), (None, text + " und", "de", None, 5), (None, None, None, None, None),
        (5, LONG, "de", "b", 7), (6, f"intro {ITEM} outro secret = abcdefghijklmnop a@b.cd " + text, "en", "b", 3), (7, "\n \t ", "fr", "c", 3), (8, "!!! ???", "fr", "c", 3), (9, "é" * 5000, "fr", "c", 3), (10, "x", None, "", 1),
    ]
    return [(*r, *EXTRA) for r in base]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 0), (6, 1, 1), (6, 1, 1), (5, None, None), (None, 1, 0), (9, 7, 0)], "doc_id long, quality int, toxic int")


def benchmark(spark):
    return spark.createDataFrame([(1, ITEM.upper()), (1, ITEM.upper()), (2, None), (3, ""), (None, "the lazy dog"), (4, "lazy dog near")], "item_id long, text string")


def test_quality(spark, docs, empty):
    forest = quality.fit(docs, labels(spark))
    got = quality.judged(docs, forest).collect()
    assert len(got) == 13 and all(r.base_failed and not r.kept for r in got if r.n_words < 20)
    assert quality.filtered(docs, forest).columns == docs.columns
    assert quality.filtered(docs, forest).filter("doc_id = 5").count() == [r.kept for r in got if r.doc_id == 5].count(True)
    assert quality.judged(empty, quality.fit(empty, labels(spark).limit(0))).count() == 0
    assert quality.filtered(empty, forest).count() == 0


def test_decontaminate(spark, docs, empty):
    got = {r.doc_id: r for r in decontaminate.matches(docs, benchmark(spark)).filter("doc_id IS NOT NULL").collect()}
    assert got[6]["items"] == ["1", "4"] and got[1]["items"] == ["4"] and got[3].n_words == 0 and got[5].n_words == 120_000
    clean = decontaminate.cleaned(docs, benchmark(spark))
    assert clean.columns == docs.columns and clean.count() == 13
    assert not decontaminate.matches(clean, benchmark(spark)).filter("size(items) > 0").count()
    one = clean.filter("doc_id = 6").first()
    assert one.text.startswith("intro  outro") and one.n_chars == len(one.text)
    blocks = decontaminate.matches(docs, benchmark(spark), block_words=5).filter("doc_id = 6").first()
    assert blocks["items"] == ["1", "4"] and blocks.spans == got[6].spans
    assert decontaminate.matches(empty, benchmark(spark)).count() == 0
    assert decontaminate.matches(docs, benchmark(spark).limit(0)).filter("size(spans) > 0").count() == 0
    assert decontaminate.cleaned(empty, benchmark(spark)).count() == 0


def test_simhash(docs, empty):
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == 13 and {r.component_id for r in got if r.doc_id in (1, 2)} == {1}
    assert {r.component_id for r in got if r.fp == 0} == {3}  # null, empty and blank texts; null ids join them
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    # Of the null ids one has the text of 1 and a word more, few bits away, and one has no text, like 3, 4 and 7.
    assert (simhash.fingerprint(rows()[0][1].encode()) ^ simhash.fingerprint(rows()[5][1].encode())).bit_count() <= 3
    assert sorted(ids) == [1, 3, 5, 6, 8, 9, 10]
    assert simhash.near_duplicates(empty).count() == 0 and simhash.deduplicated(empty).count() == 0


def test_each_component_keeps_one_row(spark):
    """Ids that stand on different texts, and null ids: of each text one row stays, that of the least id."""
    a, b, c, d, e, f = (" ".join(f"{x}{k * k % 101}" for k in range(60)) for x in "abcdef")
    rows = [(1, a, "x"), (2, a, "x"), (2, b, "x"), (3, b, "x"), (3, c, "x"), (1, c, "x"), (1, d, "x"), (4, d, "x"), (4, e, "x"), (4, e, "x"), (None, f, "x"), (None, f, "x"), (None, f, "x"), (None, a, "x"), (None, None, "x"), (None, "", "x"), (5, None, "x"), (None, "alone", "x")]
    kept = simhash.deduplicated(spark.createDataFrame(rows, "doc_id long, text string, key string").repartition(4))
    assert kept.columns == ["doc_id", "text", "key"]
    want = [(1, a), (2, b), (1, c), (1, d), (4, e), (None, f), (5, None), (None, "alone")]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(want, key=repr)
    long = " ".join(f"w{k}" for k in range(3000))
    assert 0 < (simhash.fingerprint(long.encode()) ^ simhash.fingerprint(f"{long} {a}".encode())).bit_count() <= 3
    nulls = simhash.deduplicated(spark.createDataFrame([(None, t, "x") for t in (long, long, b, f"{long} {a}", None, "")], "doc_id long, text string, key string"))
    texts = [r.text for r in nulls.collect()]
    assert len(texts) == 3 and b in texts and (long in texts) + (f"{long} {a}" in texts) == 1


def test_secrets(docs, empty):
    got = {r.doc_id: r.spans for r in secret_scan.scan(docs).filter("doc_id IS NOT NULL").collect()}
    assert [s.kind for s in got[6]] == ["assign"] and got[3] == [] and got[4] == []
    clean = secret_scan.redacted(docs)
    assert clean.columns == docs.columns and clean.count() == 13
    one = clean.filter("doc_id = 6").first()
    assert "abcdefghijklmnop" not in one.text and "[SECRET]" in one.text and one.n_chars == len(one.text)
    assert clean.filter("doc_id = 3").first().text is None
    assert secret_scan.scan(empty).count() == 0 and secret_scan.redacted(empty).count() == 0


def test_mixing(docs, empty):
    mix = mixing.Mix(docs)
    got = mix.documents().collect()
    assert len(got) == 13 and all(0 <= r.taken <= 2 * r.size for r in got) and [s.name for s in mix.sources][-1] is None
    blocks = mix.blocks().collect()
    assert sum(r.n_words for r in blocks) == sum(r.taken for r in got)
    none = mixing.Mix(empty)
    assert none.documents().count() == 0 and none.blocks().count() == 0


def test_langid(docs, empty):
    model = langid.train(docs)
    got = {r.doc_id: r for r in langid.predicted(docs, model, ["doc_id", "held_out"]).collect()}
    assert got[3].lang_pred == got[4].lang_pred == got[7].lang_pred == got[8].lang_pred == "und" and got[1].lang_pred == "en" and got[9].lang_pred == "fr"
    assert all(0 <= r.score <= 1 for r in got.values())
    none = langid.train(empty)
    assert {r.lang_pred for r in langid.predicted(docs, none, ["doc_id"]).collect()} == {"und"} and langid.predicted(empty, model, ["doc_id"]).count() == 0


def test_lm(docs, empty):
    model = lm.train(docs)
    got = lm.scored(docs, model, ["doc_id", "at"]).collect()
    assert len(got) == 13 and {r.n_tokens for r in got if r.doc_id in (3, 4)} == {1} and all(r.score < 0 for r in got)
    none = lm.train(empty)
    flat = lm.scored(docs, none, ["doc_id"]).collect()
    assert all(r.n_known == 0 and r.base_score == 0 for r in flat) and lm.scored(empty, model, ["doc_id"]).count() == 0


def test_pii(docs, empty):
    tagger = pii.train(docs)
    got = {r.doc_id: r.spans for r in pii.detected(docs, tagger).filter("doc_id IS NOT NULL").collect()}
    assert [s.kind for s in got[6] if s.base] == [0] and got[3] == [] and got[9] == []
    assert pii.detected(empty, tagger).count() == 0
    assert pii.train(empty) is not None


def test_token_counts(docs, empty):
    got = token_counts.counted(docs, block_tokens=1000).collect()
    encode = token_counts.Tokenizer(open(token_counts.RANKS, "rb").read())
    assert sorted(r.n_tokens for r in got) == sorted(len(encode(r[1] or "")) for r in rows())
    assert token_counts.counted(empty).count() == 0


def test_chat(spark):
    turns = spark.createDataFrame([(1, 0, "user", "hi"), (1, 0, "user", "hi"), (1, None, "assistant", None), (None, 1, None, "x"), (2, 1, "assistant", "### </turn> \\"), (2, 0, "a: b", "")], "conv_id long, turn int, role string, text string")
    turns = turns.withColumn("spans", F.lit("x")).withColumn("id", F.lit(1))
    got = {r.conv_id: r for r in chat.digests(chat.formatted(turns)).collect()}
    assert (got[1].n_turns, got[2].n_turns, got[None].n_turns) == (3, 2, 1) and got[2].loss_chars == 13 and got[1].loss_chars == 0
    assert chat.digests(chat.formatted(turns.limit(0))).count() == 0


@pytest.mark.parametrize("k", range(5))
def test_stages(spark, docs, empty, tmp_path, k):
    labels(spark).write.parquet(str(tmp_path / "labels.parquet"))
    benchmark(spark).write.parquet(str(tmp_path / "benchmark.parquet"))
    name, stage = corpus_pipeline.STAGES[k]
    for table in (docs, empty):
        out = stage(spark, table, str(tmp_path))
        out.write.parquet(str(tmp_path / f"out{table is docs}"))
        assert k == 4 or out.columns == docs.columns, name


def test_held_out_rows(docs):
    got = docs.select("doc_id", remainder().alias("r")).collect()
    import zlib

    assert all(r.r == zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 5 for r in got)
