"""Models in many small files: the same scores, few files open at once, and an error for a file that is gone."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from transect.llm import common, langid, lm


def at(uri, name):
    fs, path = common.folder(uri)
    return f"{path}/{name}"


@pytest.fixture(scope="module")
def docs(spark, sf_small):
    return spark.read.parquet(f"{sf_small}/documents.parquet").limit(60).cache()


def test_scores_don_t_depend_on_ranges(spark, docs, monkeypatch):
    whole = lm.train(docs)
    monkeypatch.setattr(lm, "RANGE_BYTES", 4000)
    model = lm.train(docs)
    assert whole.ranges == 1 and model.ranges > 20 and (model.tokens, model.types, model.pairs, model.texts, model.discount, model.low_discount) == (whole.tokens, whole.types, whole.pairs, whole.texts, whole.discount, whole.low_discount)
    there = set(os.listdir(at(model.uri, "")))
    assert {f"pairs-{k}" for k in range(model.ranges) if k in model.filled} | {f"words-{k}" for k in range(model.word_ranges) if k in model.word_filled} == {n for n in there if not n.startswith(".")}
    texts = [r.text.encode() for r in docs.limit(20).collect()]
    one, few, all_open = lm.Arrays(whole), lm.Arrays(model, most=3), lm.Arrays(model)
    for a, b, c in zip(one.score(texts), few.score(texts), all_open.score(texts), strict=True):
        assert np.allclose(a, b, rtol=1e-12) and (b == c).all()
    assert len(few.files) <= 3 < len(all_open.files)
    os.remove(at(model.uri, next(n for n in all_open.files._files if n.startswith("pairs"))))
    with pytest.raises(FileNotFoundError):
        lm.Arrays(model).score(texts)
    with pytest.raises(Exception, match="FileNotFoundError"):
        lm.scored(docs, model, ["doc_id"]).collect()


def test_ranges_without_a_pair(spark):
    """More ranges than pairs: those that are empty have no file, and that is no error."""
    docs = spark.createDataFrame([(1, "a b a b"), (2, "b a")], "doc_id long, text string")
    model = lm.train(docs)
    model.ranges, model.word_ranges = 1, 1
    assert 0 in model.filled and 0 in model.word_filled
    none = lm.train(docs.limit(0))
    assert 0 not in none.filled and np.isfinite(lm.Arrays(none).score([b"a"])[3]).all()


def test_languages_don_t_depend_on_files(spark, docs, monkeypatch):
    whole = langid.train(docs)
    monkeypatch.setattr(langid, "FILE_ROWS", 700)
    model = langid.train(docs)
    assert whole.files == 1 and model.files > 10 and (model.totals, model.types) == (whole.totals, whole.types)
    texts = [r.text for r in docs.limit(20).collect()] + ["unheardof wordsalad", None]
    few, more = langid.Scorer(model), langid.Scorer(model)
    few.counts = langid.Counts(model, most=2)
    want = langid.Scorer(whole).predict(texts)
    for got in (few.predict(texts), more.predict(texts)):
        assert [g[0] for g in got] == [w[0] for w in want] and np.allclose([g[1] for g in got], [w[1] for w in want])
    assert len(few.counts.files) <= 2 < len(more.counts.files)
    os.remove(at(model.uri, next(iter(more.counts.files._files))))
    with pytest.raises(Exception, match="FileNotFoundError"):
        langid.predicted(docs.withColumn("held_out", F.lit(True)), model, ["doc_id"]).collect()


def test_files_that_are_read_are_bounded_by_bytes(tmp_path, monkeypatch):
    for k in range(6):
        (tmp_path / f"f{k}").write_bytes(bytes([k]) * 1000)
    monkeypatch.setattr(common, "mapped", lambda uri, name: np.fromfile(f"{uri}/{name}", np.uint8))
    files = common.Opened(str(tmp_path), most=100, held=2500)
    for k in [0, 1, 2, 0, 3, 4, 5, 0]:
        assert files[f"f{k}"].tolist() == [k] * 1000 and len(files) <= 2 and files.bytes_read == 1000 * len(files)
    with pytest.raises(FileNotFoundError):
        files["f9"]


def test_filled_ranges():
    some = [0, 7, 8, 63, 64]
    filled = common.Filled(65, some)
    assert [k for k in range(65) if k in filled] == some and 0 not in common.Filled(1, ())
