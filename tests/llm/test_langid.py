"""Language ID: held-out accuracy, rejection, odd rows."""

import numpy as np
import pytest

from ordermill.llm import langid
from ordermill.llm.common import table
from tests.conftest import SF_ORACLE

from .helpers import no_docs, odd_docs


def test_held_out_accuracy(spark):
    got = langid.op9_language_id(spark, SF_ORACLE).join(table(spark, SF_ORACLE, "documents").select("doc_id", "lang"), "doc_id")
    rows = got.filter("held_out").collect()
    assert len(rows) > 100
    assert np.mean([r.lang_pred == r.lang for r in rows]) >= 0.98
    assert np.mean([r.accepted for r in rows]) >= 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    model = langid.train(["the cat and the dog were here today"] * 8 + ["der hund und die katze sind heute da"] * 8, ["en"] * 8 + ["de"] * 8)
    for m in (model, None):
        rows = docs.select("doc_id", "text", langid.language(m).alias("p")).collect()
        for r in rows:
            letters = any(c.isalpha() for c in r.text or "")
            assert (r.p.lang_pred == "und") == (m is None or not letters)
            assert (r.p.score == 0.0 and not r.p.accepted) or r.p.lang_pred != "und"
    kept = langid.keep_languages(docs, model)
    assert kept.columns == docs.columns and not {1, 2, 3, 4} & {r.doc_id for r in kept.collect()}
    assert langid.fit(no_docs(spark)) is None and langid.fit(docs.filter("lang is null")) is None


@pytest.mark.parametrize("left_out", ["de", "en", "es", "fr"])
def test_left_out_language_and_noise_are_rejected(spark, left_out):
    docs = table(spark, SF_ORACLE, "documents").filter("text is not null and lang is not null")
    model = langid.fit(docs.filter(f"lang <> '{left_out}'"), learn=langid.learning_rows())
    rows = docs.filter(~langid.learning_rows()).select("text", "lang").collect()
    accepted = lambda texts: np.mean([langid.predict(model, t)[2] for t in texts])
    rng = np.random.default_rng(4)
    noise = ["".join(chr(97 + rng.integers(26)) if c.isalpha() else c for c in r.text) for r in rows]
    assert accepted(r.text for r in rows if r.lang != left_out) >= 0.98
    assert accepted(r.text for r in rows if r.lang == left_out and len(r.text) > 100) <= 0.1
    assert accepted(t for t in noise if len(t) > 100) <= 0.02


def test_one_language_and_equal_scores():
    one = langid.train(["aa bb"] * 3, ["xx"] * 3)
    assert langid.predict(one, "zz")[:2] == ("xx", 1.0)
    blank = langid.LangModel(["a", "b"], np.zeros((1 << langid.BUCKET_BITS, 3)), np.zeros((2, 3)), np.zeros(2), 1.0, 0.0)
    assert langid.predict(blank, "word") == ("a", 0.5, True)


def test_whole_text_counts():
    model = langid.train(["the cat and the dog were here"] * 20 + ["der hund und die katze sind da"] * 20, ["en"] * 20 + ["de"] * 20)
    assert langid.predict(model, "the cat " + "der hund und die katze " * 400)[0] == "de"


def test_sample_is_bounded(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "concat('word ', id) as text", "if(id % 2 = 0, 'a', 'b') as lang")
    calls = []
    real = langid.train
    langid.train = lambda texts, labels: calls.append(len(texts)) or real(texts[:10], labels[:10])
    try:
        langid.fit(docs, per_lang=50)
    finally:
        langid.train = real
    assert 50 <= calls[0] <= 200


def test_predictions_equal_a_plain_restatement(spark):
    """Bucket by bucket in plain Python: n-grams, hash, mean embedding, softmax."""
    docs = table(spark, SF_ORACLE, "documents").limit(300)
    model = langid.fit(docs, learn=langid.learning_rows())
    for r in docs.select("text", langid.language(model).alias("p")).collect():
        letters = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in (r.text or "").lower().encode())
        raw = b" " + b" ".join(w for w in letters.split(b" ") if w) + b" "
        if r.p.lang_pred == "und":
            continue
        total, n = np.zeros(langid.DIM), 0
        for size in langid.GRAMS:
            for i in range(len(raw) - size + 1):
                key = int.from_bytes(raw[i:i + size], "little")
                total += model.table[((key + size) * 2654435761 % 2 ** 32) >> (32 - langid.BUCKET_BITS)]
                n += 1
        z = (model.out @ (total / n) + model.bias) / model.temperature
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert r.p.lang_pred == model.langs[int(p.argmax())] and abs(r.p.score - p.max()) < 1e-6


def test_sample_is_bounded_in_bytes_and_labels(spark, monkeypatch):
    docs = table(spark, SF_ORACLE, "documents")
    monkeypatch.setattr(langid, "SAMPLE_BYTES", 1 << 18)
    seen = []
    monkeypatch.setattr(langid, "train", lambda texts, labels: seen.append((texts, labels)))
    langid.fit(docs)
    texts, labels = seen[0]
    assert 20 < len(texts) < 400 and len(set(labels)) == 4
    assert sum(map(len, texts)) < 2 * (1 << 18)
    monkeypatch.setattr(langid, "MAX_LANGS", 3)
    with pytest.raises(ValueError, match="3 language labels"):
        langid.fit(docs)
