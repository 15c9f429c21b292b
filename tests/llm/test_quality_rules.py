"""Quality rules against a plain restatement, and the bands."""

import random
import re
from collections import Counter

import zstandard

from ordermill.llm import quality_rules as q
from ordermill.llm.common import table
from tests.conftest import SF_SMALL

from .helpers import no_docs, odd_docs, prose


def restated(text):
    words = [m for m in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    inside = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.add(line)
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(inside), failed


def test_query_equals_restatement(spark):
    got = {r.doc_id: r for r in q.op3_quality_rules(spark, SF_SMALL).collect()}
    docs = table(spark, SF_SMALL, "documents").collect()
    assert len(got) == len(docs)
    for d in docs:
        r = got[d.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == restated(d.text)
        assert not (r.base_failed and r.kept)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    rows = docs.select("doc_id", "text", q.verdict().alias("v")).collect()
    for r in rows:
        assert (r.v.n_words, r.v.word_chars, r.v.n_symbols, r.v.n_dup_lines, r.v.n_repeat_words, r.v.base_failed) == restated(r.text)
    kept = q.keep_quality(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 5, 6, 6, 7, 10]
    assert q.keep_quality(no_docs(spark)).count() == 0


def test_bands_reject_repetition_and_noise_at_every_length():
    packer = zstandard.ZstdCompressor(level=q.LEVEL)
    inside = lambda t: q.inside_bands(len(t), *q.compression(t, packer))
    for words in (60, 200, 600, 2000, 9000):
        good = prose(words, words).encode()
        assert inside(good)
        assert not inside((good[:40] * (len(good) // 40 + 1))[:len(good)])
        assert not inside(random.Random(words).randbytes(max(1700, len(good))))
        mostly = good[:len(good) // 2] + b"the same again " * (len(good) // 30)
        assert not inside(mostly) or words <= 200
    assert inside(b"short") and inside(b"")


def test_every_byte_of_a_text_is_in_a_chunk():
    packer = zstandard.ZstdCompressor(level=q.LEVEL)
    good, noise = prose(5, 9000).encode(), random.Random(1).randbytes(2000)
    for n in (4096, 6144, 3000):
        text = good[:n]
        assert q.inside_bands(n, *q.compression(text, packer))
        assert not q.inside_bands(n + 2000, *q.compression(text + noise, packer))  # nothing but the tail is noise
    assert [q.compression(good[:n], packer)[3] for n in (100, 2047, 2048, 2049, 4096, 4097)] == [0, 0, 1, 2, 2, 3]
