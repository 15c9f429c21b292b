"""Decontamination: exact, edited and buried copies; clean texts stay."""

import random

import numpy as np

from ordermill.llm import decontam as d
from ordermill.llm.common import table
from tests.conftest import SF_SMALL

from .helpers import docs_of, no_docs, odd_docs, prose


def items(spark, texts):
    return spark.createDataFrame(list(texts.items()), "item_id bigint, text string")


def edited(text, seed, share):
    rng = random.Random(seed)
    out = []
    for w in text.split():
        dice = rng.random()
        if dice < share / 3:
            continue
        out += [f"new{seed}x{len(out)}"] if dice < share * 2 / 3 else [w, "added"] if dice < share else [w]
    return " ".join(out)


def test_query_finds_every_whole_copy(spark):
    got = {(r.doc_id, r.item_id) for r in d.op4_decontamination(spark, SF_SMALL).collect()}
    flat = lambda t: b" ".join(d.words_of(t))
    bench = [(r.item_id, flat(r.text)) for r in table(spark, SF_SMALL, "benchmark").collect()]
    docs = [(r.doc_id, flat(r.text)) for r in table(spark, SF_SMALL, "documents").collect()]
    assert got == {(i, j) for i, t in docs for j, b in bench if b in t} and got


def test_edited_and_buried_copies(spark):
    bench = {i: prose(1000 + i, 40) for i in range(5)}
    docs = {}
    for i, t in bench.items():
        docs[10 + i] = t.upper().replace(" ", " \n")
        docs[20 + i] = prose(50 + i, 300) + " " + edited(t, i, 0.2) + " " + prose(70 + i, 300)
        docs[30 + i] = prose(90 + i, 400)  # clean
        docs[40 + i] = " ".join(t.split()[:6]) + " " + prose(120 + i, 200)  # too little to be a leak
    got = {(r.doc_id, r.item_id): r for r in d.contamination(docs_of(spark, docs), items(spark, bench)).collect()}
    assert set(got) == {(b + i, i) for i in bench for b in (10, 20)}
    for i in bench:
        assert got[10 + i, i].score == 1.0 and 300 <= got[20 + i, i].last_word <= 345


def test_frequent_leaks_keep_their_seeds(spark):
    leak = prose(5, 40)
    docs = {i: prose(200 + i, 60) + " " + leak for i in range(60)} | {100 + i: prose(400 + i, 60) for i in range(20)}
    got = d.contamination(docs_of(spark, docs), items(spark, {7: leak}))
    assert {r.doc_id for r in got.collect()} == set(range(60))


def test_frequent_excerpts_and_edited_copies_keep_their_seeds(spark):
    bench = {i: prose(1000 + i, 40) for i in range(3)}
    excerpt = " ".join(bench[0].split()[12:27])  # under half of the item, a leak by its run
    changed = [w if i % 4 else f"new{i}" for i, w in enumerate(bench[1].split())]  # a quarter changed
    docs = {i: prose(200 + i, 60) + " " + excerpt for i in range(30)}
    docs |= {100 + i: prose(300 + i, 60) + " " + " ".join(changed) + " " + prose(400 + i, 60) for i in range(30)}
    docs |= {200 + i: prose(500 + i, 60) for i in range(30)}
    got = d.contamination(docs_of(spark, docs), items(spark, bench)).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(i, 0) for i in range(30)} | {(100 + i, 1) for i in range(30)}


def test_a_whole_copy_does_not_hide_frequent_edited_ones(spark):
    leak = prose(1000, 40)
    copy = edited(leak, 4, 0.25)
    docs = {i: prose(200 + i, 60) + " " + copy + " " + prose(400 + i, 2500) for i in range(30)}
    docs |= {100: leak} | {200 + i: prose(500 + i, 60) for i in range(30)}
    got = d.contamination(docs_of(spark, docs), items(spark, {7: leak})).collect()
    assert {r.doc_id for r in got} == {*range(30), 100}


def test_blocks_agree(spark):
    docs, bench = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "benchmark")
    runs = [sorted(map(tuple, d.contamination(docs, bench, n).select("doc_id", "item_id", "score").collect())) for n in (100_000, 300)]
    assert runs[0] == runs[1]


def test_alignment_against_full_dynamic_programme():
    rng = np.random.default_rng(3)
    for _ in range(30):
        a, b = rng.integers(1, 5, rng.integers(1, 15)), rng.integers(0, 5, rng.integers(1, 25))
        h, run, best, longest = np.zeros((len(a) + 1, len(b) + 1)), np.zeros((len(a) + 1, len(b) + 1), int), 0, 0
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                same = a[i - 1] == b[j - 1]
                h[i, j] = max(0, h[i - 1, j - 1] + (d.MATCH if same else d.MISMATCH), h[i - 1, j] + d.GAP, h[i, j - 1] + d.GAP)
                run[i, j] = run[i - 1, j - 1] + 1 if same else 0
        best, longest = h.max(), run.max()
        score, n, _ = d.align(a, b)
        assert score == best / (d.MATCH * len(a)) and n == longest


def test_odd_rows(spark):
    docs = odd_docs(spark)
    from .helpers import LONG
    bench = items(spark, {1: None, 2: "", 3: "one two", 4: LONG[1000:1400], 5: LONG[1000:1400], None: "a b c d"})
    bench = bench.unionAll(bench)
    got = d.contamination(docs, bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(5, 4), (5, 5)]
    clean = d.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns and clean.count() == docs.count() - 1
    assert d.contamination(no_docs(spark), bench).collect() == []
    assert d.contamination(docs, bench.filter("false")).collect() == []
    assert d.drop_contaminated(docs, bench.filter("false")).count() == docs.count()


def test_every_third_word_changed(spark):
    leak = prose(1000, 40)
    copy = " ".join(w if i % 3 != 2 else f"new{i}" for i, w in enumerate(leak.split()))
    docs = {i: prose(200 + i, 60) + " " + copy + " " + prose(400 + i, 60) for i in range(4)} | {100 + i: prose(500 + i, 60) for i in range(20)}
    got = d.contamination(docs_of(spark, docs), items(spark, {7: leak})).collect()
    assert {r.doc_id for r in got} == set(range(4)) and all(0.5 <= r.score < 0.52 for r in got)


def test_recall_against_every_text_times_every_item(spark):
    """Random edits of 10 to 40 words in a hundred, against the alignment of all pairs."""
    bench = {i: prose(2000 + i, 25 + 5 * (i % 5)) for i in range(12)}
    docs = {i: prose(3000 + i, 120) for i in range(40)}
    for i, text in bench.items():
        for k, share in enumerate((0.1, 0.2, 0.25, 0.3, 0.33, 0.4)):
            docs[100 + 10 * i + k] = prose(4000 + 10 * i + k, 50) + " " + edited(text, 10 * i + k, share) + " " + prose(5000 + 10 * i + k, 50)
    got = {(r.doc_id, r.item_id) for r in d.contamination(docs_of(spark, docs), items(spark, bench)).collect()}
    block = d.block_of([(i, d.words_of(t)) for i, t in bench.items()])
    texts = {i: block.numbers(t) for i, t in docs.items()}
    want = set()
    for item_id, item in block.passages:
        for i, text in texts.items():
            score, run, _ = d.align(item, text)
            if score >= d.MIN_SCORE or run >= d.RUN_WORDS:
                want.add((i, item_id))
    assert len(want) > 55 and got <= want
    assert len(got & want) >= 0.97 * len(want)


def test_an_ngram_that_all_items_share_is_held_in_parts(monkeypatch):
    shared = ["many", "items", "share", "this"]
    block = d.block_of([(i, shared + d.words_of(prose(6000 + i, 12))) for i in range(300)])
    at = block.numbers(" ".join(shared * 40) + " " + prose(6007, 12))
    whole = sorted(d.crowds(block, *block.find(at)))
    held, unique = [], np.unique
    monkeypatch.setattr(d, "CROWD_SLOTS", 500)
    monkeypatch.setattr(d.np, "unique", lambda a, **k: held.append(len(a)) or unique(a, **k))
    assert sorted(d.crowds(block, *block.find(at))) == whole and whole
    assert max(held) <= 2_000


def test_an_item_without_id_is_found(spark):
    leak = prose(1000, 30)
    docs = docs_of(spark, {1: leak, 2: prose(5, 30)})
    bench = items(spark, {None: leak})
    assert [(r.doc_id, r.item_id) for r in d.contamination(docs, bench).collect()] == [(1, None)]
    assert [r.doc_id for r in d.drop_contaminated(docs, bench).collect()] == [2]


def test_reading_items_takes_no_job_per_shuffle_partition(spark):
    bench = items(spark, {i: prose(500 + i, 30) for i in range(60)}).repartition(3)
    found, jobs, before = [], [], {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for n in (2, 40):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            for words in (d.BLOCK_WORDS, 600):
                group = f"items{n}-{words}"
                spark.sparkContext.setJobGroup(group, "counted")
                found.append(list(d.blocks(bench, words)))
                jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
    finally:
        for key, v in before.items():
            spark.conf.set(key, v)
        for key in ("spark.jobGroup.id", "spark.job.description"):
            spark.sparkContext.setLocalProperty(key, None)
    assert all(sorted(i for b in run for i, _ in b.passages) == list(range(60)) for run in found)
    assert [len(run) for run in found] == [1, 3, 1, 3]
    assert jobs[2] <= jobs[0] + 2 and jobs[3] <= jobs[1] + 5
