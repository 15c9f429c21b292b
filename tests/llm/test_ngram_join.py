"""N-gram join against all pairs, in every mode of its rounds."""

from collections import defaultdict

import numpy as np
import pytest

from ordermill.llm import components, ngram_join as j
from ordermill.llm.common import table
from ordermill.session import scratch_path
from tests.conftest import SF_SMALL

from .helpers import SCHEMA, docs_of, no_docs, odd_docs, prose


def restated(rows):
    """{doc_id: (n_shingles, component_id)} by comparing all pairs that share a shingle."""
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i] = frozenset([tuple(w)] if 0 < len(w) < 5 else (tuple(w[k:k + 5]) for k in range(len(w) - 4)))
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    holders, both = defaultdict(list), defaultdict(int)
    for i, s in sorted(sets.items()):
        for q in s:
            for other in holders[q]:
                both[other, i] += 1
            holders[q].append(i)
    for (a, b), n in both.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((top(a), top(b)))
            up[b] = a
    return {i: (len(s), top(i)) for i, s in sets.items()}


def check(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in j.near_duplicates(docs).collect()}
    assert got == restated(rows)
    return got


def family(base, copies, edits, start):
    """Copies of a text with single words replaced, so that not all pairs link."""
    rng = np.random.default_rng(start)
    out = {}
    for c in range(copies):
        w = base.split()
        for k in rng.choice(len(w), edits, replace=False):
            w[k] = f"edit{c}"
        out[start + c] = " ".join(w)
    return out


def test_query_equals_all_pairs(spark):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in j.op7_ngram_join(spark, SF_SMALL).collect()}
    assert got == restated([(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()])


@pytest.mark.parametrize("rows,sent", [(1000, 200_000), (3, 2)])
def test_families_and_chains(spark, monkeypatch, rows, sent):
    monkeypatch.setattr(j, "GROUP_ROWS", rows)
    monkeypatch.setattr(j, "BROADCAST_ROWS", sent)
    shared = prose(7, 60)
    texts = family(prose(1, 150), 14, 3, 100) | family(prose(2, 40), 6, 1, 200)
    for c, edits in enumerate((1, 2, 4, 6, 8, 12, 1, 3)):  # kin with many and few edits
        texts |= family(prose(4, 200), 1, edits, 500 + c)
    texts |= {300 + i: prose(20 + i, 200) + " " + shared for i in range(12)}  # a common passage links nothing
    w = prose(3, 100).split()
    texts |= {400 + i: " ".join(w[i * 4:] + [f"tail{k}" for k in range(i * 4)]) for i in range(6)}  # a chain
    texts |= {1: texts[100], 2: texts[100].upper(), 3: "  " + texts[100].replace(" ", "\n")}
    got = check(spark, docs_of(spark, texts))
    assert len({got[i][1] for i in range(300, 312)}) == 12 and got[100][1] == 1


def test_odd_rows(spark):
    docs = odd_docs(spark)
    rows = [(r.doc_id, r.n_shingles, r.component_id) for r in j.near_duplicates(docs).collect()]
    assert len(rows) == docs.count()
    by = {(i, n): c for i, n, c in rows}
    assert by[1, 0] == 1 and by[2, 0] == 2 and by[3, 0] == 3
    assert by[8, 1] == by[9, 1] == 8 and by[6, 116] == by[7, 116] == 6
    kept = j.keep_one(docs)
    assert set(kept.columns) == set(docs.columns)
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, -1, 1, 2, 3, 4, 5, 6, 8, 10]
    assert j.near_duplicates(no_docs(spark)).collect() == [] and j.keep_one(no_docs(spark)).collect() == []


def test_a_family_without_a_common_hub(spark):
    """Texts that differ from each other in many ways: several rounds, more than one hub each."""
    base, texts = prose(11, 120).split(), {}
    for c in range(60):
        w = list(base)
        for k in (c % 10 * 11, (c * 7 + 3) % 110, 115 - c % 3):
            w[k] = f"edit{c % 12}"
        texts[1000 + c] = " ".join(w)
    check(spark, docs_of(spark, texts))


def test_keep_one_loses_no_text(spark):
    a, b, c = prose(31, 60), prose(32, 60), prose(33, 60)
    rows = [(5, a), (5, b), (5, b), (6, a + " tail"), (9, b), (None, c), (None, c), (None, a), (None, ""), (7, None), (7, None)]
    docs = spark.createDataFrame([(i, t, "en", f"src{k}", k) for k, (i, t) in enumerate(rows)], SCHEMA)
    kept = sorted(((r.doc_id, r.text) for r in j.keep_one(docs).collect()), key=str)
    assert kept == sorted([(5, a), (5, b), (None, c), (None, ""), (7, None), (7, None)], key=str)


def test_prefixes_of_similar_sets_meet_under_every_order():
    rng = np.random.default_rng(0)
    sketch = rng.integers(0, 5, 1 << j.LEAST_BITS)
    cut = lambda t, o, whole: t[j.prefix(t, j.counts_of(t, sketch), o)][:len(t) - whole + 1]
    for _ in range(200):
        n = int(rng.integers(1, 60))
        x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        y = np.unique(np.concatenate([x[rng.random(len(x)) < 0.93], rng.integers(0, 1 << 63, n // 20).astype(np.uint64)]))
        if j.alike(x, y):
            whole = -(-80 * (len(x) + len(y)) // 180)
            assert all(len(np.intersect1d(cut(x, o, whole), cut(y, o, whole))) for o in range(j.ORDERS))


def test_components(spark):
    links = [(5, 4), (4, 3), (3, 2), (2, 1), (10, 11), (12, 11), (13, 12), (7, 7)]
    df = spark.createDataFrame(links, "a bigint, b bigint")
    got = {r.node: r.label for r in components.connected(df, scratch_path(spark, "cc")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 10: 10, 11: 10, 12: 10, 13: 10}
    assert components.connected(df.filter("false"), scratch_path(spark, "cc")).collect() == []


def test_jobs_do_not_grow_with_shuffle_partitions(spark):
    docs = docs_of(spark, {i: prose(40 + i, 40) for i in range(6)})
    jobs, before = [], {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        for n in (2, 40):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            spark.sparkContext.setJobGroup(f"ngram{n}", "counted")
            assert j.near_duplicates(docs).count() == 6
            jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"ngram{n}")))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
        for key in ("spark.jobGroup.id", "spark.job.description"):
            spark.sparkContext.setLocalProperty(key, None)
    assert jobs[1] <= jobs[0] + 10


def test_tables_are_written_by_as_many_tasks_as_the_text_asks_for(spark, monkeypatch):
    """A task per shuffle partition and table fills the driver, which hears of each."""
    texts = {i: prose(40 + i, 40) for i in range(6)} | family(prose(90, 60), 12, 2, 100)
    docs = docs_of(spark, texts)
    files, write = [], components.saved

    def counted(df, path, *parts):
        out = write(df, path, *parts)
        files.append((path.rsplit("/", 1)[-1], len(out.inputFiles())))
        return out

    for module in (components, j):
        monkeypatch.setattr(module, "saved", counted)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        assert check(spark, docs)[100] == (56, 100)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    limit = 2 * spark.sparkContext.defaultParallelism
    names = {"sketch", "nodes", "many", "postings", "live", "pairs", "step0", "edges0", "labels"}
    assert names <= {name for name, _ in files}
    assert max(n for name, n in files if name in names) <= limit
