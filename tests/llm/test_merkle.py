"""Merkle manifest against a plain recursion over the whole tree."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from ordermill.llm import merkle as m
from ordermill.llm.common import table
from tests.conftest import SF_SMALL

from .helpers import docs_of, no_docs, odd_docs


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    parts = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return h(*["-" if p is None else f"{len(str(p).encode())}:{p}" for p in parts])


def tree(nodes):
    """(root, per node its [(left, right)] siblings from the bottom up)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, k in enumerate(at):
            run = nodes[k // 8 * 8:k // 8 * 8 + 8]
            paths[i].append(("".join(run[:k % 8]), "".join(run[k % 8 + 1:])))
        nodes, at = [h(*nodes[k:k + 8]) for k in range(0, len(nodes), 8)], [k // 8 for k in at]
    return nodes[0], paths


def restated(rows):
    langs = {}
    for r in rows:
        langs.setdefault(r["lang"], []).append(r)
    order = sorted(langs, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for lang in order:
        group = sorted(langs[lang], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["text"])))
        trees[lang] = (group, *tree([leaf_of(r, r["text"]) for r in group]))
    root, tops = tree([trees[lang][1] for lang in order]) if order else (None, [])
    out = []
    for lang, rest in zip(order, tops):
        group, subroot, paths = trees[lang]
        for r, path in zip(group, paths):
            leaf = folded = leaf_of(r, r["text"])
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0:
                text = r["text"]
                folded = leaf_of(r, text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
            for left, right in path + rest:
                folded = h(left, folded, right)
            proof = h(*[a + b for a, b in path + rest])
            out.append((r["doc_id"], leaf, subroot, root, proof, folded, folded == root))
    return sorted(out, key=str)


def got(spark, docs):
    rows = m.manifest(docs).withColumn("folded_root", m.folded(F.coalesce("tampered", "leaf"), F.col("path")))
    rows = rows.select("doc_id", "leaf", "subroot", "root", m.proof_digest(F.col("path")), "folded_root", F.expr("folded_root = root"))
    return sorted(map(tuple, rows.collect()), key=str)


def rows_of(docs):
    return [r.asDict() for r in docs.select(*m.COLUMNS).collect()]


def test_query_equals_recursion(spark):
    rows = m.op13_merkle_manifest(spark, SF_SMALL)
    assert rows.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, rows.collect()), key=str) == restated(rows_of(table(spark, SF_SMALL, "documents")))


@pytest.mark.parametrize("levels", [1, 2])
def test_several_rounds_of_blocks(spark, monkeypatch, levels):
    monkeypatch.setattr(m, "BLOCK_LEVELS", levels)
    docs = docs_of(spark, {i: f"Text {i % 7}" for i in range(90)})
    assert got(spark, docs) == restated(rows_of(docs))


@pytest.mark.parametrize("rows", [1, 2, 8, 9, 65])
def test_sizes(spark, rows):
    docs = docs_of(spark, {i: "Some Text" for i in range(rows)})
    assert got(spark, docs) == restated(rows_of(docs))


def test_many_languages(spark):
    docs = docs_of(spark, {i: f"T{i}" for i in range(40)}).withColumn("lang", F.expr("if(doc_id = 3, null, concat('l', doc_id % 20))"))
    assert got(spark, docs) == restated(rows_of(docs))


def test_odd_rows_and_empty_table(spark):
    docs = odd_docs(spark).withColumns({c: F.lit("x") for c in ("leaf", "root", "g", "rank", "path")})
    assert got(spark, docs) == restated(rows_of(docs))
    assert got(spark, no_docs(spark)) == []


def test_a_changed_leaf_does_not_verify(spark):
    docs = docs_of(spark, {i: "Capital letters" for i in range(30)})
    for r in got(spark, docs):
        assert r[-1] == (zlib.crc32(str(r[0]).encode()) % 3 != 0)
