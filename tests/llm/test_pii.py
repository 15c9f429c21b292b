"""Personal data against Python's regex engine and counts by hand."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import regex
from pyspark.sql import functions as F

from ordermill.llm import pii
from ordermill.llm.common import table
from tests.conftest import SF_SMALL

from .helpers import docs_of, no_docs, odd_docs, prose

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def valid(kind, value):
    digits = [int(c) for c in value if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "card":
        return 13 <= len(digits) <= 19 and sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits[::-1])) % 10 == 0
    return True


def base(text):
    return {k: [m for m in re.finditer(p, text) if valid(k, m[0])] for k, p in PATTERNS.items()}


def restated(texts):
    """Per text: (counts, base digest, all spans), the terms by the formula over all texts."""
    term = regex.compile(pii.TERM)
    with_token, with_entity, both, around = Counter(), defaultdict(set), defaultdict(set), defaultdict(set)
    spell = {"email": str.lower, "ip": str, "card": lambda v: re.sub("[^0-9]", "", v), "phone": lambda v: re.sub("[^0-9]", "", v)}
    grow = lambda words: set(words) | {w[:pii.STEM] + "*" for w in words}
    held = defaultdict(set)
    for row, text in enumerate(texts):
        with_token.update(grow([w.lower() for w in term.findall(text)]))
        for kind, found in base(text).items():
            everything = list(re.finditer(PATTERNS[kind], text))
            for m in found:
                k = [x.start() for x in everything].index(m.start())
                before = text[everything[k - 1].end() if k else 0:m.start()]
                after = text[m.end():everything[k + 1].start() if k + 1 < len(everything) else len(text)]
                before = regex.sub(r"^\S*", "", before[-pii.BESIDE:], count=1) if len(before) > pii.BESIDE else before
                after = regex.sub(r"\S*$", "", after[:pii.BESIDE], count=1) if len(after) > pii.BESIDE else after
                entity = f"{kind}:{spell[kind](m[0])}"
                with_entity[entity].add(row)
                held[row].add(entity)
                for t in grow([w.lower() for w in term.findall(before) + term.findall(after)]):
                    both[entity, t].add(row)
                    around[entity, t].add((before, after))
    n, share = len(texts), {}
    for (e, t), rows in both.items():
        if len(around[e, t]) >= pii.SUPPORT and len(with_entity[e]) < n:
            share[e, t] = math.log(n * len(rows) / (len(with_entity[e]) * with_token[t])) / math.log(n / len(with_entity[e]))
    out = []
    for row, text in enumerate(texts):
        spans = [f"{k}:{m.start()}:{m.end()}" for k, found in base(text).items() for m in found]
        more = [m for m in term.finditer(text) if any(share.get((e, m[0].lower()), 0) >= pii.DISCLOSED for e in held[row])]
        digest = hashlib.sha256(",".join(spans).encode()).hexdigest()
        out.append((*[len(f) for f in base(text).values()], digest, ",".join(spans + [f"term:{m.start()}:{m.end()}" for m in more])))
    return out


def got(docs):
    spans = lambda base: pii.told(F.filter("spans", lambda s: s["kind"] != "term") if base else F.col("spans"))
    rows = pii.personal_data(docs).select("doc_id", *map(pii.count_of, pii.KINDS), F.sha2(spans(True), 256), spans(False)).collect()
    return sorted((tuple(r) for r in rows), key=str)


def check(spark, texts):
    docs = docs_of(spark, dict(enumerate(texts)))
    want = sorted(((i, *r) for i, r in enumerate(restated([t or "" for t in texts]))), key=str)
    assert got(docs) == want
    return want


def test_query_equals_regex_engine(spark):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()
    want = [(r.doc_id, *w) for r, w in zip(docs, restated([r.text or "" for r in docs]))]
    rows = pii.op12_pii(spark, SF_SMALL)
    assert rows.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    assert sorted((tuple(r) for r in rows.collect()), key=str) == sorted(want, key=str)


def test_edges_of_the_patterns(spark):
    check(spark, [
        "a@b.c@d.e.f x..y@z-z.q", "a@b c@d. e@f.g..h@i.j", "x_y@h.com_z@h.com,a@b", "éa@b.cé a@é.c %+-.@-.-", "@a.b a@@b.c",
        "1.2.3.4.5.6.7.8 1.2.3 0001.02.255.256 255.255.255.255 1.2.3.4444 000000000255.0.0.0 1..2.3.4.5",
        "4111 1111 1111 1111 4111-1111-1111-1111 4111  1111 1111 1111 41111111111111112 -4111111111111111- 0000000000000 " + "4" * 400,
        "+1 (988) 555-2485 +12345678 +1234567890123456 ++1 23456789 +1 ( +1 234 567 89) +1--------2 +1 2 3 4 5 6 7 8 9 .",
        "\U0001F600\U0001F600 a@b.cd \U0001F600 10.0.0.1", "", None, "a@b" + ".c" * 300, "a@b.c " * 300, "9" * 500 + " " + "a" * 1000,
        "+1" + " " * 500, "1." * 400])


def test_long_runs_take_time_in_proportion(spark):
    """Runs on which a pattern with second tries would not come to an end, or overflow its stack."""
    texts = ["a@b" + ".c" * 60_000, "a@b.c " * 20_000, "9" * 300_000 + " " + "a" * 300_000, "+1" + " " * 300_000, "1." * 200_000, "a.b" * 100_000]
    got = pii.personal_data(docs_of(spark, dict(enumerate(texts)))).select("doc_id", *map(pii.count_of, pii.KINDS)).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 0, 0, 0), (1, 20_000, 0, 0, 0), (2, 0, 0, 0, 0), (3, 0, 0, 0, 0), (4, 0, 50_000, 0, 0), (5, 0, 0, 0, 0)]


def test_terms_that_disclose_are_spans(spark):
    texts = [prose(i, 60) for i in range(60)]
    for i in range(8):  # a name beside one address in many surroundings, also farther off in the same text
        texts.append(prose(100 + i, 20) + f" Zwaluwstein writes from zwalu@mail.example.com {prose(200 + i, 30)} zwaluwstein")
    texts += [prose(300, 20) + " Zwaluwstein was here"]  # no entity: the term stays
    texts += [prose(400, 20) + " Onceler sent 8.8.4.4 today"] * 9  # copies are one surrounding
    want = check(spark, texts)
    assert all(r[-1].count("term:") >= 2 for r in want if 60 <= r[0] < 68)
    assert "term" not in "".join(r[-1] for r in want if not 60 <= r[0] < 68)
    docs = docs_of(spark, dict(enumerate(texts)))
    clean = pii.personal_data(docs).select("doc_id", "text", pii.sanitised(F.col("text"), F.col("spans")).alias("clean")).collect()
    for r in clean:
        if 60 <= r.doc_id < 68:
            assert "[EMAIL]" in r.clean and not re.search("zwaluw|@", r.clean, re.I)
        elif r.doc_id < 69:
            assert r.text is None and r.clean is None
        else:
            assert r.clean == r.text.replace("8.8.4.4", "[IP]")


def test_terms_are_generalised_where_their_first_letters_are_common(spark):
    texts = [f"{prose(i, 30)} Marabu{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}" for i in range(100)]
    texts += [f"{prose(500 + i, 12)} Marquardt at 10.9.8.7 {prose(600 + i, 12)}" for i in range(6)]
    docs = docs_of(spark, dict(enumerate(texts)))
    rows = pii.personal_data(docs).filter("doc_id >= 100").select(pii.sanitised(F.col("text"), F.col("spans")).alias("clean")).collect()
    assert len(rows) == 6 and all(" mar* " in r.clean and " [IP] " in r.clean and "Marq" not in r.clean for r in rows)


def test_overlapping_spans_are_replaced_once(spark):
    df = spark.createDataFrame([("abcdefgh", [("x", 1, 4, "1"), ("y", 2, 6, "2"), ("z", 6, 7, "3")]), ("abc", [])], f"text string, spans {pii.SPANS}")
    assert [r[0] for r in df.select(pii.sanitised(F.col("text"), F.col("spans"))).collect()] == ["a13h", "abc"]


def test_running_sums(spark, monkeypatch):
    for n in (0, 1, 63, 64, 65, 5000):
        row = spark.range(1).select(pii.running_sums(F.array_repeat(F.lit(2), n)).alias("s")).first()
        assert row.s == [2 * (i + 1) for i in range(n)]


def test_odd_rows(spark):
    rows = got(odd_docs(spark))
    assert len(rows) == odd_docs(spark).count() and all(r[1:5] == (0, 0, 0, 0) and r[-1] == "" for r in rows)
    assert got(no_docs(spark)) == []
