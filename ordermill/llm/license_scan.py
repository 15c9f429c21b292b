"""License scans by ordered signature rules.

Some 650 regexes come from hand-written forms over tables of licenses and their
short names: grant sentences, SPDX tags, addresses, plain names.  A space in a rule is any run of
white space.  Each rule waits for a keyword that every match of it holds; one
Aho-Corasick pass over the text says which keywords it holds, so a text without
any costs one scan.  Found intervals are settled in order of
priority, then length: an interval inside, or overlapping, one already taken
is dropped.  Four base phrases are counted apart and always stay.

Cases: a null text counts as empty (no words, no labels, score 0); texts are
scanned whole; equal matches of two rules go to the earlier rule; repeated
rows get equal results; other columns are not read.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import spark_struct, structs, table, text_bytes

#: Base phrases and their labels.
BASE_PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: label, keyword (or keywords by |) of which every match of the name holds one, regex of the name, SPDX id regex
LICENSES = (
    ("agpl-3.0", "affero", r"gnu affero general public licen[sc]e(?:,? v(?:ersion)?\.? ?3(?:\.0)?)?", r"agpl-3\.0(?:-only|-or-later|\+)?"),
    ("lgpl-2.1", "lesser general", r"gnu lesser general public licen[sc]e,? v(?:ersion)?\.? ?2\.1", r"lgpl-2\.1(?:-only|-or-later|\+)?"),
    ("lgpl-3.0", "lesser general", r"gnu lesser general public licen[sc]e,? v(?:ersion)?\.? ?3(?:\.0)?", r"lgpl-3\.0(?:-only|-or-later|\+)?"),
    ("lgpl", "lesser general", r"(?:gnu )?lesser general public licen[sc]e", r"lgpl"),
    ("lgpl-2.0", "library general", r"gnu library general public licen[sc]e", r"lgpl-2\.0(?:-only|-or-later|\+)?"),
    ("gpl-2.0", "general public", r"gnu general public licen[sc]e,? v(?:ersion)?\.? ?2(?:\.0)?", r"gpl-2\.0(?:-only|-or-later|\+)?"),
    ("gpl-3.0", "general public", r"gnu general public licen[sc]e,? v(?:ersion)?\.? ?3(?:\.0)?", r"gpl-3\.0(?:-only|-or-later|\+)?"),
    ("gfdl", "free documentation", r"gnu free documentation licen[sc]e", r"gfdl-1\.[123](?:-only|-or-later)?"),
    ("apache-2.0", "apache", r"apache licen[sc]e,? v(?:ersion)?\.? ?2(?:\.0)?", r"apache-2\.0"),
    ("apache-1.1", "apache", r"apache (?:software )?licen[sc]e,? v(?:ersion)?\.? ?1\.1", r"apache-1\.1"),
    ("cc0-1.0", "cc0", r"cc0(?: 1\.0)?(?: universal)?", r"cc0-1\.0"),
    ("cc-by-nc-nd", "nc-nd", r"cc[ -]by-nc-nd(?: [1-4]\.0)?", r"cc-by-nc-nd-[1-4]\.0"),
    ("cc-by-nc-sa", "nc-sa", r"cc[ -]by-nc-sa(?: [1-4]\.0)?", r"cc-by-nc-sa-[1-4]\.0"),
    ("cc-by-nc", "by-nc", r"cc[ -]by-nc(?: [1-4]\.0)?", r"cc-by-nc-[1-4]\.0"),
    ("cc-by-nd", "by-nd", r"cc[ -]by-nd(?: [1-4]\.0)?", r"cc-by-nd-[1-4]\.0"),
    ("cc-by-sa", "by-sa", r"cc[ -]by-sa(?: [1-4]\.0)?", r"cc-by-sa-[1-4]\.0"),
    ("cc-by-4.0", "cc", r"cc[ -]by[ -]4\.0", r"cc-by-4\.0"),
    ("cc-by-3.0", "cc", r"cc[ -]by[ -]3\.0", r"cc-by-3\.0"),
    ("cc-attribution", "creative commons", r"creative commons attribution(?: [1-4]\.0)?(?: international| unported)?", r"cc-by-2\.[05]"),
    ("cc-attribution-nc", "creative commons", r"creative commons attribution[ -]non[ -]?commercial(?: [1-4]\.0)?", r"cc-by-nc-1\.0"),
    ("cc-attribution-sa", "creative commons", r"creative commons attribution[ -]share[ -]?alike(?: [1-4]\.0)?", r"cc-by-sa-1\.0"),
    ("bsd-2-clause", "bsd", r"(?:simplified bsd|bsd 2-clause|2-clause bsd|freebsd) licen[sc]e", r"bsd-2-clause"),
    ("bsd-3-clause", "bsd", r"(?:new bsd|modified bsd|revised bsd|bsd 3-clause|3-clause bsd) licen[sc]e", r"bsd-3-clause"),
    ("bsd-4-clause", "bsd", r"(?:original bsd|bsd 4-clause|4-clause bsd) licen[sc]e", r"bsd-4-clause"),
    ("0bsd", "bsd", r"zero-clause bsd(?: licen[sc]e)?", r"0bsd"),
    ("isc", "isc", r"isc licen[sc]e", r"isc"),
    ("mpl-1.1", "mozilla", r"mozilla public licen[sc]e,? v(?:ersion)?\.? ?1\.1", r"mpl-1\.1"),
    ("mpl-2.0", "mozilla", r"mozilla public licen[sc]e,? v(?:ersion)?\.? ?2\.0", r"mpl-2\.0"),
    ("epl-1.0", "eclipse", r"eclipse public licen[sc]e(?:,| -)? v(?:ersion)?\.? ?1\.0", r"epl-1\.0"),
    ("epl-2.0", "eclipse", r"eclipse public licen[sc]e(?:,| -)? v(?:ersion)?\.? ?2\.0", r"epl-2\.0"),
    ("edl-1.0", "eclipse", r"eclipse distribution licen[sc]e(?:,| -)? v(?:ersion)?\.? ?1\.0", r"edl-1\.0"),
    ("cddl-1.0", "distribution licen", r"common development and distribution licen[sc]e(?:,? v(?:ersion)?\.? ?1\.0)?", r"cddl-1\.0"),
    ("cpl-1.0", "common public", r"common public licen[sc]e(?:,? v(?:ersion)?\.? ?1\.0)?", r"cpl-1\.0"),
    ("ipl-1.0", "ibm public", r"ibm public licen[sc]e(?:,? v(?:ersion)?\.? ?1\.0)?", r"ipl-1\.0"),
    ("eupl-1.2", "european union", r"european union public licen[sc]e(?:,? v(?:ersion)?\.? ?1\.2)?", r"eupl-1\.2"),
    ("artistic-1.0", "artistic", r"artistic licen[sc]e,? v?(?:ersion)?\.? ?1\.0", r"artistic-1\.0"),
    ("artistic-2.0", "artistic", r"artistic licen[sc]e,? v?(?:ersion)?\.? ?2\.0", r"artistic-2\.0"),
    ("bsl-1.0", "boost", r"boost software licen[sc]e(?:(?:,| -)? v(?:ersion)?\.? ?1\.0)?", r"bsl-1\.0"),
    ("zlib", "zlib", r"zlib(?:/libpng)? licen[sc]e", r"zlib"),
    ("unlicense", "unlicense", r"(?:the )?unlicense", r"unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl", r"wtfpl"),
    ("postgresql", "postgresql", r"postgresql licen[sc]e", r"postgresql"),
    ("python-2.0", "python software", r"python software foundation licen[sc]e", r"python-2\.0|psf-2\.0"),
    ("php-3.01", "php licen", r"php licen[sc]e,? v(?:ersion)?\.? ?3\.01", r"php-3\.01"),
    ("ruby", "ruby", r"ruby licen[sc]e", r"ruby"),
    ("openssl", "openssl", r"openssl licen[sc]e", r"openssl"),
    ("x11", "x11", r"x11 licen[sc]e", r"x11"),
    ("ncsa", "ncsa", r"university of illinois/ncsa open source licen[sc]e", r"ncsa"),
    ("ofl-1.1", "open font", r"sil open font licen[sc]e(?:,? v(?:ersion)?\.? ?1\.1)?", r"ofl-1\.1"),
    ("odbl-1.0", "open database", r"open database licen[sc]e(?:,? v?1\.0)?", r"odbl-1\.0"),
    ("odc-by-1.0", "open data commons", r"open data commons attribution licen[sc]e", r"odc-by-1\.0"),
    ("pddl-1.0", "public domain dedication", r"(?:open data commons )?public domain dedication (?:and|&) licen[sc]e", r"pddl-1\.0"),
    ("ms-pl", "microsoft", r"microsoft public licen[sc]e", r"ms-pl"),
    ("ms-rl", "microsoft", r"microsoft reciprocal licen[sc]e", r"ms-rl"),
    ("afl-3.0", "academic free", r"academic free licen[sc]e,? v(?:ersion)?\.? ?3\.0", r"afl-3\.0"),
    ("osl-3.0", "open software", r"open software licen[sc]e,? v(?:ersion)?\.? ?3\.0", r"osl-3\.0"),
    ("qpl-1.0", "q public", r"q public licen[sc]e(?:,? v(?:ersion)?\.? ?1\.0)?", r"qpl-1\.0"),
    ("sleepycat", "sleepycat", r"sleepycat licen[sc]e", r"sleepycat"),
    ("sspl-1.0", "server side", r"server side public licen[sc]e(?:,? v(?:ersion)?\.? ?1)?", r"sspl-1\.0"),
    ("busl-1.1", "business source", r"business source licen[sc]e(?:,? v?1\.1)?", r"busl-1\.1"),
    ("elastic-2.0", "elastic", r"elastic licen[sc]e(?:,? (?:v(?:ersion)? ?)?2\.0)?", r"elastic-2\.0"),
    ("mit-0", "mit no attribution", r"mit no attribution(?: licen[sc]e)?", r"mit-0"),
    ("mulan-psl-2.0", "mulan", r"mulan permissive software licen[sc]e,? v(?:ersion)?\.? ?2", r"mulanpsl-2\.0"),
    ("upl-1.0", "universal permissive", r"universal permissive licen[sc]e(?:,? v(?:ersion)?\.? ?1\.0)?", r"upl-1\.0"),
    ("vim", "vim licen", r"vim licen[sc]e", r"vim"),
    ("w3c", "w3c", r"w3c software (?:notice and )?licen[sc]e", r"w3c"),
    ("latex-1.3c", "latex project", r"latex project public licen[sc]e(?:,? v(?:ersion)?\.? ?1\.3c?)?", r"lppl-1\.3[ac]?"),
    ("openrail", "rail", r"(?:creativeml |bigscience )?open ?rail(?:[+-]?m)? licen[sc]e", r"openrail(?:-m)?"),
    ("gpl", "general public", r"(?:gnu )?general public licen[sc]e", r"gpl"),
    ("apache", "apache", r"apache (?:software )?licen[sc]e", r"apache"),
    ("cc-by", "cc", r"cc[ -]by", r"cc-by"),
    ("mit", "mit|expat", r"(?:mit|expat) licen[sc]e", r"mit"),
    ("bsd", "bsd", r"bsd(?:-style)? licen[sc]e", r"bsd"),
)

#: Short names by which a license is told for certain: label, keyword, regex.
SHORT = (
    ("agpl-3.0", "agpl", r"(?:gnu )?agpl[ -]?v?3(?:\.0)?(?:\+|-only|-or-later)?"),
    ("agpl", "agpl", r"(?:gnu )?agpl"),
    ("lgpl-2.1", "lgpl", r"(?:gnu )?lgpl[ -]?v?2\.1(?:\+|-only|-or-later)?"),
    ("lgpl-2.0", "lgpl", r"(?:gnu )?lgpl[ -]?v?2(?:\.0)?(?:\+|-only|-or-later)?"),
    ("lgpl-3.0", "lgpl", r"(?:gnu )?lgpl[ -]?v?3(?:\.0)?(?:\+|-only|-or-later)?"),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl"),
    ("gpl-2.0", "gpl", r"(?:gnu )?gpl[ -]?v?2(?:\.0)?(?:\+|-only|-or-later)?"),
    ("gpl-3.0", "gpl", r"(?:gnu )?gpl[ -]?v?3(?:\.0)?(?:\+|-only|-or-later)?"),
    ("gpl", "gpl", r"(?:gnu )?gpl"),
    ("apache-2.0", "apache", r"apache[ -](?:software )?(?:licen[sc]e )?v?2(?:\.0)?(?: licen[sc]e)?"),
    ("apache-1.1", "apache", r"apache[ -]v?1\.1(?: licen[sc]e)?"),
    ("bsd-2-clause", "bsd", r"(?:bsd[ -](?:2|two)[ -]clause|(?:2|two)[ -]clause bsd|simplified bsd)"),
    ("bsd-3-clause", "bsd", r"(?:bsd[ -](?:3|three)[ -]clause|(?:3|three)[ -]clause bsd|new bsd|modified bsd)"),
    ("bsd-4-clause", "bsd", r"(?:bsd[ -](?:4|four)[ -]clause|(?:4|four)[ -]clause bsd)"),
    ("mpl-2.0", "mpl", r"mpl[ -]?v?2(?:\.0)?"),
    ("mpl-1.1", "mpl", r"mpl[ -]?v?1\.1"),
    ("epl-2.0", "epl", r"epl[ -]?v?2(?:\.0)?"),
    ("epl-1.0", "epl", r"epl[ -]?v?1(?:\.0)?"),
    ("eupl-1.2", "eupl", r"eupl[ -]?v?1\.2"),
    ("cddl-1.0", "cddl", r"cddl(?:[ -]?v?1(?:\.[01])?)?"),
    ("cc0-1.0", "cc0", r"cc0[ -]?1\.0"),
    ("cc-by-sa", "by-sa", r"cc-by-sa-[1-4]\.0"),
    ("cc-by-nc", "by-nc", r"cc-by-nc-[1-4]\.0"),
    ("cc-by-nd", "by-nd", r"cc-by-nd-[1-4]\.0"),
    ("sspl-1.0", "sspl", r"sspl(?:[ -]?v?1(?:\.0)?)?"),
    ("bsl-1.0", "bsl", r"bsl-1\.0"),
    ("mit-0", "mit-0", r"mit-0"),
    ("0bsd", "0bsd", r"0bsd"),
    ("unlicense", "unlicense", r"unlicense"),
    ("openrail", "openrail", r"openrail(?:-m|\+\+)?"),
)
#: Names that are words of their own elsewhere, and name a license where one is
#: granted or a field is filled only.
GRANTED = (
    ("mit", "mit", r"mit"), ("mit", "expat", r"expat"), ("bsd", "bsd", r"bsd"), ("isc", "isc", r"isc"), ("zlib", "zlib", r"zlib"),
    ("apache", "apache", r"apache"), ("x11", "x11", r"x11"), ("artistic-2.0", "artistic", r"artistic 2(?:\.0)?"), ("wtfpl", "wtfpl", r"wtfpl"),
    ("cc0-1.0", "cc0", r"cc0"), ("public-domain", "public domain", r"public domain"), ("postgresql", "postgresql", r"postgresql"),
    ("boost", "boost", r"boost"), ("ruby", "ruby", r"ruby"), ("openssl", "openssl", r"openssl"),
)

#: Forms of a mention: priority (lower goes first), confidence, regex around the name.
FORMS = (
    ("spdx", 0, 1.0, r"spdx-license-identifier:\s*(?:{spdx})(?![\w.-])"),
    ("grant", 1, 0.95, r"(?:is |are )?(?:dual[- ])?(?:licensed|released|distributed|published|made available|provided|covered) "
                       r"(?:under|by|according to)(?: the)?(?: terms(?: and conditions)? of)?(?: the)? (?:{name})(?!\w)"),
    ("permission", 2, 0.9, r"(?:redistribute|modify|use|copy)[\w ,/]{{0,80}} under the terms of the (?:{name})(?!\w)"),
    ("notice", 2, 0.9, r"(?:see|read|refer to|copy of|subject to) the (?:{name})(?!\w)"),
    ("field", 3, 0.85, r"licen[sc]e\s*[:=]\s*[\"']?(?:{spdx}|{name})(?![\w.-])"),
    ("heading", 4, 0.8, r"(?:^|\n)[ \t#*=]*(?:the )?(?:{name})[ \t#*=]*(?=\n|$)"),
    ("name", 5, 0.7, r"(?<!\w)(?:{name})(?!\w)"),
)

#: Hand-written signatures outside the forms: label, keyword, priority, confidence, regex.
SIGNATURES = (
    ("mit", "permission is hereby", 1, 0.95, r"permission is hereby granted, free of charge, to any person obtaining a copy"),
    ("isc", "permission to use", 1, 0.9, r"permission to use, copy, modify, and/or distribute this software for any purpose"),
    ("bsd", "redistribution", 1, 0.9, r"redistribution and use in source and binary forms, with or without modification"),
    ("gpl", "free software foundation", 1, 0.85, r"as published by the free software foundation"),
    ("apache", "apache.org/licenses", 1, 0.95, r"https?://(?:www\.)?apache\.org/licenses/license-2\.0"),
    ("gpl", "gnu.org/licenses", 1, 0.95, r"https?://(?:www\.)?gnu\.org/licenses/(?:old-licenses/)?gpl(?:-[23]\.0)?"),
    ("agpl-3.0", "gnu.org/licenses", 0, 0.95, r"https?://(?:www\.)?gnu\.org/licenses/agpl-3\.0"),
    ("lgpl", "gnu.org/licenses", 0, 0.95, r"https?://(?:www\.)?gnu\.org/licenses/(?:old-licenses/)?lgpl(?:-[23]\.[01])?"),
    ("cc-by", "creativecommons.org", 2, 0.95, r"https?://creativecommons\.org/licenses/by/[1-4]\.[05]"),
    ("cc-by-sa", "creativecommons.org", 1, 0.95, r"https?://creativecommons\.org/licenses/by-sa/[1-4]\.[05]"),
    ("cc-by-nc", "creativecommons.org", 1, 0.95, r"https?://creativecommons\.org/licenses/by-nc/[1-4]\.[05]"),
    ("cc0-1.0", "creativecommons.org", 1, 0.95, r"https?://creativecommons\.org/publicdomain/zero/1\.0"),
    ("mit", "opensource.org", 1, 0.95, r"https?://(?:www\.)?opensource\.org/licenses/mit"),
    ("unlicense", "public domain", 1, 0.9, r"this is free and unencumbered software released into the public domain"),
    ("public-domain", "public domain", 3, 0.7, r"(?:in|into|to) the public domain"),
    ("all-rights-reserved", "all rights reserved", 4, 0.6, r"all rights reserved"),
    ("proprietary", "confidential", 4, 0.6, r"proprietary and confidential|confidential and proprietary"),
)


@dataclass(frozen=True)
class Rule:
    order: int
    label: str
    keyword: str
    priority: int
    confidence: float
    pattern: re.Pattern


def spaced(rx: str) -> str:
    """The regex with any white space where it has a space."""
    rx = rx.replace("[ -]", "(?:-| )").replace("[- ]", "(?:-| )").replace(r"[\w ,/]", r"(?:[\w,/]|\s++)")
    swap = {" ": r"\s+", " ?": r"\s*"}
    return re.sub(r"\[[^]]*\]| \??", lambda m: swap.get(m[0], m[0]), rx)


#: What may not follow a short name: more of a word, a number or an address.
_END = r"(?![\w+@/]|[.-]\w)"


def rules() -> list[Rule]:
    """All rules in order: hand-written signatures, then every form of every
    license, then the short names in the forms that suit them."""
    made = [(label, key, prio, conf, rx) for label, key, prio, conf, rx in SIGNATURES]
    for label, key, name, spdx in LICENSES:
        for form, prio, conf, rx in FORMS:
            keyword = {"spdx": "spdx-license-identifier", "field": "licen"}.get(form, key)
            made.append((label, keyword, prio, conf, rx.format(name=name, spdx=spdx)))
    shapes = {form: (prio, conf, rx) for form, prio, conf, rx in FORMS}
    for names, forms in ((SHORT, ("grant", "permission", "notice", "field", "name")), (GRANTED, ("grant", "field"))):
        for label, key, name in names:
            for form in forms:
                prio, conf, rx = shapes[form]
                rx = rx.replace("(?:{spdx}|{name})", "(?:{name})").replace(r"(?![\w.-])", "(?!\\w)").replace(r"(?!\w)", "{end}")
                rx = rx.replace(r"(?<!\w)", r"(?<![\w@/.-])") if form == "name" else rx
                made.append((label, key, prio, round(conf - 0.05, 2), rx.format(name=name, end=_END)))
    return [Rule(i, label, key, prio, conf, re.compile(spaced(rx))) for i, (label, key, prio, conf, rx) in enumerate(made)]


def keyword_gate(found: list[Rule]) -> ahocorasick.Automaton:
    """Keyword -> the rules that wait for it."""
    gate = ahocorasick.Automaton()
    waiting: dict[str, list[Rule]] = {}
    for r in found:
        for word in r.keyword.split("|"):
            waiting.setdefault(word, []).append(r)
    for word, mine in waiting.items():
        gate.add_word(word, mine)
    gate.make_automaton()
    return gate


def detections(text: str, gate: ahocorasick.Automaton) -> list[tuple[int, int, Rule]]:
    """Settled, non-overlapping (start, end, rule), in text order."""
    awake = {id(mine): mine for _, mine in gate.iter(" ".join(text.split()))}
    waked = {r.order: r for mine in awake.values() for r in mine}
    spans = [(m.start(), m.end(), r) for r in waked.values() for m in r.pattern.finditer(text)]
    spans.sort(key=lambda s: (s[2].priority, s[0] - s[1], s[2].order, s[0]))
    taken: list[tuple[int, int, Rule]] = []  # in text order, so only its neighbours can touch a new one
    for s in spans:
        at = bisect.bisect_left(taken, s[0], key=lambda t: t[0])
        if (at == 0 or taken[at - 1][1] <= s[0]) and (at == len(taken) or s[1] <= taken[at][0]):
            taken.insert(at, s)
    return taken


#: Bytes of words after lower-casing: ASCII digits and letters, and every byte beyond ASCII.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
                   for c in range(256))
FIELDS = pa.struct([("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
                    ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()),
                    ("score", pa.float64()), ("spans", pa.list_(pa.string()))])
_PHRASES = [(f" {p} ".encode(), label) for p, label in BASE_PHRASES.items()]


def base_places(words: bytes) -> list[tuple[int, str]]:
    """(first word's index, label) of every base phrase in `` w w w ``."""
    found = []
    for phrase, label in _PHRASES:
        at, word, seen = words.find(phrase), 0, 0
        while at >= 0:
            word, seen = word + words.count(b" ", seen, at), at
            found.append((word, label))
            at = words.find(phrase, at + 1)
    return found


def scan(text: bytes, gate: ahocorasick.Automaton) -> tuple:
    """A row of FIELDS for the whole text."""
    words = text.translate(WORD_BYTES).split()
    places = base_places(b" %b " % b" ".join(words))
    lower = text.lower().decode("utf-8", "replace")
    taken = detections(lower, gate)
    base = {label for _, label in places}
    # a base label counts in full: its phrase is in the text as it stands
    score = max([r.confidence for _, _, r in taken] + [1.0] * bool(base), default=0.0)
    starts = [p for p, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | {r.label for _, _, r in taken})), score,
            [f"{s}-{e}:{r.label}" for s, e, r in taken])


@F.arrow_udf(spark_struct(FIELDS))
def _scans(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    gate = keyword_gate(rules())
    for batch in texts:
        yield structs([scan(v.as_py() or b"", gate) for v in batch], FIELDS)


def license_scan(text_col: str = "text") -> Column:
    """A struct of counts, labels, score and settled spans per text."""
    return _scans(text_bytes(text_col))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", license_scan().alias("s")).select("doc_id", "s.*")
