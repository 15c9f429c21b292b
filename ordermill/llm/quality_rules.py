"""Quality rules: compression bands.

zstandard ratios (packed / raw bytes) of the whole text and of fixed chunks
(the last one ends with the text and may overlap the one before) are held
against limits that depend on the length.  Too low: the text repeats
itself.  Too high: it is noise.  A base rule counts short texts and texts
whose three-word windows repeat.

Cases: a null text has no words and fails the base rule, as an empty one
does; a text too short for a band has no verdict of its own and is judged by
the base rule only, one shorter than a chunk by its whole ratio; repeated rows get equal verdicts; other columns are not
read.  Every text is packed whole, however long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, spark_struct, structs, table, text_bytes

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"
LEVEL = 3
CHUNK = 2048
#: (bytes, lowest whole ratio, highest whole ratio), read between the points
#: on a log scale of the length; shorter texts have no band.  Labelled good
#: prose stays some 0.02 above the lower curve at every length.
BANDS = ((200, 0.42, 1.00), (400, 0.465, 0.90), (800, 0.465, 0.80), (1600, 0.443, 0.75), (3200, 0.422, 0.72),
         (6400, 0.407, 0.70), (12800, 0.385, 0.70), (25600, 0.37, 0.70), (51200, 0.35, 0.70), (1000000, 0.28, 0.70))
_LENGTHS, _LOWEST, _HIGHEST = np.log([b[0] for b in BANDS]), [b[1] for b in BANDS], [b[2] for b in BANDS]
#: A chunk under LOW_CHUNK repeats itself, one over HIGH_CHUNK is noise; a text
#: goes if more than CHUNK_SHARE of its chunks do so.
LOW_CHUNK, HIGH_CHUNK, CHUNK_SHARE = 0.40, 0.75, 0.25

FIELDS = pa.struct([("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
                    ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()),
                    ("kept", pa.bool_()), ("whole_ratio", pa.float64()), ("low_chunks", pa.int64()),
                    ("high_chunks", pa.int64()), ("n_chunks", pa.int64())])


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that the text holds twice or more."""
    if len(words) < 4:
        return 0
    ids: dict[bytes, int] = {}
    at = np.array([ids.setdefault(w, len(ids)) for w in words], dtype=np.int64)
    pairs = at[:-2] * len(ids) + at[1:-1]
    if len(ids) > 2_000_000:  # keep the window's key inside 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs * len(ids) + at[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    twice = np.zeros(len(windows), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words), dtype=bool)
    for shift in range(3):
        covered[shift:len(windows) + shift] |= twice
    return int(covered.sum())


def duplicate_lines(text: bytes) -> int:
    seen: set[bytes] = set()
    found = 0
    for line in text.split(b"\n"):
        if line.strip(SPACE):
            found += line in seen
            seen.add(line)
    return found


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    words = text.split()
    inside = text.translate(None, SPACE)
    return (len(words), len(inside.decode("utf-8", "replace")), len(inside) - len(inside.translate(None, SYMBOLS)),
            duplicate_lines(text), repeated_words(words))


def compression(text: bytes, packer: zstandard.ZstdCompressor) -> tuple[float | None, int, int, int]:
    """(whole ratio, chunks that repeat, chunks of noise, chunks)."""
    whole = len(packer.compress(text)) / len(text) if text else None
    view, low, high, n = memoryview(text), 0, 0, 0
    starts = list(range(0, len(text) - CHUNK + 1, CHUNK))
    if starts and len(text) % CHUNK:
        starts.append(len(text) - CHUNK)
    for start in starts:
        ratio = len(packer.compress(view[start:start + CHUNK])) / CHUNK
        low, high, n = low + (ratio < LOW_CHUNK), high + (ratio > HIGH_CHUNK), n + 1
    return whole, low, high, n


def inside_bands(size: int, whole: float | None, low: int, high: int, n: int) -> bool:
    if size < BANDS[0][0]:
        return True
    lo, hi = np.interp(np.log(size), _LENGTHS, _LOWEST), np.interp(np.log(size), _LENGTHS, _HIGHEST)
    return bool(lo <= whole <= hi and low <= CHUNK_SHARE * n and high <= CHUNK_SHARE * n)


@F.arrow_udf(spark_struct(FIELDS))
def _verdicts(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    packer = zstandard.ZstdCompressor(level=LEVEL)
    for batch in texts:
        rows = []
        for value in batch:
            text = value.as_py() or b""
            counts, packed = base_counts(text), compression(text, packer)
            failed = counts[0] < MIN_WORDS or 100 * counts[4] > MAX_REPEAT_PERCENT * counts[0]
            rows.append((*counts, failed, not failed and inside_bands(len(text), *packed), *packed))
        yield structs(rows, FIELDS)


def verdict(text_col: str = "text") -> Column:
    """A struct of counts, ratios, ``base_failed`` and ``kept`` per text."""
    return _verdicts(text_bytes(text_col))


def keep_quality(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text the rules keep, all columns as they were."""
    return docs.filter(verdict(text_col)["kept"])


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", verdict().alias("v")).select("doc_id", "v.*")
