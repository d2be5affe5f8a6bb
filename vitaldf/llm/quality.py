"""Quality rules: compression bands over whole documents and fixed chunks.

A text that zstandard shrinks far more than prose of its length repeats
itself; one that it hardly shrinks is noise, hashes or encoded data.  The
limits depend on length, since a short text gives the coder little to find.
Base rules on word counts come first.

Nulls and edge cases: a null text counts as empty; an empty text has no
words, no ratio, and fails the base rule.  The measures need one text alone,
so repeated rows and ids behave alike, and other columns pass through.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitaldf.llm.common import free_name, text_or_empty

MIN_WORDS = 50
MAX_REPEATED = (50, 100)    # at most this share of words in repeated 3-word windows
WINDOW = 3
LEVEL = 3
CHUNK_BYTES = 4096
SYMBOLS = b"#*$%&|<>"
#: (bytes below which the band holds, smallest ratio, largest ratio).  A smallest ratio lies under
#: prose of the class's length and above each kind of generated noise that prose can be told from there:
#: random base64 words from 256 bytes, random letters from 1 KB, random hex words from 2 KB
BANDS = ((256, 0.85, 3.0), (384, 1.24, 3.5), (512, 1.32, 3.5), (768, 1.38, 3.5), (1024, 1.5, 3.5),
         (1536, 1.67, 4.5), (2048, 1.76, 4.5), (3072, 1.89, 4.5), (4096, 1.93, 4.5), (6144, 1.96, 6.0),
         (16384, 2.0, 6.0), (None, 2.05, 8.0))
#: the same for one chunk of CHUNK_BYTES
CHUNK_BAND = (1.95, 5.5)
#: share of chunks outside CHUNK_BAND above which the text is rejected
MAX_BAD_CHUNKS = 0.25

MEASURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, "
            "n_repeat_words long, n_bytes long, zstd_bytes long, n_chunks long, n_low_chunks long, "
            "n_high_chunks long")


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside ``window``-word windows that occur twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    code = ids[:n]
    for k in range(1, window):
        _, code = np.unique(code * len(seen) + ids[k:n + k], return_inverse=True)
    twice = np.bincount(code)[code] > 1
    covered = np.zeros(len(words), bool)
    for k in range(window):
        covered[k:n + k] |= twice
    return int(covered.sum())


def measure_text(text: str, coder: zstandard.ZstdCompressor) -> tuple[int, ...]:
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    spaces = len(raw) - len(raw.translate(None, b" \t\n\r\x0b\x0c"))
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    chunks = [raw[i:i + CHUNK_BYTES] for i in range(0, len(raw) - CHUNK_BYTES + 1, CHUNK_BYTES)]
    if len(raw) % CHUNK_BYTES:  # what is left is measured with what precedes it, as a chunk that ends the text
        chunks.append(raw[-CHUNK_BYTES:])
    sizes = [len(coder.compress(c)) for c in chunks] if len(raw) > CHUNK_BYTES else []
    low, high = CHUNK_BAND
    return (len(words), len(text) - spaces, len(raw) - len(raw.translate(None, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words), len(raw),
            len(coder.compress(raw)) if raw else 0, len(sizes),
            sum(CHUNK_BYTES < low * s for s in sizes), sum(CHUNK_BYTES > high * s for s in sizes))


def with_measures(docs: DataFrame, out: str, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct column ``out`` of MEASURES."""
    names = [x.split()[0] for x in MEASURES.split(", ")]

    @F.pandas_udf(MEASURES)
    def measure(texts: pd.Series) -> pd.DataFrame:
        coder = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
        return pd.DataFrame([measure_text(t, coder) for t in texts], columns=names, dtype="int64")

    return docs.withColumn(out, measure(text_or_empty(text_col)))


def band_verdict(m: str):
    """SQL condition: the ratio of ``m``'s text, and of its chunks, is inside its band."""
    def inside(lo, hi):
        size = F.col(f"{m}.zstd_bytes")
        return (F.col(f"{m}.n_bytes") >= F.lit(lo) * size) & (F.col(f"{m}.n_bytes") <= F.lit(hi) * size)

    whole = inside(*BANDS[-1][1:])
    for below, lo, hi in reversed(BANDS[:-1]):
        whole = F.when(F.col(f"{m}.n_bytes") < below, inside(lo, hi)).otherwise(whole)
    bad = F.col(f"{m}.n_low_chunks") + F.col(f"{m}.n_high_chunks")
    return whole & (bad <= F.col(f"{m}.n_chunks") * F.lit(MAX_BAD_CHUNKS))


def base_failed(m: str):
    most, of = MAX_REPEATED
    return ((F.col(f"{m}.n_words") < MIN_WORDS)
            | (of * F.col(f"{m}.n_repeat_words") > most * F.col(f"{m}.n_words")))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: the id, all MEASURES, ``base_failed``, ``ratio`` and ``kept``."""
    measured = with_measures(docs.select(id_col, text_col), "m", text_col)
    return measured.select(
        id_col, "m.*", base_failed("m").alias("base_failed"),
        (F.col("m.n_bytes") / F.nullif(F.col("m.zstd_bytes"), F.lit(0))).alias("ratio"),
        (~base_failed("m") & band_verdict("m")).alias("kept"))


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without those that the base rules or the bands reject."""
    m = free_name(docs, "m")
    return (with_measures(docs, m, text_col).where(~base_failed(m) & band_verdict(m))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
