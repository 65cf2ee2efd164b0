"""Statistics of whole texts that the quality operators decide on."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits",
          "n_distinct_words", "n_word_runs", "n_marked_words", "n_bare_lines", "n_top_word", "n_sentence_words")
#: Fixed value: the symbols that n_symbols counts.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
SENTENCE_ENDS = (b".", b"!", b"?")


def repeated_words(ids: np.ndarray) -> int:
    """Words that lie in a window of three words which occurs at least twice in the text."""
    if len(ids) < 4:
        return 0
    _, pairs = np.unique(ids[:-1].astype(np.int64) << 32 | ids[1:], return_inverse=True)
    _, which, counts = np.unique(pairs[:-1].astype(np.int64) << 32 | ids[2:], return_inverse=True, return_counts=True)
    covered = np.zeros(len(ids), bool)
    hit = counts[which] > 1
    for shift in range(3):
        covered[shift:len(ids) - 2 + shift] |= hit
    return int(covered.sum())


def text_counts(text: str | None) -> tuple[int, ...]:
    """One value for each of COUNTS; null and empty texts give zeros."""
    if not text:
        return (0,) * len(COUNTS)
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    seen: set[str] = set()
    dup_lines = bare_lines = n_lines = 0
    for line in text.split("\n"):
        stripped = line.strip(SPACES)
        if not stripped:
            continue
        n_lines += 1
        bare_lines += stripped[-1] not in ".!?\"'"
        if line in seen:
            dup_lines += 1
        else:
            seen.add(line)
    octets = np.frombuffer(raw, np.uint8)
    marked = sum(n for w, n in zip(known, np.bincount(ids, minlength=len(known)).tolist(), strict=True)
                 if w[-1:] not in b".,;:?\"')" and not (w[-1:].isalnum() or w[-1] >= 128)) if words else 0
    return (
        len(words),
        len(text) - sum(text.count(c) for c in SPACES),
        sum(text.count(c) for c in SYMBOLS),
        dup_lines,
        repeated_words(ids),
        n_lines,
        int(np.count_nonzero((octets >= 65) & (octets <= 90))),
        int(np.count_nonzero((octets >= 48) & (octets <= 57))),
        len(known),
        int(np.count_nonzero(ids[1:] == ids[:-1])),
        marked,
        bare_lines,
        int(np.bincount(ids).max()) if words else 0,
        sum(w.endswith(SENTENCE_ENDS) for w in words),
    )


@F.pandas_udf(StructType([StructField(c, LongType()) for c in COUNTS]))
def counted(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        yield pd.DataFrame([text_counts(t) for t in batch], columns=list(COUNTS), dtype="int64")


def ratios(c: Column) -> dict[str, Column]:
    """What rules test: shares of the counts, so a threshold means the same for texts of any length."""
    words = F.greatest(c["n_words"], F.lit(1))
    chars = F.greatest(c["word_chars"], F.lit(1))
    lines = F.greatest(c["n_lines"], F.lit(1))
    return {
        "words": c["n_words"].cast("double"),
        "symbol_share": c["n_symbols"] / chars,
        "symbols_per_word": c["n_symbols"] / words,
        "dup_line_share": c["n_dup_lines"] / lines,
        "repeat_share": c["n_repeat_words"] / words,
        "upper_share": c["n_upper"] / chars,
        "digit_share": c["n_digits"] / chars,
        "distinct_share": c["n_distinct_words"] / words,
        "run_share": c["n_word_runs"] / words,
        "marked_share": c["n_marked_words"] / words,
        "bare_line_share": c["n_bare_lines"] / lines,
        "top_word_share": c["n_top_word"] / words,
        "sentence_share": c["n_sentence_words"] / words,
        "word_length": c["word_chars"] / words,
    }
