"""Runs of repeated words by string synchronising sets.

A run is a stretch of consecutive words with smallest period q, at least max(6, 4 q) words long, that no neighbouring word
extends. Texts are independent, so Spark deals them out; inside a task the texts of a batch are joined into one sequence of
word numbers with a separator of its own between any two, which no run can cross.

For every scale t = 4, 8, 16, ... a hash of the t words that begin at a place names the place. A place i is selected when the
least name among i .. i + t stands at one of both ends: the choice depends on the 2 t words from i on alone, so equal contexts
are selected alike. Windows inside a run of a period of at most t / 4 take no part; those highly periodic regions are known
from the finer scales, and their small periods with them. Any other stretch of t places holds a selected one. A run of period
q with t <= q < 2 t therefore holds a selected place i with i + q selected, of equal context, and nothing equal between:
neighbours of equal context propose all periods of the scale. Periods 1 to 3 are read off directly. Proposals are extended and
confirmed word by word; the 64-bit names only propose.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import WORD

#: A run repeats its period this often, and has this many words, at least.
REPEATS, LEAST_WORDS = 4, 6
FIRST_SCALE = 4
#: Characters of the texts that are joined into one sequence; a longer text is a sequence by itself.
BLOCK_CHARS = 1_500_000
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
NOWHERE = np.uint64(0xFFFF_FFFF_FFFF_FFFF)


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, in place (fixed values)."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def stretches(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal stretches of true values."""
    edge = np.flatnonzero(np.diff(hit.view(np.int8), prepend=0, append=0))
    return edge[::2], edge[1::2]


def small_periods(seq: np.ndarray) -> list[np.ndarray]:
    """Runs of periods below the first scale: stretches in which words that far apart are equal."""
    found = []
    for q in range(1, FIRST_SCALE):
        if len(seq) <= q:
            continue
        start, end = stretches(seq[:-q] == seq[q:])
        long = end - start >= (REPEATS - 1) * q
        start, end = start[long], end[long]
        # one to three words have a smaller period only when all are the same
        plain = np.zeros(len(start), bool) if q == 1 else np.ones(len(start), bool)
        for shift in range(1, q):
            plain &= seq[start] == seq[start + shift]
        found.append(np.stack([start, end - start + q, np.full(len(start), q)], 1)[~plain])
    return found


def agreement(seq: np.ndarray, at: np.ndarray, period: np.ndarray, step: int) -> np.ndarray:
    """How many words from ``at`` on, in direction ``step``, equal the word ``period`` places behind them."""
    reach, live, width = np.zeros(len(at), np.int64), np.arange(len(at)), 16
    last = len(seq) - 1
    while len(live):
        rows = max(1, (1 << 20) // width)
        going = []
        for part in (live[i:i + rows] for i in range(0, len(live), rows)):
            here = (at[part] + step * reach[part])[:, None] + step * np.arange(width)
            ahead = np.minimum(here + period[part][:, None], last)
            differs = seq[np.clip(here, 0, last)] != seq[np.maximum(ahead, 0)]
            whole = ~differs.any(1)
            reach[part] += np.where(whole, width, differs.argmax(1))
            going.append(part[whole])
        live, width = np.concatenate(going), min(width * 4, 1 << 14)
    return reach


def proposed(seq: np.ndarray, names: np.ndarray, contexts: np.ndarray, t: int, known: np.ndarray) -> np.ndarray:
    """Runs of the periods t to 2 t - 1, confirmed."""
    names = names.copy()
    periodic = known[(known[:, 2] * REPEATS <= t) & (known[:, 1] >= t) & (known[:, 0] < len(names))]
    if len(periodic):
        cover = np.zeros(len(names) + 1, np.int64)
        np.add.at(cover, periodic[:, 0], 1)
        np.add.at(cover, np.minimum(periodic[:, 0] + periodic[:, 1] - t + 1, len(names)), -1)
        names[np.cumsum(cover[:-1]) > 0] = NOWHERE
    least, width = names, 1
    while width < t:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    head, tail = names[:len(names) - t], names[t:]
    least = np.minimum(least[:len(head)], tail)
    chosen = np.flatnonzero(((least == head) | (least == tail)) & (least != NOWHERE))
    chosen = chosen[np.argsort(contexts[chosen], kind="stable")]
    context = contexts[chosen]
    gap = np.diff(chosen)
    pair = (context[1:] == context[:-1]) & (gap >= t) & (gap < 2 * t)
    at, period = chosen[:-1][pair], gap[pair]
    if not len(at):
        return np.zeros((0, 3), np.int64)
    # proposals of one run overlap: one stretch each
    order = np.lexsort((at, period))
    at, period = at[order], period[order]
    fresh = np.ones(len(at), bool)
    fresh[1:] = (np.diff(period) != 0) | (np.diff(at) > 2 * t)
    first, last = at[fresh], at[np.append(np.flatnonzero(fresh)[1:] - 1, len(at) - 1)]
    period = period[fresh]
    start = first - agreement(seq, first - 1, period, -1)
    end = last + 2 * t + agreement(seq, last + 2 * t, period, 1)
    long = end - start >= (REPEATS - 1) * period
    found = np.unique(np.stack([start, end - start + period, period], 1)[long], axis=0)
    true = [np.array_equal(seq[s:s + n - q], seq[s + q:s + n]) for s, n, q in found.tolist()]
    return found[np.array(true, bool)]


def runs_of(texts: list[np.ndarray]) -> list[np.ndarray]:
    """For every sequence of word numbers its runs as rows (start, length, period), by start and period."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    sizes = np.array([len(texts[i]) for i in order], np.int64)
    firsts = np.cumsum(np.append(1, sizes[:-1] + 1)) if len(sizes) else np.zeros(0, np.int64)
    seq = np.empty(int(sizes.sum()) + len(sizes) + 1, np.int64)
    seq[0] = -1
    for k, i in enumerate(order):
        seq[firsts[k]:firsts[k] + sizes[k]] = texts[i]
        seq[firsts[k] + sizes[k]] = -2 - k
    found = small_periods(seq)
    names, reach, t = mixed(seq.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)), 1, FIRST_SCALE
    while True:
        # longest texts first, so those that can hold a period of this scale are a prefix
        texts_in = int(np.searchsorted(-sizes, -REPEATS * t, side="right"))
        if not texts_in:
            break
        names = names[:int(firsts[texts_in - 1] + sizes[texts_in - 1]) + 2 - reach]
        while reach < t:
            names = mixed(names[:-reach] * np.uint64(0x9E3779B97F4A7C15) + names[reach:])
            reach *= 2
        contexts = mixed(names[:-t] * np.uint64(0x9E3779B97F4A7C15) + names[t:])
        found.append(proposed(seq, names, contexts, t, np.concatenate(found)))
        names, reach, t = contexts, 2 * t, 2 * t
    runs = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    runs = runs[runs[:, 1] >= LEAST_WORDS]
    owner = np.searchsorted(firsts, runs[:, 0], side="right") - 1
    runs[:, 0] -= firsts[owner] if len(runs) else 0
    sort = np.lexsort((runs[:, 2], runs[:, 0], owner))
    runs, owner = runs[sort], owner[sort]
    cuts = np.searchsorted(owner, np.arange(len(order) + 1))
    out: list[np.ndarray] = [runs[:0]] * len(texts)
    for k, i in enumerate(order):
        out[i] = runs[cuts[k]:cuts[k + 1]]
    return out


def collapsed(words: list[bytes], runs: np.ndarray) -> str:
    """The text with one period of each run: words that some run holds after its first period go."""
    if len(runs):
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, runs[:, 0] + runs[:, 2], 1)
        np.add.at(change, runs[:, 0] + runs[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
    return b" ".join(words).decode("utf-8", "surrogatepass")


def block_results(texts: list[str | None]) -> Iterator[tuple[list[dict], str]]:
    known: dict[bytes, int] = {}
    words = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
    numbers = [np.fromiter((known.setdefault(w, len(known)) for w in ws), np.int64, len(ws)) for ws in words]
    for ws, runs in zip(words, runs_of(numbers), strict=True):
        yield [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs.tolist()], collapsed(ws, runs)


def blocks(texts: list[str | None]) -> Iterator[list[str | None]]:
    block: list[str | None] = []
    chars = 0
    for text in texts:
        if block and chars + len(text or "") > BLOCK_CHARS:
            yield block
            block, chars = [], 0
        block.append(text)
        chars += len(text or "")
    if block:
        yield block


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of ``docs`` but the text, with ``runs`` (by start, then period) and ``collapsed``, the text without repeats.

    Null and empty texts and those of white space have no run and an empty collapsed text. Equal rows get equal results, one
    each; an empty table gives an empty table. Existing columns named ``runs`` or ``collapsed`` are replaced. A text is one
    row in one task whatever its length, and needs about 100 bytes of memory a word.
    """
    kept = [c for c in docs.columns if c not in (text, "runs", "collapsed")]
    columns = [f"c{i}" for i in range(len(kept))]
    given = docs.select(*[F.col(f"`{n}`").alias(c) for n, c in zip(kept, columns, strict=True)],
                        F.col(f"`{text}`").cast("string").alias("text"))
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            at = 0
            for block in blocks(part.column(part.num_columns - 1).to_pylist()):
                runs, plain = zip(*block_results(block), strict=True)
                same = part.slice(at, len(block)).columns[:-1]
                at += len(block)
                yield pa.RecordBatch.from_arrays([*same, pa.array(runs, run_type), pa.array(plain, pa.string())],
                                                 [*columns, "runs", "collapsed"])

    fields = "".join(f"{c} {docs.schema[n].dataType.simpleString()}, " for n, c in zip(kept, columns, strict=True))
    done = given.mapInArrow(batches, f"{fields}runs {RUNS}, collapsed string")
    return done.select(*[F.col(c).alias(n) for n, c in zip(kept, columns, strict=True)], "runs", "collapsed")


def repeated_tail(doc_id: Column, text: Column) -> Column:
    """The text of a tenth of the documents with a tail that repeats itself, as the query's contract says; else the text.

    With h = crc32 of the id, g = h / 10 and n words, words from a = g % n on repeat with period 1 + (n - a) / (3 + g % 8),
    when h ends in 0. A null id changes nothing.
    """
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10).cast("long")
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n = F.size(words)
    a = (g % n).cast("int")
    p = (F.floor((n - a) / (3 + g % 8)) + 1).cast("int")
    block = F.slice(words, a + 1, p)
    tail = F.slice(F.flatten(F.array_repeat(block, F.ceil((n - a) / p).cast("int"))), 1, n - a)
    return F.when((h % 10 == 0) & (n > 0), F.array_join(F.concat(F.slice(words, 1, a), tail), " ")).otherwise(text)


def digests(found: DataFrame) -> DataFrame:
    """doc_id, the number of runs, the longest run (ties: smallest start, then period), SHA-256 of runs and collapsed text."""
    longest = F.element_at(
        F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("n"), r["start"], r["period"]))), 1)
    lines = F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"),
        F.lit("\n")))
    shown = found.select("doc_id", "runs", "collapsed", F.when(F.size("runs") > 0, longest).alias("longest"))
    length, period = -F.col("longest.n"), F.col("longest.period")
    return shown.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("longest.start").alias("start"),
        length.alias("length"), period.alias("period"), F.floor(length * 1000 / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
