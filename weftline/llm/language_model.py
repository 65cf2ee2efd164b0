"""Documents scored by the recurrent model: counts, word groups and weights all come from the whole training corpus.

Every training token is counted, and the model is trained on every training document: in each round the workers run over
documents of their own from the same weights, and the mean of what they learn starts the next round. The most frequent words (a bounded number) go to all tasks, each with an input vector; what is left, of any size, stays a table
that the rare words of each document are joined with. A word's class is a group of words that occur in the same kind of
document, cut by frequency into about as many classes as there are words in each, with a softmax inside each; rare and
unknown words belong to the rare class of the group their letters suggest, so the class of any word is known without the
join. The training texts are split into words twice, to count them and to store their ids; all later steps read the ids.

Rows are scored one by one, so repeated rows get equal results; further columns, whatever their names, are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType)

from weftline.llm import gru
from weftline.llm.common import fold
from weftline.session import land

HELD, FOLDS = 2, 7
#: Words known to every task, at most (in the stored ids MARK is a near word, RARE any other), and how often one must occur.
HEAD, HEAD_COUNT, RARE, MARK = 16_384, 3, 65_535, 65_534
#: The next most frequent words, at most so many, are told by id too (from NEAR_ID on): they are rare words to the model, but
#: their groups and counts are known to every task, so they need no join.
NEAR, NEAR_ID = 131_072, 65_536
#: Endings remembered with their group.
ENDINGS = 200_000
#: Classes of words are cut by this power of the counts, so that frequent words are in smaller ones.
EVEN = 0.2
GROUPS = 6
#: Words the documents are grouped by, and rounds of that grouping.
TOP, ROUNDS_OF_GROUPS = 256, 6
#: All documents are trained on once, in so many rounds with means of the weights between them; a corpus that one worker
#: takes (fewer than twice WORKER_TOKENS) needs no means and, when smaller than FEW_TOKENS, is trained on several times.
ROUNDS, WORKER_TOKENS, FEW_TOKENS, MOST_EPOCHS = 4, 2_000_000, 1_000_000, 4
#: Tokens a worker lays out at a time, weights in one row of a table, and workers whose weights are averaged in one task.
BLOCK_TOKENS, CHUNK, FAN = 1_000_000, 1 << 18, 16
#: Bins of the histogram for each doubling of a count.
BINS = 16
FLUSH = 200_000
BATCH_DOCS = 3_000
#: Documents of more words are scored beside those of other batches.
LONG = 4_096
#: Never a word, as it holds a space.
END = " end"


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, A-Z lowered, and where each text's begin (and the last ends). Texts are cut at ASCII white space
    and lowered in ASCII only, as is asked."""
    trimmed = pc.ascii_trim_whitespace(pc.ascii_lower(texts))
    full = pc.fill_null(pc.greater(pc.binary_length(trimmed), 0), False)  # an empty text is one empty word to the split
    lists = pc.ascii_split_whitespace(trimmed)
    lengths = pc.if_else(full, pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    words = (lists if pc.all(full).as_py() is not False else lists.filter(full)).flatten()
    return words, np.append(0, np.cumsum(lengths, dtype=np.int64))


def in_turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches, after each of which Arrow's free memory goes back to the system; else a worker keeps it while it waits."""
    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()


def within(mask: np.ndarray, upto: np.ndarray) -> np.ndarray:
    """Where each text's begin when of all words only those of the mask are kept."""
    return np.append(0, np.cumsum(mask, dtype=np.int64))[upto]


def packed(values: np.ndarray, upto: np.ndarray) -> pa.Array:
    """The bytes of each text's part of ``values``."""
    places = pa.py_buffer((upto * values.itemsize).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(upto) - 1, [None, places, pa.py_buffer(np.ascontiguousarray(values))])


def joined(words: pa.Array, upto: np.ndarray) -> pa.Array:
    """Each text's part of ``words``, joined by blanks."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(upto, pa.int32()), words), " ")


def letters(word: str) -> tuple[str, str]:
    """The endings an unseen word's group is told by, the longer one first."""
    return word[-3:] + ">", word[-2:] + ">"


@dataclass
class Vocabulary:
    """Ids 0..n-1 are head words, then the end, then one id for the rare words of each group."""

    ids: dict[str, int]
    counts: np.ndarray
    groups: np.ndarray
    endings: dict[str, int]
    common_group: int
    output: gru.Output
    as_input: np.ndarray
    start_id: int
    class_counts: np.ndarray
    word_counts: dict[int, np.ndarray]
    near_groups: np.ndarray | None = None  # group of each of the near words

    @property
    def end(self) -> int:
        return len(self.ids)

    def rare_group(self, word: str) -> int:
        return guess(word, self.endings, self.common_group)


def guess(word: str, endings: dict[str, int], common: int) -> int:
    for k in letters(word):
        if k in endings:
            return endings[k]
    return common


def count_words(docs: DataFrame) -> DataFrame:
    """(word, c) over all training documents; every document adds one end."""

    kind = StructType([StructField("word", StringType()), StructField("c", LongType())])

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ends = None, 0
        for batch in in_turn(batches):
            words, _ = words_of(batch.column(0))
            found = words.value_counts()
            own = pa.table({"word": found.field("values"), "c": found.field("counts")})
            if held is not None:
                own = pa.concat_tables([held, own]).group_by("word", use_threads=False).aggregate([("c", "sum")]).rename_columns(["word", "c"])
            held, ends = own, ends + len(batch)
            if len(held) > FLUSH:
                yield from held.to_batches()
                held = None
        if held is not None:
            yield from held.to_batches()
        yield pa.RecordBatch.from_pydict({"word": [END], "c": [ends]})

    return docs.select("text").mapInArrow(parts, kind).groupBy("word").agg(F.sum("c").alias("c")).filter("c > 0")


class Told(dict):
    """Group of a rare word by its last three letters, on which alone it depends."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, ending: str) -> int:
        if len(self) >= ENDINGS:
            self.clear()
        group = self[ending] = self.vocabulary.rare_group(ending)
        return group

    def groups(self, words: pa.Array) -> np.ndarray:
        endings = pc.utf8_slice_codeunits(words, -3).dictionary_encode()
        return np.array([self[e] for e in endings.dictionary.to_pylist()], np.int32)[endings.indices.to_numpy()]


def frequent(counts: DataFrame, most: int, first: int) -> tuple[list[tuple[str, int]], int]:
    """The words above a threshold of the counts that leaves at most ``most``, most frequent first, and how many of them are above
    one that leaves at most ``first``.

    The thresholds are read from a histogram with a bounded number of bins, so no task sends more than what is kept.
    """
    level = F.floor(F.log2(F.col("c")) * BINS).cast("int")
    able = counts.filter(F.col("c") >= HEAD_COUNT)
    bins = sorted(able.groupBy(level.alias("level")).count().collect(), key=lambda r: -r["level"])
    upto = np.cumsum([r["count"] for r in bins])
    within_most, within_first = (int(np.searchsorted(upto, n, side="right")) for n in (most, first))
    if not bins:
        return [], 0
    if not within_most:  # the first bin alone is too large: its words in order
        found = able.filter(level == bins[0]["level"]).orderBy(F.desc("c"), "word").limit(most).collect()
    else:
        found = able.filter(level >= bins[within_most - 1]["level"]).collect()
    words = sorted(((r["word"], r["c"]) for r in found), key=lambda x: (-x[1], x[0]))
    return words, int(upto[within_first - 1]) if within_first else min(first, len(words))


STORED = StructType([StructField("part", IntegerType()), StructField("ids", BinaryType()), StructField("near", BinaryType()),
                     StructField("rare", StringType())])


@dataclass
class Ids:
    """Ids of the head words and of the near words."""

    words: pa.Array
    heads: int

    def of(self, words: pa.Array) -> np.ndarray:
        at = pc.fill_null(pc.index_in(words, value_set=self.words.cast(words.type)), -1).to_numpy(zero_copy_only=False)
        return np.where(at < 0, RARE, np.where(at < self.heads, at, at + (NEAR_ID - self.heads))).astype(np.int32)


def ids_of_words(head: Iterable[str], near: Iterable[str]) -> Ids:
    head = list(head)
    return Ids(pa.array([*head, *near], pa.string()), len(head))


def stored_ids(docs: DataFrame, head: list[str], near: list[str]) -> DataFrame:
    """One row per training document: its round, the ids of its words, those of the near words among them, the words without one."""
    shared = docs.sparkSession.sparkContext.broadcast(ids_of_words(head, near))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_turn(batches):
            words, upto = words_of(batch.column(1))
            at = shared.value.of(words)
            nears, rare = at >= NEAR_ID, at == RARE
            short = np.where(nears, MARK, at).astype(np.uint16)
            yield pa.RecordBatch.from_arrays([batch.column(0), packed(short, upto), packed(at[nears], within(nears, upto)),
                                              joined(words.filter(pa.array(rare)), within(rare, upto))], names=STORED.names)

    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(ROUNDS)).cast("int").alias("part")
    rows = land(docs.select(part, "text").mapInArrow(read, STORED), "ids")
    shared.destroy()
    return rows


def unpacked(ids: bytes) -> np.ndarray:
    return np.frombuffer(ids, np.uint16)


def with_near(ids: bytes, near: bytes) -> np.ndarray:
    """The stored ids with those of the near words in their places."""
    out = unpacked(ids).astype(np.int32)
    out[out == MARK] = np.frombuffer(near, np.int32)
    return out


def features(rows: DataFrame) -> DataFrame:
    """(x) for every document that has one of the TOP most frequent words: the square roots of their shares."""

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = shares_of_top(batch["ids"])
            yield pd.DataFrame({"x": [v.astype(np.float16).tobytes() for v in x[x.any(axis=1)]]})

    return rows.select("ids").mapInPandas(parts, StructType([StructField("x", BinaryType())]))


def shares_of_top(rows: pd.Series) -> np.ndarray:
    x = np.zeros((len(rows), TOP), np.float32)
    for i, ids in enumerate(rows):
        found = unpacked(ids)
        x[i] = np.bincount(found[found < TOP], minlength=TOP)
    return np.sqrt(x / np.maximum(x.sum(axis=1, keepdims=True), 1))


def document_groups(rows: DataFrame) -> np.ndarray:
    """k-means centres of all rows (x). The first centres are drawn by squared distance, with fixed random numbers."""
    unpack = lambda xs: np.frombuffer(b"".join(xs), np.float16).reshape(-1, TOP).astype(np.float32)
    centres = np.zeros((0, TOP), np.float32)
    for turn in range(GROUPS):

        def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            best = None
            for batch in batches:
                if not len(batch):
                    continue
                far = np.maximum(1 - (unpack(batch["x"]) @ centres.T).max(axis=1, initial=0), 0)
                luck = (np.array([zlib.crc32(x, turn) for x in batch["x"]]) + 1.0) / (2.0**32 + 1)
                late = np.where(far > 1e-3, -np.log(luck) / np.maximum(far, 1e-3), np.inf)
                k = int(late.argmin())
                if np.isfinite(late[k]) and (best is None or (late[k], batch["x"].iloc[k]) < best):
                    best = (late[k], batch["x"].iloc[k])
            if best:
                yield pd.DataFrame({"late": [best[0]], "x": [best[1]]})

        kind = StructType([StructField("late", DoubleType()), StructField("x", BinaryType())])
        drawn = rows.mapInPandas(draw, kind).orderBy("late", "x").limit(1).collect()
        if not drawn:
            break
        centres = np.vstack([centres, unpack([drawn[0]["x"]])])
    for _ in range(ROUNDS_OF_GROUPS if len(centres) else 0):

        def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros(centres.shape)
            for batch in batches:
                x = unpack(batch["x"])
                at = (x @ centres.T).argmax(axis=1)
                for g in np.unique(at):
                    total[g] += x[at == g].sum(axis=0)
            g, k = np.nonzero(total)
            yield pd.DataFrame({"g": g, "k": k, "v": total[g, k]})

        kind = StructType([StructField("g", LongType()), StructField("k", LongType()), StructField("v", DoubleType())])
        found = rows.mapInPandas(sums, kind).groupBy("g", "k").agg(F.sum("v").alias("v")).collect()
        moved = np.zeros(centres.shape)
        for r in found:
            moved[r["g"], r["k"]] = r["v"]
        size = np.linalg.norm(moved, axis=1, keepdims=True)
        centres = np.where(size > 0, moved / np.maximum(size, 1e-9), centres).astype(np.float32)
    return centres


def counts_by_group(rows: DataFrame, words: int, centres: np.ndarray) -> np.ndarray:
    """How often each of the head words occurs in the documents of each group, over all documents."""
    out = np.zeros((words, GROUPS))
    if not words or not len(centres):
        return out

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.zeros((GROUPS, words), np.int64)
        for batch in batches:
            at = (shares_of_top(batch["ids"]) @ centres.T).argmax(axis=1)
            for g in np.unique(at):
                found = unpacked(b"".join(batch["ids"][at == g]))
                held[g] += np.bincount(found[found < words], minlength=words)
        g, k = np.nonzero(held)
        yield pd.DataFrame({"g": g, "k": k, "n": held[g, k]})

    kind = StructType([StructField("g", LongType()), StructField("k", LongType()), StructField("n", LongType())])
    sums = rows.select("ids").mapInPandas(parts, kind).groupBy("k", "g").agg(F.sum("n").alias("n")).toPandas()
    out[sums["k"], sums["g"]] = sums["n"]
    return out


def vocabulary(head: list[tuple[str, int]], ends: int, by_group: np.ndarray, rare_total: int) -> Vocabulary:
    """``head`` in order of falling counts; ``by_group``: how often each occurs in each group of documents."""
    ids = {w: i for i, (w, _) in enumerate(head)}
    size = by_group.sum(axis=0) + 1e-9
    own = {w: int((by_group[i] / size).argmax()) for w, i in ids.items() if by_group[i].any()}
    hints: dict[str, np.ndarray] = {}
    for w, g in own.items():
        for k in letters(w):
            hints.setdefault(k, np.zeros(GROUPS))[g] += 1
    rows = np.bincount(list(own.values()) or [0], minlength=GROUPS) + 1.0
    endings = {k: int((v / rows).argmax()) for k, v in hints.items() if v.sum() > 2}
    common = int(rows.argmax())
    groups = np.array([own[w] if w in own else guess(w, endings, common) for w, _ in head] or [], np.int64)
    counts = np.array([c for _, c in head], np.int64)

    classes, place, sizes, word_counts = np.zeros(len(head) + 1 + GROUPS, np.int64), np.full(len(head) + 1 + GROUPS, -1), {}, {}
    totals, n = [], 0
    width = math.isqrt(max(len(head) - 1, 0)) + 1  # classes and words in a class are about equally many
    for g in range(GROUPS):
        mine = np.flatnonzero(groups == g)
        if not len(mine):
            continue
        share = np.cumsum(counts[mine].astype(float)**EVEN)
        parts = -(-len(mine) // width)
        upto = np.searchsorted(share, share[-1] * np.arange(1, parts) / parts)
        for members in (m for m in np.split(mine, upto) if len(m)):
            classes[members] = n
            place[members], sizes[n], word_counts[n] = np.arange(len(members)), len(members), counts[members].astype(float)
            totals.append(counts[members].sum())
            n += 1
    classes[len(head)] = n
    totals.append(ends)
    classes[len(head) + 1:] = n + 1 + np.arange(GROUPS)
    totals.extend([rare_total / GROUPS + 1] * GROUPS)
    as_input = np.arange(len(classes))
    return Vocabulary(ids, counts, groups, endings, common, gru.Output(classes, place, sizes), as_input, len(classes),
                      np.array(totals, float), word_counts)


class Reader:
    """Stored words as the model knows them. Words without an id are not remembered: the endings that tell their group are."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.told = vocabulary, Told(vocabulary)
        # what the model knows a word by: its own id, or that of the rare words of its group
        self.by_id = np.arange(NEAR_ID + len(vocabulary.near_groups if vocabulary.near_groups is not None else ()), dtype=np.int32)
        if vocabulary.near_groups is not None:
            self.by_id[NEAR_ID:] = vocabulary.end + 1 + vocabulary.near_groups

    def whole(self, ids: np.ndarray, groups: np.ndarray, upto: np.ndarray) -> list[np.ndarray]:
        """For each text the ids the model knows, with those of the ``groups`` in the places marked RARE, and the end."""
        known, texts = self.by_id[ids], np.arange(len(upto) - 1)
        known[ids == RARE] = groups + np.int32(self.vocabulary.end + 1)
        out = np.full(len(ids) + len(texts), self.vocabulary.end, np.int32)
        ends = upto[1:] + texts
        inside = np.ones(len(out), bool)
        inside[ends] = False
        out[inside] = known
        return np.split(out, ends[:-1] + 1) if len(texts) else []

    def stored(self, batch: pa.RecordBatch) -> list[np.ndarray]:
        """The texts of some rows (ids, near, rare) of the `stored_ids`."""
        column = lambda k: b"".join(batch.column(k).to_pylist())
        upto = np.append(0, np.cumsum(pc.binary_length(batch.column(0)).to_numpy(zero_copy_only=False), dtype=np.int64)) // 2
        rare = pc.split_pattern(batch.column(2).filter(pc.not_equal(batch.column(2), "")), " ").flatten()
        return self.whole(with_near(column(0), column(1)), self.told.groups(rare), upto)


@dataclass
class LanguageModel:
    vocabulary: Vocabulary
    model: gru.Gru
    tokens: int
    types: int
    ends: int
    counts: DataFrame  # (word, c, grp) of the words outside the head
    rare: dict[int, tuple[int, int, float]]  # group: tokens, types, discount
    near: list[tuple[str, int]]  # words next in frequency to the head, and their counts


LEARNT = StructType([StructField("worker", IntegerType()), StructField("chunk", IntegerType()),
                     StructField("tokens", LongType()), StructField("weights", BinaryType())])


def trained(rows: DataFrame, known: Vocabulary, model: gru.Gru, count: int) -> gru.Gru:
    """The model after truncated backpropagation over every one of the `stored_ids`, which hold ``count`` tokens.

    A round sends the weights out and takes back what each worker changed, in half precision; broadcasts end with their round.
    """
    context = rows.sparkSession.sparkContext
    workers = max(1, min(count // WORKER_TOKENS, context.defaultParallelism))
    rounds = ROUNDS if workers > 1 else 1
    epochs = max(1, min(FEW_TOKENS // max(count, 1), MOST_EPOCHS)) if workers == 1 else 1
    expected = max(1, count // workers // rounds)
    words = context.broadcast(known)
    for turn in range(rounds):
        shared = context.broadcast(model)

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, start = words.value, shared.value.flat()
            model = shared.value.filled(start)  # the broadcast one serves other tasks too
            reader, trainer = Reader(known), gru.Trainer(model, known.output, known.as_input, known.start_id)
            fall = lambda done: gru.RATE * (1 - 0.9 * (turn + min(1.0, done / expected)) / rounds)
            block: list[np.ndarray] = []
            held = done = 0

            def flush() -> None:
                for e in range(epochs):
                    trainer.learn(block, (fall(done + held * e / epochs), fall(done + held * (e + 1) / epochs)))

            for batch in batches:
                for text in reader.stored(batch):
                    block.append(text)
                    held += len(text)
                    if held >= BLOCK_TOKENS:
                        flush()
                        block, held, done = [], 0, done + held
            flush()
            done += held
            if done:
                moved, worker = model.flat() - start, TaskContext.get().partitionId()
                for k in range(0, len(moved), CHUNK):
                    yield pa.RecordBatch.from_arrays([
                        pa.array([worker], pa.int32()), pa.array([k // CHUNK], pa.int32()), pa.array([done], pa.int64()),
                        pa.array([moved[k:k + CHUNK].astype(np.float16).tobytes()], pa.binary())], names=LEARNT.names)

        mine = rows.filter(F.col("part") == turn) if rounds > 1 else rows
        means = mine.select("ids", "near", "rare").coalesce(workers).mapInArrow(learn, LEARNT)
        left = workers
        while left > 1:
            left = -(-left // FAN)
            means = means.withColumn("worker", F.floor(F.col("worker") / FAN).cast("int")).groupBy("worker", "chunk").applyInPandas(
                mean, LEARNT)
        chunks = [r["weights"] for r in sorted(means.select("chunk", "weights").collect())]
        if chunks:
            model = model.filled(model.flat() + np.frombuffer(b"".join(chunks), np.float16).astype(np.float32))
        shared.destroy()
    words.destroy()
    return model


def mean(rows: pd.DataFrame) -> pd.DataFrame:
    """Mean of what the workers changed, each counted by the tokens it was learnt from."""
    total = int(rows["tokens"].sum())
    sums = sum(np.frombuffer(w, np.float16).astype(np.float32) * (n / total)
               for w, n in zip(rows["weights"], rows["tokens"], strict=True))
    return rows.head(1).assign(tokens=total, weights=[sums.astype(np.float16).tobytes()])


@contextmanager
def batches_of_docs(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside get at most BATCH_DOCS rows at a time in their Python workers; more would fill the memory."""
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, str(BATCH_DOCS))
    try:
        yield
    finally:
        spark.conf.set(size, before)


def fit(docs: DataFrame) -> LanguageModel:
    """Learn from all rows of ``docs``: counts, word groups and weights from every token."""
    with batches_of_docs(docs.sparkSession):
        return fitted(docs)


def fitted(docs: DataFrame) -> LanguageModel:
    counts = land(count_words(docs), "counts")
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    ends = (counts.filter(F.col("word") == END).first() or {"c": 0})["c"]
    words = counts.filter(F.col("word") != END)
    known_words, heads = frequent(words, HEAD + NEAR, HEAD)
    head, near = known_words[:heads], known_words[heads:]
    rare_total = total["n"] - ends - sum(c for _, c in head)
    rows = stored_ids(docs, [w for w, _ in head], [w for w, _ in near])
    centres = document_groups(land(features(rows), "features"))
    known = vocabulary(head, ends, counts_by_group(rows, len(head), centres), rare_total)
    told = Told(known)
    known.near_groups = np.array([told[w[-3:]] for w, _ in near], np.int32)
    model = gru.fresh(known.start_id + 1, known.output, known.class_counts, known.word_counts)
    model = trained(rows, known, model, total["n"])

    shared = docs.sparkSession.sparkContext.broadcast(known)

    kind = StructType([StructField("word", StringType()), StructField("c", LongType()), StructField("grp", IntegerType())])

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Words outside the head, with the group their endings tell."""
        heads, told = pa.array([*shared.value.ids], pa.string()), Told(shared.value)
        for batch in in_turn(batches):
            rest = batch.filter(pc.invert(pc.is_in(batch.column(0), value_set=heads)))
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(told.groups(rest.column(0)))], names=kind.names)

    rest = land(words.select("word", "c").mapInArrow(others, kind), "rare")
    rare = {}
    for r in rest.groupBy("grp").agg(F.sum("c").alias("n"), F.count("*").alias("v"), F.count(F.when(F.col("c") == 1, 1)).alias("n1"),
                                     F.count(F.when(F.col("c") == 2, 1)).alias("n2")).collect():
        discount = r["n1"] / (r["n1"] + 2 * r["n2"]) if r["n1"] and r["n2"] else 0.5
        rare[r["grp"]] = (r["n"], r["v"], min(max(discount, 0.1), 0.9))
    return LanguageModel(known, model, total["n"], total["v"], ends, rest, rare, near)


PASS = StructType([
    StructField("doc_id", LongType()), StructField("held_out", BooleanType()), StructField("n_tokens", LongType()),
    StructField("known", LongType()), StructField("logs", DoubleType()), StructField("model", DoubleType()),
    StructField("rare", StringType()),
])


def score(docs: DataFrame, lm: LanguageModel) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, held_out): its probability under the model and under the base.

    Null and empty texts consist of the end alone. An unknown word has the probability of all unknown words of its class
    together, as in the base, where they are one type. Without training documents all words are unknown.
    """
    spark = docs.sparkSession
    near_words, near_c = [w for w, _ in lm.near], np.array([c for _, c in lm.near], np.int64)
    known_as = np.zeros((GROUPS, 2))
    for g, (n, _, d) in lm.rare.items():
        known_as[g] = n, d
    near_share = np.zeros(0)
    if len(near_c):
        n, d = known_as[lm.vocabulary.near_groups].T
        near_share = np.log10((near_c - d) / n)
    ids = ids_of_words(lm.vocabulary.ids, near_words)
    logs, share = np.zeros(NEAR_ID + len(near_c)), np.zeros(NEAR_ID + len(near_c))
    logs[:len(lm.vocabulary.counts)], logs[NEAR_ID:] = np.log10(lm.vocabulary.counts + 1.0), np.log10(near_c + 1.0)
    share[NEAR_ID:] = near_share
    shared = spark.sparkContext.broadcast((lm.vocabulary, lm.model, lm.ends, ids, logs, share))
    group_names = pa.array([str(g) for g in range(GROUPS)])

    def passes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, model, ends, ids, logs, share = shared.value
        reader = Reader(known)
        late: list[pa.RecordBatch] = []
        waiting: list[np.ndarray] = []

        def scored(rows: pa.RecordBatch, texts: list[np.ndarray]) -> pa.RecordBatch:
            total = gru.score(model, known.output, known.as_input, known.start_id, texts)
            return rows.set_column(5, "model", pc.add(rows.column(5), pa.array(total / np.log(10))))

        for batch in in_turn(b for b in batches if len(b)):
            words, upto = words_of(batch.column(1))
            at = ids.of(words)
            rare = at == RARE
            others = words.filter(pa.array(rare))
            groups = reader.told.groups(others)
            texts, long = reader.whole(at, groups, upto), np.diff(upto) > LONG
            doc = np.repeat(np.arange(len(batch), dtype=np.int32), np.diff(upto))
            sums = lambda values: np.bincount(doc, values[at], len(batch))
            rows = pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(2), pa.array(np.diff(upto) + 1), pa.array(np.diff(within(~rare, upto)) + int(ends > 0)),
                pa.array(sums(logs) + np.log10(ends + 1.0)), pa.array(sums(share)),
                joined(pc.binary_join_element_wise(group_names.take(pa.array(groups)), others, ""), within(rare, upto)),
            ], names=PASS.names)
            if long.any():
                late.append(rows.filter(pa.array(long)))
                waiting += [texts[i].copy() for i in np.flatnonzero(long)]
                rows, texts = rows.filter(pa.array(~long)), [texts[i] for i in np.flatnonzero(~long)]
            if texts:
                yield scored(rows, texts)
            if sum(map(len, waiting)) >= BLOCK_TOKENS:
                yield scored(pa.concat_batches(late), waiting)
                late, waiting = [], []
        if waiting:
            yield scored(pa.concat_batches(late), waiting)

    # long documents wait for others, so few steps through the lanes are nearly empty
    with batches_of_docs(spark):
        scanned = land(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), "held_out"
                                   ).mapInArrow(passes, PASS).withColumn("row", F.monotonically_increasing_id()), "scanned")
    words = scanned.filter("rare <> ''").select("row", F.explode(F.split("rare", " ")).alias("marked")).select(
        "row", F.substring("marked", 1, 1).cast("int").alias("grp"), F.expr("substring(marked, 2)").alias("word"))
    if lm.rare:
        shares = F.create_map(*[F.lit(x) for g, (n, v, d) in lm.rare.items() for x in (g, float(n))])
        off = F.create_map(*[F.lit(x) for g, (n, v, d) in lm.rare.items() for x in (g, float(d))])
        inside = lm.counts.select(F.col("word").alias("w"), "c", F.log10((F.col("c") - off[F.col("grp")]) / shares[F.col("grp")]).alias("share"))
        unknown = F.create_map(*[F.lit(x) for g, (n, v, d) in lm.rare.items() for x in (g, float(np.log10(d * v / n)))])[F.col("grp")]
    else:
        inside, unknown = lm.counts.select(F.col("word").alias("w"), "c", F.lit(0.0).alias("share")), F.lit(0.0)
    # every word is once in the counts, so a partition's part of them is a small table of its own
    met = words.join(inside.hint("shuffle_hash"), F.col("word") == F.col("w"), "left")
    sums = met.groupBy(F.col("row").alias("r")).agg(
        F.count("c").alias("rare_known"), F.sum(F.log10(F.coalesce("c", F.lit(0)) + 1.0)).alias("rare_logs"),
        F.sum(F.coalesce("share", unknown, F.lit(0.0))).alias("rare_model"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    base = float(np.log10(lm.tokens + lm.types + 1))
    return scanned.join(sums, F.col("row") == F.col("r"), "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + zero("rare_known")).cast("long").alias("n_known"),
        F.lit(lm.tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + zero("rare_logs") - F.col("n_tokens") * base).alias("base_score"),
        (F.col("model") + zero("rare_model")).alias("score"))


def split(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", (fold(docs["doc_id"], FOLDS) == HELD).alias("held_out"))
