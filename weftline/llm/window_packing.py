"""Packing documents into token windows by an order-preserving dynamic programme.

Documents keep their order and follow one another as one stream of tokens; a window is a stretch of the stream of at most
``size`` tokens. Windows may be cut at the ends of documents (free), after tokens that end a sentence, and, where no such
place is near, after any token of a regular grid; the later two cost a truncation penalty. A window is padded to ``size``
unless its length is a power of two. The programme minimises padding plus penalties over all cuts: the padding of a window
(i, j) is size - P[j] + P[i] with P the tokens before a place, so the best i is the minimum of cost[i] + P[i] over the places
at most ``size`` tokens back, which a queue of rising values keeps in constant time; the few power-of-two lengths are looked
up by their place.

Each task packs the rows of its partition, block by block: what the last window of a block holds goes on into the next block,
so only the end of a partition leaves a window that is not full, and that one falls into power-of-two windows without padding.
No row is shuffled.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tokens of a window.
SIZE = 2048
#: Penalties in tokens of padding: a document cut between sentences, or within one.
SENTENCE_CUT, INNER_CUT = 4.0, 12.0
#: Documents may be cut every so many tokens of the block, for stretches without the end of a sentence.
GRID = 128
#: Shorter windows are made only where the stream ends.
LEAST_WINDOW = 64
#: Tokens that are cut into windows in one go.
BLOCK_TOKENS = 1 << 18
#: Fixed value: the characters that end a sentence.
SENTENCE_ENDS = (".", "!", "?", "…", "。", "！", "？")
WORD_END = "</w>"


class TextCodec:
    """Token ids of whole texts, equal to the tokenizer's own (without special tokens added).

    Texts of Latin letters, digits and marks are cut into the tokenizer's pieces by one expression, and all pieces of a text
    go through a merger of tokens at once (see `letter_table`). Every other text goes through the tokenizer itself.
    """

    def __init__(self, description: str, table: list[tuple[bytes, int]]):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark deals out the cores
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(description)
        vocabulary = self.tokenizer.get_vocab()
        self.ends_sentence = np.zeros(max(vocabulary.values()) + 2, bool)
        # the byte alphabet of the vocabulary, so that endings outside ASCII are found too
        endings = tuple(byte_letters(e.encode()) for e in SENTENCE_ENDS)
        for token, number in vocabulary.items():
            self.ends_sentence[number] = token.removesuffix(WORD_END).rstrip("\"')").endswith(endings)
        self.merger = tiktoken.Encoding("pieces", pat_str=f"[^{STOP}]+{STOP}", special_tokens={},
                                        mergeable_ranks={token: rank for rank, (token, _) in enumerate(table)})
        self.id_of = np.array([number for _, number in table], np.uint32)

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        if not PLAIN(text) or any(s in text for s in SPECIAL):
            ids = self.tokenizer.encode_batch_fast([clean(text)], add_special_tokens=False)[0].ids
            return np.array(ids, np.uint32)
        pieces = (ASCII_PIECES if text.isascii() else LATIN_PIECES)(text.lower())
        return self.id_of[self.merger.encode_ordinary(STOP.join([*pieces, ""]))]


def clean(text: str) -> str:
    """Halves of surrogate pairs, which no tokenizer takes, become replacement characters."""
    return text.encode("utf-8", "surrogatepass").decode("utf-8", "replace")


def byte_alphabet() -> list[str]:
    """The printable letters that byte-level vocabularies use: printable bytes stand for themselves, the others for the
    letters from 256 on, in order (fixed rule)."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


LETTERS = byte_alphabet()


def byte_letters(raw: bytes) -> str:
    return "".join(LETTERS[b] for b in raw)


#: Marks the end of a piece; plain texts do not hold it.
STOP = "\x01"
#: Texts that need no normalisation but small letters: Latin characters without control characters.
PLAIN = re.compile("[\t-\r -~¡-ɏ]*").fullmatch
#: What a plain text may hold that is more than text: special tokens, and the capital whose small form is two characters.
SPECIAL = ("<|", "İ")
#: The digits, and the pieces the tokenizer cuts lowered text into.
DIGITS = "0-9²³¹¼½¾"
ASCII_PIECES = re.compile(r"[a-z]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\sa-z0-9]+").findall
LATIN_LETTERS = "a-z" + "".join(c for c in map(chr, range(161, 592)) if c.isalpha())
LATIN_PIECES = re.compile(
    f"[{LATIN_LETTERS}]+|[{DIGITS}]|'(?:s|t|re|ve|m|ll|d)|[^\\s{LATIN_LETTERS}{DIGITS}]+").findall


def letter_table(description: str) -> list[tuple[bytes, int]]:
    """The tokens in the order in which pairs merge, as bytes with ``STOP`` for the end of a piece, and their ids.

    With it a merger that knows tokens only, and not the pairs they are made of, gives what the tokenizer gives on a piece. For
    that a token must come out whole when it is encoded alone, which is tested here; others never come out and are
    left out. Proof: say two neighbours join to a known token by another pair than the tokenizer's. No merge has crossed the
    token's borders yet, so the merges within them are those of the token alone, in the same order, and there the last two
    parts are the tokenizer's pair. The first entries are the single bytes, then those that end a piece, so a last byte and
    its stop join first.
    """
    from tokenizers import Tokenizer

    bare = json.loads(description) | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}}
    model = bare["model"]
    ending = Tokenizer.from_str(json.dumps(bare))
    model["end_of_word_suffix"] = None
    inner = Tokenizer.from_str(json.dumps(bare))
    octet = {letter: bytes([b]) for b, letter in enumerate(LETTERS)}
    vocabulary, stop = model["vocab"], STOP.encode()
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    table = [(bytes([b]), vocabulary[byte_letters(bytes([b]))]) for b in range(256)]
    table += [(bytes([b]) + stop, vocabulary[byte_letters(bytes([b])) + WORD_END]) for b in range(256)]
    known = {token for token, _ in table}
    merged = dict.fromkeys("".join(pair) for pair in pairs)
    whole = set()
    for way, last in ((ending, True), (inner, False)):
        chosen = [t for t in merged if t.endswith(WORD_END) == last]
        coded = way.encode_batch_fast([t.removesuffix(WORD_END) for t in chosen], add_special_tokens=False)
        whole |= {t for t, c in zip(chosen, coded, strict=True) if c.ids == [vocabulary[t]]}
    for token in merged:
        spelt = b"".join(octet[c] for c in token.removesuffix(WORD_END))
        if token in whole and stop not in spelt:
            spelt += stop if token.endswith(WORD_END) else b""
            if spelt not in known:
                known.add(spelt)
                table.append((spelt, vocabulary[token]))
    return table


#: Fixed value: the capital whose small form differs at the end of a word.
FINAL = "Σ"


def cuts(tokens: list[np.ndarray], ends_sentence: np.ndarray, last: bool, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the stream of the documents may be cut, from 0 to its length, and what a cut costs there."""
    total = sum(map(len, tokens))
    price = np.full(total + 1, np.inf)
    at = 0
    for ids in tokens:
        price[at + 1:at + len(ids) + 1][ends_sentence[ids]] = SENTENCE_CUT
        at += len(ids)
        price[at] = 0.0
    price[0] = 0.0
    grid = np.arange(0, total, GRID)
    if last:  # the rest falls into power-of-two windows, wherever they end
        grid = np.concatenate([grid, np.arange(max(0, total - size), total)])
    price[grid] = np.minimum(price[grid], INNER_CUT)
    place = np.flatnonzero(price < np.inf)
    return place, price[place]


def best_windows(place: np.ndarray, price: np.ndarray, size: int, least: int = 1) -> list[int]:
    """The places (numbers into ``place``) where the cheapest windows end, first to last. Ties: the longest window.

    Windows without padding have at least ``least`` tokens.
    """
    tokens, prices = place.tolist(), price.tolist()
    number = np.full(tokens[-1] + 1, -1)
    number[place] = np.arange(len(place))
    exact: dict[int, list[int]] = {}  # the places a power of two before a place, the farthest first
    for power in (1 << k for k in reversed(range(size.bit_length())) if least <= 1 << k <= size):
        before = place - power
        before = np.where(before >= 0, number[np.maximum(before, 0)], -1)
        for j in np.flatnonzero(before >= 0).tolist():
            exact.setdefault(j, []).append(int(before[j]))
    cost, back = [0.0], [0]
    queue: deque[tuple[float, int, int]] = deque([(0.0, 0, 0)])  # cost[i] + P[i], P[i], i; rising
    for j in range(1, len(tokens)):
        here = tokens[j]
        while queue[0][1] < here - size:
            queue.popleft()
        value, _, i = queue[0]
        value += size - here
        if j in exact:
            for k in exact[j]:
                if cost[k] < value:
                    value, i = cost[k], k
        value += prices[j]
        cost.append(value)
        back.append(i)
        key = value + here
        while queue and queue[-1][0] > key:
            queue.pop()
        queue.append((key, here, j))
    ends, j = [], len(tokens) - 1
    while j:
        ends.append(j)
        j = back[j]
    return ends[::-1]


class Packer:
    """Cuts documents, in the order given, into windows; rows are (key, start, ids, tokens of the document, window, offset)."""

    def __init__(self, ends_sentence: np.ndarray, size: int = SIZE, first: int = 0):
        self.ends_sentence, self.size, self.window = ends_sentence, size, first
        self.open: list[tuple[int, int, np.ndarray, int]] = []  # key, start, ids, tokens of the document
        self.tokens = 0

    def add(self, key: int, ids: np.ndarray) -> Iterator[tuple]:
        for start in range(0, len(ids), BLOCK_TOKENS):
            part = ids[start:start + BLOCK_TOKENS]
            self.open.append((key, start, part, len(ids)))
            self.tokens += len(part)
            if self.tokens >= BLOCK_TOKENS:
                yield from self.cut(False)

    def cut(self, last: bool) -> Iterator[tuple]:
        """Windows of what is open; all but the last windows of a block, whose tokens stay open, unless it is the last block."""
        if not self.open:
            return
        place, price = cuts([ids for _, _, ids, _ in self.open], self.ends_sentence, last, self.size)
        ends = [int(place[j]) for j in best_windows(place, price, self.size, 1 if last else LEAST_WINDOW)]
        if not last:
            # the end of a block isn't the end of the stream: windows near it are chosen anew
            ends = [e for e in ends if e <= self.tokens - 2 * self.size]
        begin, held, used = 0, iter(self.open), 0
        row = next(held)
        for end in ends:
            offset = 0
            while begin < end:
                key, start, ids, whole = row
                piece = ids[used:used + end - begin]
                yield key, start + used, piece, whole, self.window, offset
                offset, begin, used = offset + len(piece), begin + len(piece), used + len(piece)
                if used == len(ids):
                    row, used = next(held, None), 0
            self.window += 1
        self.tokens -= begin
        rest = [] if row is None else [(row[0], row[1] + used, row[2][used:], row[3])]
        self.open = [*rest, *held]


_codecs: dict[int, TextCodec] = {}


def worker_codec(description: str, table: list[tuple[bytes, int]]) -> TextCodec:
    key = hash(description)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = TextCodec(description, table)
    return _codecs[key]


def read_description(path: str) -> str:
    """A tokenizer file as it is, a few megabytes: read on the driver, so executors need no such path."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def pack(docs: DataFrame, description: str, end_id: int, text: str = "text", size: int = SIZE) -> DataFrame:
    """One row per piece: the columns of ``docs`` but the text, and start, ids, ids_crc32 (CRC-32 of the
    ids as little-endian unsigned 32-bit numbers), doc_tokens, sequence_id, offset.

    A document is its token ids and ``end_id``; null and empty texts are ``end_id`` alone. Pieces of a document join up to it
    by ``start``; pieces of a sequence by ``offset``, from 0 without gaps. A sequence has at most ``size`` tokens and is
    padded to ``size`` unless its length is a power of two. Repeated rows are packed each for itself, an empty table gives an
    empty table, columns of ``docs`` that are named like a result are replaced. Documents keep the order they have in their
    partition; sequence ids rise with it, unique but not gapless. The result follows the partitions of ``docs``: reruns agree
    on stored tables; write the rows of a shuffle first. A task holds a block of tokens and the text at hand.
    """
    made = ("start", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    kept = [c for c in docs.columns if c != text and c not in made]
    columns = [f"c{i}" for i in range(len(kept))]
    shared = docs.sparkSession.sparkContext.broadcast((description, letter_table(description)))
    given = docs.select(*[F.col(f"`{n}`").alias(c) for n, c in zip(kept, columns, strict=True)],
                        F.col(f"`{text}`").cast("string").alias("text"), F.spark_partition_id().alias("part"))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(*shared.value)
        end = np.array([end_id], np.uint32)
        packer, rows, schema = None, [], None
        held: dict[int, pa.RecordBatch] = {}  # rows of documents that are not packed to the end

        def flush() -> pa.RecordBatch:
            keys, start, ids, whole, window, offset = zip(*rows, strict=True)
            ends = np.cumsum([0, *map(len, ids)])
            sums = [zlib.crc32(piece.astype("<u4").tobytes()) for piece in ids]
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids).view(np.int32)))
            same = pa.Table.from_batches([held[k] for k in keys], schema).combine_chunks().to_batches()
            same = same[0].columns if same and columns else []
            rows.clear()
            alive = {r[0] for r in packer.open}
            for key in [k for k in held if k not in alive]:
                del held[key]
            return pa.RecordBatch.from_arrays(
                [*same, pa.array(start, pa.int64()), lists, pa.array(sums, pa.int64()), pa.array(whole, pa.int64()), pa.array(window, pa.int64()),
                 pa.array(offset, pa.int32())], [*columns, *made])

        number = 0
        for part in parts:
            if packer is None and part.num_rows:
                packer = Packer(codec.ends_sentence, size, part.column(part.num_columns - 1)[0].as_py() << 40)
            keep = part.select(columns)
            schema = keep.schema
            for i, given_text in enumerate(part.column(part.num_columns - 2).to_pylist()):
                held[number] = keep.slice(i, 1)
                rows.extend(packer.add(number, np.concatenate([codec.encode(given_text), end])))
                number += 1
                if len(rows) >= 2000:
                    yield flush()
        if packer is not None:
            rows.extend(packer.cut(True))
            if rows:
                yield flush()

    fields = "".join(f"{c} {docs.schema[n].dataType.simpleString()}, " for n, c in zip(kept, columns, strict=True))
    packed = given.mapInArrow(
        batches, f"{fields}start bigint, ids array<int>, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset int")
    return packed.select(*[F.col(c).alias(n) for n, c in zip(kept, columns, strict=True)], "start", "ids", "ids_crc32",
                         "doc_tokens", "sequence_id", F.col("offset").cast("long").alias("offset"))


def pieces(packed: DataFrame) -> DataFrame:
    """Of every piece its place, length and checksum."""
    return packed.select("doc_id", "start", F.size("ids").cast("long").alias("length"), "ids_crc32", "doc_tokens",
                         "sequence_id", "offset")
