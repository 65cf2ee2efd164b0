"""Byte-level BPE by prefix dynamic programming.

For every prefix of a byte string the table keeps ONE token: the last token of the prefix's encoding. A token that ends
at ``i`` is that token exactly when it may follow the last token of the prefix before it, and "may follow" depends on
the two tokens alone: merging their joined bytes must give the two back. So an encoding is read backwards from the
table, appending bytes only adds entries, and after an edit entries are recomputed only until they agree again.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pieces and token pairs remembered by one Python worker; the memory is emptied when full.
CACHE_PIECES = 400_000
CACHE_PAIRS = 200_000
#: After every rank.
NEVER = 1 << 60
ASCII_CLASSES = {r"\p{L}": "a-zA-Z", r"\p{N}": "0-9"}
BATCH_DOCS = 256


class PrefixBpe:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.longest = max(map(len, ranks), default=1)
        self._follows: dict[bytes, dict[bytes, bool]] = {}
        self._learned = 0
        self._edges: dict[bytes, tuple[list, list]] = {}

    def merged(self, data: bytes) -> list[bytes]:
        """The merge rule itself, for the few bytes of two tokens."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == NEVER:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def edges(self, token: bytes) -> tuple[list[tuple[bytes, int]], list[tuple[bytes, int]]]:
        """While ``token`` is merged from its bytes: the parts that lie at its right end, and those at its left end, each
        with the rank of the merge that takes it up (the largest number for the whole token)."""
        known = self._edges.get(token)
        if known is None:
            parts, right, left = [token[i:i + 1] for i in range(len(token))], [], []
            while len(parts) > 1:
                rank, at = min((self.ranks.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
                if rank == NEVER:
                    break
                if at == len(parts) - 2:
                    right.append((parts[-1], rank))
                if at == 0:
                    left.append((parts[0], rank))
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
            known = self._edges[token] = ([*right, (parts[-1], NEVER)], [*left, (parts[0], NEVER)])
        return known

    def may_follow(self, left: bytes, right: bytes) -> bool:
        """Whether the joined bytes of two tokens merge into just these two.

        Merges happen in rank order. Step through the parts that touch at the seam: if a pair across the seam has a rank
        before the merges that would take its halves up, the two do not stay apart. Of two equal ranks the merge further
        left comes first.
        """
        ends, starts, ranks = self.edges(left)[0], self.edges(right)[1], self.ranks
        i = j = 0
        while True:
            (a, until_a), (b, until_b) = ends[i], starts[j]
            across = ranks.get(a + b, NEVER)
            if across < until_a and across <= until_b and across < NEVER:
                return False
            if until_a == until_b == NEVER:
                return True
            if until_a <= until_b:
                i += 1
            else:
                j += 1

    def extend(self, data: bytes, last: list[bytes]) -> None:
        """Add the last tokens of the prefixes that ``last`` lacks.

        Only one token can be the last one of a prefix, so the order of the trials is free; short ones are right more
        often.
        """
        ranks, follows, longest = self.ranks, self._follows, self.longest
        after = [follows[token] if token in follows else follows.setdefault(token, {}) for token in last]
        for end in range(len(last), len(data) + 1):
            for start in range(end - 1, end - longest - 1 if end > longest else -1, -1):
                token = data[start:end]
                stands = after[start].get(token)
                if stands is None and token in ranks:
                    stands = self.learn(last[start], token)
                if stands:
                    last.append(token)
                    after.append(follows[token] if token in follows else follows.setdefault(token, {}))
                    break
            else:
                raise ValueError("a byte has no token")

    def learn(self, left: bytes, right: bytes) -> bool:
        """Remember whether ``right`` may follow ``left``; nothing is before the first token of a text."""
        if self._learned >= CACHE_PAIRS:
            self._learned = 0
            for known in self._follows.values():
                known.clear()
        self._learned += 1
        stands = self.may_follow(left, right) if left else self.edges(right)[0][-1][0] == right
        self._follows.setdefault(left, {})[right] = stands
        return stands

    def table(self, data: bytes) -> list[bytes]:
        last = [b""]
        self.extend(data, last)
        return last

    def read(self, last: list[bytes]) -> list[int]:
        out, end = [], len(last) - 1
        while end:
            out.append(self.ranks[last[end]])
            end -= len(last[end])
        return out[::-1]

    def encode_piece(self, data: bytes) -> list[int]:
        rank = self.ranks.get(data)
        return [rank] if rank is not None else self.read(self.table(data))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class PrefixTable:
    """The prefix table of one piece, which can grow and be edited."""

    def __init__(self, bpe: PrefixBpe, data: bytes = b""):
        self.bpe, self.data, self.last = bpe, data, bpe.table(data)

    def ids(self) -> list[int]:
        whole = self.bpe.ranks.get(self.data)
        return [whole] if whole is not None else self.bpe.read(self.last)

    def append(self, more: bytes) -> None:
        self.data += more
        self.bpe.extend(self.data, self.last)

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` in place of ``data[start:stop]``; returns how many entries were recomputed.

        An entry depends on the entries of the ``longest`` bytes before it. Once that many in a row equal the entries of
        the old text, whose bytes are the same from the edit on, all later ones do.
        """
        old, shift = self.last, len(new) - (stop - start)
        self.data = self.data[:start] + new + self.data[stop:]
        self.last, same, end = old[:start + 1], 0, start
        while end < len(self.data):
            end += 1
            self.bpe.extend(self.data[:end], self.last)
            same = same + 1 if end > start + len(new) and old[end - shift] == self.last[end] else 0
            if same > self.bpe.longest:
                break
        self.last += old[end - shift + 1:]
        return end - start


def ascii_pattern(pattern: str) -> re.Pattern | None:
    """The same pattern for texts of ASCII only, where letters and digits are plain ranges; None if it has other classes."""
    out, inside, at = [], False, 0
    while at < len(pattern):
        found = next((x for x in ASCII_CLASSES if pattern.startswith(x, at)), None)
        if found:
            out.append(ASCII_CLASSES[found] if inside else f"[{ASCII_CLASSES[found]}]")
            at += len(found)
            continue
        if pattern.startswith(("\\p", "\\P"), at):
            return None
        step = 2 if pattern[at] == "\\" else 1
        inside = (inside or pattern[at] == "[") and pattern[at] != "]"
        out.append(pattern[at:at + step])
        at += step
    return re.compile("".join(out), re.ASCII)


class Codec:
    """Encode and decode whole texts; every match of the pattern is encoded by itself."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.bpe, self.pattern = PrefixBpe(ranks), regex.compile(pattern)
        self.plain = ascii_pattern(pattern)
        codec = self

        class Pieces(dict):
            def __missing__(self, piece: str) -> tuple[int, ...]:
                if len(self) >= CACHE_PIECES:
                    self.clear()
                ids = self[piece] = tuple(codec.bpe.encode_piece(piece.encode("utf-8", "surrogatepass")))
                return ids

        self.pieces = Pieces()

    def split(self, text: str) -> list[str]:
        """The pieces of a text; one of ASCII only goes through the faster standard matcher."""
        return (self.plain if self.plain and text.isascii() else self.pattern).findall(text)

    def encode(self, text: str | None) -> list[int]:
        return list(chain.from_iterable(map(self.pieces.__getitem__, self.split(text or ""))))

    def decode(self, ids: list[int]) -> bytes:
        return self.bpe.decode(ids)


class EncodedText:
    """A text that grows: only its last pieces are split and encoded again.

    A later letter can change a piece at the end, and a contraction (three characters at most) can join pieces that
    began within the last two characters, so the last three pieces are taken up again.
    """

    def __init__(self, codec: Codec, text: str = ""):
        self.codec, self.kept, self.open = codec, [], codec.split(text)
        self._settle()

    def _settle(self) -> None:
        for piece in self.open[:-3]:
            self.kept.extend(self.codec.pieces[piece])
        self.open = self.open[-3:]

    def append(self, text: str) -> None:
        self.open = self.codec.split("".join(self.open) + text)
        self._settle()

    def ids(self) -> list[int]:
        return self.kept + list(chain.from_iterable(map(self.codec.pieces.__getitem__, self.open)))


def read_ranks(path: str) -> bytes:
    """A rank file as it is: about a megabyte, so it can go to every executor. Read on the driver."""
    with open(path, "rb") as f:
        return f.read()


def parse_ranks(raw: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in raw.splitlines() if line)}


_codecs: dict[tuple[int, str], Codec] = {}


def worker_codec(raw: bytes, pattern: str) -> Codec:
    key = (hash(raw), pattern)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(parse_ranks(raw), pattern)
    return _codecs[key]


def list_array(lists: list[list[int]]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, lists)])
    flat = np.fromiter(chain.from_iterable(lists), np.int32, int(ends[-1]))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))


def plain_lists(column: pa.ListArray) -> Iterator[list[int]]:
    """The lists of a list column; null ones as empty. Much faster than element-wise conversion."""
    values, ends = column.values.to_numpy(), column.offsets.to_numpy()
    for start, end, valid in zip(ends[:-1], ends[1:], column.is_valid().to_pylist(), strict=True):
        yield values[start:end].tolist() if valid else []


def encode(docs: DataFrame, raw_ranks: bytes, pattern: str, text: str = "text", out: str = "ids",
           keep: list[str] | None = None) -> DataFrame:
    """The columns of ``docs`` (or only those in ``keep``) and the token ids of ``text`` as array<int> ``out``.

    A column that is named like ``out`` already is replaced.

    A null text is encoded as the empty one: no ids. Repeated rows stay repeated; an empty table gives an empty table.
    Texts are never cut; one long text is one row.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(raw_ranks)
    kept = docs.select(*keep) if keep is not None else docs.drop(out)
    names = kept.columns
    columns = [f"c{i}" for i in range(len(names))]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(shared.value, pattern)
        for whole in parts:
            for start in range(0, whole.num_rows, BATCH_DOCS):
                part = whole.slice(start, BATCH_DOCS)
                ids = [codec.encode(t) for t in part.column(part.num_columns - 1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], list_array(ids)], [*columns, "ids"])

    fields = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(kept.schema.fields))
    given = docs.select(*[docs[n].alias(c) for n, c in zip(names, columns, strict=True)],
                        docs[text].cast("string").alias("text"))
    coded = given.mapInArrow(batches, f"{fields}{', ' if fields else ''}ids array<int>")
    return coded.select(*[F.col(c).alias(n) for n, c in zip(names, columns, strict=True)], F.col("ids").alias(out))


def decode(coded: DataFrame, raw_ranks: bytes, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """All columns but ``ids``, and the bytes the ids stand for as binary ``out``. Null ids give no bytes."""
    shared = coded.sparkSession.sparkContext.broadcast(raw_ranks)
    names = [c for c in coded.columns if c not in (ids, out)]
    columns = [f"c{i}" for i in range(len(names))]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(shared.value, r"(?s:.+)")
        for whole in parts:
            for start in range(0, whole.num_rows, BATCH_DOCS):
                part = whole.slice(start, BATCH_DOCS)
                data = [codec.decode(x) for x in plain_lists(part.column(part.num_columns - 1))]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(data, pa.binary())], [*columns, "data"])

    given = coded.select(*[coded[n].alias(c) for n, c in zip(names, columns, strict=True)], coded[ids].alias("ids"))
    fields = ", ".join(f"c{i} {coded.schema[n].dataType.simpleString()}" for i, n in enumerate(names))
    back = given.mapInArrow(batches, f"{fields}{', ' if fields else ''}data binary")
    return back.select(*[F.col(c).alias(n) for n, c in zip(names, columns, strict=True)], F.col("data").alias(out))


def digests(docs: DataFrame, raw_ranks: bytes, pattern: str) -> DataFrame:
    """doc_id, n_tokens, SHA-256 of the ids and of the decoded bytes."""
    coded = encode(docs, raw_ranks, pattern, keep=["doc_id"]).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), "ids",
    )
    return decode(coded, raw_ranks).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("decoded"), 256).alias("decoded_sha256")
    )
