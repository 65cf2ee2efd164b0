from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.compare import difference, duck
from tests.llm import helpers
from weftline.llm import filter_audit, periodic_runs, queries, window_packing

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
END = 1


# periodic runs


def plain_runs(words: list) -> list[tuple[int, int, int]]:
    out = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            n = j - i + q
            if j > i and n >= max(6, 4 * q) and not any(
                    all(words[x] == words[x + d] for x in range(i, i + n - d)) for d in range(1, q)):
                out.append((i, n, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def made_up(rng: random.Random) -> list[int]:
    if rng.random() < 0.4:
        return [rng.randint(0, rng.choice([1, 2])) for _ in range(rng.randint(0, 120))]
    words: list[int] = []
    while len(words) < 100:
        period, letters = rng.randint(1, rng.choice([3, 8, 20, 40])), rng.choice([1, 3, 50])
        block = [rng.randint(0, letters) for _ in range(period)]
        words += (block * rng.randint(2, 7))[:-rng.randint(1, period)]
        words += [rng.randint(0, 50) for _ in range(rng.choice([0, 0, 5]))]
    return words


def test_runs_equal_brute_force():
    rng = random.Random(11)
    for _ in range(30):
        texts = [made_up(rng) for _ in range(15)]
        got = periodic_runs.runs_of([np.array(t, np.int64) for t in texts])
        for text, runs in zip(texts, got, strict=True):
            assert [tuple(r) for r in runs.tolist()] == plain_runs(text)


def test_long_runs_of_long_periods():
    block = list(range(5000))
    text = [-7, *block * 4, *block[:17], -9]
    (runs,) = periodic_runs.runs_of([np.array(text, np.int64) + 10])
    assert runs.tolist() == [[1, 20017, 5000]]
    (runs,) = periodic_runs.runs_of([np.zeros(100_000, np.int64)])
    assert runs.tolist() == [[0, 100_000, 1]]


def plain_digest(doc_id: int | None, text: str | None) -> tuple:
    words = WORDS.findall(text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (doc_id, len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_runs_query_equals_brute_force(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter(F.length("text") < 2500)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.QUERIES["op11_synchronised_runs"](spark, str(tmp_path)).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert len(rows) == docs.count()
    assert {tuple(r) for r in rows} == {plain_digest(i, t) for i, t in texts.items()}
    assert any(r["n_runs"] for r in rows)


def test_runs_of_awkward_rows(spark):
    docs = helpers.clashing(helpers.documents(spark)).withColumn("runs", F.lit("x")).withColumn("start", F.lit("y"))
    found = periodic_runs.find(docs)
    assert found.count() == len(helpers.rows())
    by_id = {r["doc_id"]: r for r in found.collect()}
    assert by_id[4]["runs"] == [] and by_id[4]["collapsed"] == "" and by_id[5]["collapsed"] == ""
    assert by_id[9]["collapsed"] == "Ärger ß 漢字 🙂 \xa0 x" and by_id[3]["collapsed"] == "" and by_id[7]["start"] == "y"
    assert by_id[7]["collapsed"] == helpers.LONG or by_id[7]["runs"]
    assert periodic_runs.digests(periodic_runs.find(helpers.empty(spark))).count() == 0
    same = spark.createDataFrame([(1, "a b " * 40), (1, "a b " * 40)], "doc_id long, text string")
    assert periodic_runs.digests(periodic_runs.find(same)).distinct().count() == 1
    assert periodic_runs.find(same).first()["collapsed"] == "a b"


# packing


@pytest.fixture(scope="module")
def description():
    return window_packing.read_description(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_codec_equals_the_library(description, tokenizer, spark, sf):
    codec = window_packing.TextCodec(description, window_packing.letter_table(description))
    texts = [r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    texts += ["", " \t ", "a<|endoftext|>b <|startoftext|>", "ΑΣ ΟΔΟΣ İstanbul é é a b a\x1cc it's I'LL 1234 漢字。\x85z w",
              "x ̀ y", "WORD. word, Word!? w...d '' \"Quoted.\" ½ ²", "Å Ǆ ﬁne ẞ", "a b c"]
    for text in texts:
        assert codec.encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text[:60]


def cheapest(place: list[int], price: list[float], size: int) -> float:
    cost = [0.0]
    for j in range(1, len(place)):
        lengths = [(place[j] - place[i], cost[i]) for i in range(j) if place[j] - place[i] <= size]
        cost.append(price[j] + min(c + (0 if n & (n - 1) == 0 else size - n) for n, c in lengths))
    return cost[-1]


def test_windows_are_the_cheapest():
    rng = random.Random(12)
    for _ in range(200):
        size, place = rng.choice([8, 12, 16, 32]), [0]
        for _ in range(rng.randint(1, 50)):
            place.append(place[-1] + rng.randint(1, min(size, 6)))
        price = [0.0, *[rng.choice([0.0, 1.0, 3.0]) for _ in place[1:]]]
        cost, before = 0.0, 0
        for j in window_packing.best_windows(np.array(place), np.array(price), size):
            n = place[j] - place[before]
            assert 0 < n <= size
            cost += price[j] + (0 if n & (n - 1) == 0 else size - n)
            before = j
        assert before == len(place) - 1 and abs(cost - cheapest(place, price, size)) < 1e-9


def check_packing(rows, expected: Counter, size: int = 2048) -> float:
    """Pieces make up the documents, sequences have no gaps; returns the share of padding."""
    windows, whole, of_doc = defaultdict(list), Counter(), defaultdict(list)
    for r in rows:
        assert len(r["ids"]) > 0 and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        windows[r["sequence_id"]].append((r["offset"], len(r["ids"])))
        of_doc[r["doc_id"], r["doc_tokens"]].append((r["start"], tuple(r["ids"])))
    for pieces in windows.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= size
    for (doc_id, n), pieces in of_doc.items():
        copies = sum(1 for start, _ in pieces if start == 0)
        if copies == 1:
            ids = tuple(i for _, piece in sorted(pieces) for i in piece)
            assert len(ids) == n
            whole[doc_id, ids] += 1
        else:
            assert sum(len(piece) for _, piece in pieces) == copies * n
            whole[doc_id, None] += copies
    for key, n in whole.items():
        assert (expected[key] == n) if key[1] is not None else n == sum(c for k, c in expected.items() if k[0] == key[0])
    assert sum(whole.values()) == sum(expected.values())
    lengths = [sum(n for _, n in pieces) for pieces in windows.values()]
    return sum(0 if n & (n - 1) == 0 else size - n for n in lengths) / max(sum(lengths), 1)


def test_packing_of_the_given_texts(spark, sf, description, tokenizer):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    packed = window_packing.pack(docs.select("doc_id", "text"), description, END)
    expected = Counter((r["doc_id"], (*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, END))
                       for r in docs.collect())
    assert check_packing(packed.collect(), expected) < 0.01
    again = window_packing.pieces(window_packing.pack(docs.select("doc_id", "text"), description, END))
    assert again.exceptAll(window_packing.pieces(packed)).count() == 0
    assert window_packing.pieces(packed).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_packing_of_awkward_rows(spark, description, tokenizer, monkeypatch):
    monkeypatch.setattr(window_packing, "BLOCK_TOKENS", 5000)  # texts longer than a block
    docs = helpers.clashing(helpers.documents(spark)).withColumn("ids", F.lit("x")).withColumn("offset", F.lit("y"))
    packed = window_packing.pack(docs.coalesce(2), description, END)
    expected = Counter((r[0], (*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, END)) for r in helpers.rows())
    assert check_packing(packed.collect(), expected) < 0.02
    assert packed.filter("doc_id = 4").select("start", "ids", "doc_tokens").collect() == [(0, [END], 1)]
    assert {r["key"] for r in packed.select("key").collect()} == {"x"}
    assert window_packing.pack(helpers.empty(spark), description, END).count() == 0


# filter audit


def plain_audit(docs: list[tuple], labels: list[tuple]) -> set[tuple]:
    good, toxic = ({d for d, q, t in labels if (q, t)[k] == 1} for k in (0, 1))
    ids = defaultdict(list)
    for doc_id, text, *_ in docs:
        if doc_id is not None:
            ids[text or ""].append(doc_id)
    cells: dict[tuple, Counter] = defaultdict(Counter)
    for doc_id, text, lang, *_ in docs:
        words, body = WORDS.findall(text or ""), text or ""
        fails = {name for name, bad in zip("ABCDE", (
            len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", body)) > 10 * len(body),
            bool(re.search(r"[#$%&*|]", body)), doc_id is not None and doc_id > min(ids[body])), strict=True) if bad}
        for order in map("".join, permutations("ABCDE")):
            alive = True
            for step, name in enumerate(order, 1):
                cell = cells[lang or "", order, step]
                removed = alive and name in fails
                cell["removed"] += removed
                cell["redundant"] += (not alive) and name in fails
                cell["unique"] += fails == {name}
                cell["good"] += removed and doc_id in good
                cell["toxic"] += removed and doc_id in toxic
                alive &= not removed
                cell["kept"] += alive
    shapley = Counter()
    for (part, order, step), c in cells.items():
        shapley[part, order[step - 1]] += c["removed"]
    return {(part, order, step, *[c[k] for k in ("kept", "removed", "redundant", "unique", "good", "toxic")],
             shapley[part, order[step - 1]]) for (part, order, step), c in cells.items()}


def audited(spark, docs, labels):
    return filter_audit.audit(filter_audit.mask_counts(docs, labels))


def test_audit_of_awkward_rows(spark):
    given = [(1, 1, 0), (1, 0, 1), (2, None, 1), (None, 1, 1), (7, 1, 0), (99, 1, 1), (-10, 0, 0)]
    docs = helpers.clashing(helpers.documents(spark)).withColumn("mask", F.lit("x")).withColumn("part", F.lit("y"))
    got = audited(spark, docs, helpers.labels(spark, given))
    rows = {tuple(r) for r in got.collect()}
    plain = plain_audit(helpers.rows(), [g for g in given if g[0] is not None])
    assert rows == plain and got.count() == len(plain)
    assert audited(spark, helpers.empty(spark), helpers.labels(spark)).count() == 0
    without = audited(spark, helpers.documents(spark), helpers.labels(spark))
    assert without.agg(F.sum("good_lost"), F.sum("toxic_lost")).first() == (0, 0)


def test_audit_of_copies(spark):
    text = "same words " * 60
    docs = [(i, text, "en" if i % 3 else "de") for i in range(500)] + [(None, text, "en")] * 5 + [(0, text, "de")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    got = audited(spark, frame, helpers.labels(spark, [(3, 1, 1), (0, 1, 0)]))
    assert {tuple(r) for r in got.collect()} == plain_audit(docs, [(3, 1, 1), (0, 1, 0)])


def test_intervals_cover_each_order_once():
    covered = Counter((mask, rank) for mask, _, low, high in filter_audit.intervals(5) for rank in range(low, high))
    assert set(covered.values()) == {1} and len(covered) == 31 * 120


def test_audit_query_equals_its_sql(spark, sf):
    con: duckdb.DuckDBPyConnection = duck(sf)
    frame = queries.QUERIES["op13_filter_audit"](spark, sf)
    assert difference(frame, con, queries.ORACLES["op13_filter_audit"]) == (None, frame.count())
