"""Toxicity by weak supervision.

Many voters look at a text: words and word beginnings that are typical of labelled toxic texts (a mined lexicon for any
language), a small fixed lexicon, and patterns. A generative label model estimates how often each voter fires for either
class and how strongly voters that fire together depend on each other; correlated voters are discounted. Its posterior
labels train a linear classifier over the voters, which scores every text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

from weftline.llm.common import SAMPLE_ROWS, fold, labelled_sample, with_labels

HOLD_OUT, HELD_FOLD = 4, 2
REJECT = 0.3
#: Mined voters at most, and what a mined term needs: its share of toxic texts, were the classes of one size, and the
#: log likelihood ratio against a term that does not care (about five toxic texts and no clean one).
MINED = 256
MIN_SHARE = 0.95
MIN_EVIDENCE = 9.0
#: Correlations below this are taken for chance.
WEAK = 0.1
RIDGE = 0.5
#: Lengths of word beginnings; the word itself must be longer, so that a bare stem is not taken for its derived forms.
PREFIXES = range(3, 10)
EM_ROUNDS = 25
#: Trust in a given label: the label model may overrule a label by this much.
LABEL_TRUST = 0.97

#: Common insults; patterns over the lower-cased text.
INSULTS = frozenset("idiot idiots moron morons stupid loser losers scum trash worthless pathetic disgusting clown vermin "
                    "filth garbage imbecile dumb".split())
PATTERNS = (
    r"\byou(?: are|'re)? (?:all |such )?(?:an? )?(?:idiot|moron|loser|clown|stupid|trash|scum)",
    r"\b(?:shut up|go to hell|drop dead|kill yourself|hate you)\b",
    r"!{3,}",
)
TOKEN = re.compile(r"[^\W\d_]+")


def terms(text: str) -> set[str]:
    """Distinct lower-cased words, and word beginnings marked with a star."""
    words = set(TOKEN.findall(text.lower()))
    return words | {w[:n] + "*" for w in words for n in PREFIXES if len(w) > n}


@dataclass(frozen=True)
class Voters:
    words: tuple[str, ...]
    starts: tuple[str, ...]

    @property
    def names(self) -> list[str]:
        return [*self.words, *(f"{s}*" for s in self.starts), "insults", *PATTERNS]


class Ballot:
    """Counts of what each voter found in a text; a voter votes toxic if its count is positive, else it abstains."""

    def __init__(self, voters: Voters):
        self.words = {w: i for i, w in enumerate(voters.words)}
        self.starts = {s: len(self.words) + i for i, s in enumerate(voters.starts)}
        self.fixed = len(self.words) + len(self.starts)
        self.size = self.fixed + 1 + len(PATTERNS)
        self.patterns = [re.compile(p) for p in PATTERNS]
        self.lengths = sorted({len(s) for s in voters.starts})
        self.known: dict[str, tuple[int, ...]] = {}

    def hits(self, word: str) -> tuple[int, ...]:
        out = self.known.get(word)
        if out is None:
            found = [self.words[word]] if word in self.words else []
            found += [self.starts[word[:n]] for n in self.lengths if len(word) > n and word[:n] in self.starts]
            if word in INSULTS:
                found.append(self.fixed)
            if len(self.known) > 300_000:
                self.known.clear()
            out = self.known[word] = tuple(found)
        return out

    def cast(self, text: str | None) -> np.ndarray:
        """Counts of each voter over the whole text; all zero for null and empty texts."""
        out = np.zeros(self.size)
        if not text:
            return out
        low = text.lower()
        for word in TOKEN.findall(low):
            for i in self.hits(word):
                out[i] += 1
        for k, pattern in enumerate(self.patterns):
            out[self.fixed + 1 + k] = sum(1 for _ in pattern.finditer(low))
        return out


@dataclass
class LabelModel:
    """How much each voter speaks for toxic, how the voters depend on each other, and the class balance."""

    prior: float
    strength: np.ndarray
    correlation: np.ndarray

    def log_odds(self, votes: np.ndarray) -> np.ndarray:
        """A vote counts less the more correlated voters vote with it; an abstention says nothing."""
        v = votes.astype(float)
        return np.log(self.prior / (1 - self.prior)) - 0.5 + (v / (1 + v @ self.correlation)) @ self.strength

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(votes), -30, 30)))


def dependence(votes: np.ndarray, post: np.ndarray) -> np.ndarray:
    """Correlation of the voters within the classes: of what the class does not explain. Weak ones are set to zero."""
    p1 = (post @ votes) / max(post.sum(), 1e-9)
    p0 = ((1 - post) @ votes) / max((1 - post).sum(), 1e-9)
    rest = votes - post[:, None] * p1 - (1 - post[:, None]) * p0
    spread = np.sqrt(np.maximum((rest**2).mean(axis=0), 1e-9))
    out = np.clip(np.abs(rest.T @ rest) / len(votes) / np.outer(spread, spread), 0, 1)
    out[out < WEAK] = 0.0
    np.fill_diagonal(out, 0.0)
    return out


def label_model(votes: np.ndarray, labels: np.ndarray) -> LabelModel:
    """Expectation maximisation over the class of each text; a given label is one more, noisy, witness."""
    v = votes.astype(float)
    trust = np.log(LABEL_TRUST / (1 - LABEL_TRUST))
    witness = np.where(labels == 1, trust, -trust)
    post = 1 / (1 + np.exp(-witness))
    model = LabelModel(0.5, np.zeros(v.shape[1]), np.zeros((v.shape[1],) * 2))
    for step in range(EM_ROUNDS):
        if step % 8 == 0:
            model.correlation = dependence(v, post)
        toxic = (post @ v + 0.1) / (post.sum() + 1)
        clean = ((1 - post) @ v + 0.02) / ((1 - post).sum() + 1)
        model.strength = np.log(np.maximum(toxic, clean) / clean)  # a voter speaks for toxic or not at all
        model.prior = float(np.clip(post.mean(), 0.005, 0.5))
        fresh = 1 / (1 + np.exp(-np.clip(model.log_odds(votes) + witness, -30, 30)))
        done = np.abs(fresh - post).max() < 1e-5
        post = fresh
        if done:
            break
    return model


def logistic(x: np.ndarray, target: np.ndarray, ridge: float = RIDGE, steps: int = 30) -> tuple[float, np.ndarray]:
    """Ridge logistic regression on soft targets by Newton steps."""
    z = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(z.shape[1])
    pull = np.full(z.shape[1], ridge)
    pull[0] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-6)[:, None]).T @ z + np.diag(pull), z.T @ (p - target) + pull * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0]), w[1:]


@dataclass
class ToxicityModel:
    voters: Voters
    labels: LabelModel
    bias: float
    weights: np.ndarray

    def score(self, text: Column) -> Column:
        """Probability that a text is toxic; null and empty texts get the score of a text without any vote."""
        voters, bias, weights = self.voters, self.bias, self.weights

        def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            ballot = Ballot(voters)
            for batch in texts:
                totals = [bias + float(np.log1p(ballot.cast(t)) @ weights) for t in batch]
                yield pd.Series(1 / (1 + np.exp(-np.clip(totals, -30, 30))), dtype="float64")

        scored.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.Series]}
        return F.pandas_udf(scored, DoubleType())(text)


def mine(sample: DataFrame) -> Voters:
    """Terms of labelled toxic texts. Term counts are made in the tasks and summed; the best MINED come back."""

    def in_parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            toxic: dict[str, int] = {}
            clean: dict[str, int] = {}
            for text, label in zip(batch["text"], batch["_label"], strict=True):
                into = toxic if label == 1 else clean
                for term in terms(text or ""):
                    into[term] = into.get(term, 0) + 1
            names = list(toxic.keys() | clean.keys())
            yield pd.DataFrame({"term": names, "n1": [toxic.get(t, 0) for t in names],
                                "n0": [clean.get(t, 0) for t in names]})

    kind = StructType([StructField("term", StringType()), StructField("n1", IntegerType()), StructField("n0", IntegerType())])
    totals = {r["_label"]: r["count"] for r in sample.groupBy("_label").count().collect()}
    p1 = (totals.get(1, 0) + 0.5) / (totals.get(1, 0) + totals.get(0, 0) + 1)
    counts = sample.select("text", "_label").mapInPandas(in_parts, kind).groupBy("term").agg(
        F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    n1, n0 = F.col("n1"), F.col("n0")
    scaled = n1 * (1 - p1) / p1
    evidence = n1 * F.log(n1 / ((n1 + n0) * p1)) + F.when(n0 > 0, n0 * F.log(n0 / ((n1 + n0) * (1 - p1)))).otherwise(0.0)
    best = counts.filter((n1 > 0) & (scaled / (scaled + n0) >= MIN_SHARE)).withColumn("evidence", evidence).filter(
        F.col("evidence") >= MIN_EVIDENCE).orderBy(F.desc("evidence"), "term").limit(MINED).toPandas()
    found = specific(best)
    return Voters(tuple(t for t in found if not t.endswith("*")), tuple(t[:-1] for t in found if t.endswith("*")))


def specific(best: pd.DataFrame) -> list[str]:
    """Without the word beginnings that owe what they know to one longer term of the table."""
    rows = list(best[["term", "n1", "n0"]].itertuples(index=False))
    out = []
    for term, n1, n0 in rows:
        stem = term[:-1] if term.endswith("*") else None
        if stem is None or not any(
            t != term and t.rstrip("*").startswith(stem) and len(t.rstrip("*")) > len(stem) and m1 >= 0.7 * n1 and m0 <= n0
            for t, m1, m0 in rows
        ):
            out.append(term)
    return out


def vote_table(rows: DataFrame, voters: Voters) -> tuple[np.ndarray, np.ndarray]:
    """Counts and labels of the bounded sample, on the driver; only counts that are not zero travel."""

    def cast(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        ballot = Ballot(voters)
        for batch in texts:
            rows = [ballot.cast(t) for t in batch]
            at = [np.flatnonzero(r) for r in rows]
            yield pd.DataFrame({"at": [a.tolist() for a in at],
                                "n": [r[a].tolist() for r, a in zip(rows, at, strict=True)]})

    cast.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    kind = StructType([StructField("at", ArrayType(IntegerType())), StructField("n", ArrayType(DoubleType()))])
    table = rows.select("doc_id", "_label", F.pandas_udf(cast, kind)("text").alias("v")).select(
        "doc_id", "_label", "v.at", "v.n").toPandas().sort_values(["doc_id", "_label"], kind="stable")
    counts = np.zeros((len(table), Ballot(voters).size))
    for i, (at, n) in enumerate(zip(table["at"], table["n"], strict=True)):
        counts[i, list(at)] = n
    return counts, table["_label"].to_numpy(int)


def may_learn(doc_id: Column) -> Column:
    return fold(doc_id, HOLD_OUT) != HELD_FOLD


def fit(docs: DataFrame, labels: DataFrame, keep: Column | None = None, sample_rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """Fit on at most ``sample_rows`` labelled documents. Without labels the fixed voters alone carry the model."""
    spark: SparkSession = docs.sparkSession
    sample = labelled_sample(labels, "toxic", keep, sample_rows)
    given = spark.createDataFrame(sample.toPandas(), sample.schema) if not sample.isEmpty() else sample
    rows = with_labels(docs.select("doc_id", "text"), given)
    voters = mine(rows)
    counts, y = vote_table(rows, voters)
    votes = counts > 0
    if not len(y):
        size = votes.shape[1]
        return ToxicityModel(voters, LabelModel(0.1, np.full(size, 4.0), np.zeros((size, size))), -3.0, np.full(size, 4.0))
    model = label_model(votes, y)
    bias, weights = logistic(np.log1p(counts), model.posterior(votes))
    return ToxicityModel(voters, model, bias, weights)


def classify(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted. A null id is not held out."""
    scored = docs.select("doc_id", (~may_learn(F.col("doc_id"))).alias("held_out"), model.score(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= REJECT).cast("int"))


def accepted(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The rows of ``docs``, all columns, that the model does not reject."""
    names = docs.columns
    work = docs.select(F.struct(*[docs[n] for n in names]).alias("row"), model.score(docs["text"]).alias("score"))
    return work.filter(F.col("score") < REJECT).select("row.*")
