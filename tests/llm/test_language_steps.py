"""The words of many texts are told apart by a few calls, and the gradients of a training step are those of the loss."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pytest

from weftline.llm import gru, language_model

ODD = ["", None, "  ", " a  B\tc ", "\x1fa\x1cb\x0bc\x0cd", "ÀÉa b X y Z", "\x00 z\x85q\r\n", "İX K", "end end\n", "noël"]


def test_words_are_those_of_ascii_white_space_and_case():
    words, upto = language_model.words_of(pa.array(ODD, pa.string()))
    want = [[w.decode() for w in (t or "").encode().lower().split()] for t in ODD]
    found = words.to_pylist()
    assert [found[a:b] for a, b in zip(upto[:-1], upto[1:], strict=True)] == want
    for texts in ([], [None], [" ", ""]):
        words, upto = language_model.words_of(pa.array(texts, pa.string()))
        assert len(words) == 0 and upto.tolist() == [0] * (len(texts) + 1)


def test_ids_are_found_without_a_call_for_each_word():
    known = language_model.ids_of_words([f"h{i}" for i in range(50)], [f"n{i}" for i in range(50)])
    texts = pa.array([" ".join(f"{'hnr'[k % 3]}{k % 70}" for k in range(5_000)), None, "H1 n2 x"] * 4, pa.string())
    calls = [0]

    def called(frame, event, arg) -> None:
        calls[0] += event in ("call", "c_call")

    sys.setprofile(called)
    try:
        words, upto = language_model.words_of(texts)
        at = known.of(words)
    finally:
        sys.setprofile(None)
    assert len(at) == 20_012 and calls[0] < 2_000  # a call or more for each word before
    assert at[upto[2]:upto[3]].tolist() == [1, language_model.NEAR_ID + 2, language_model.RARE]


def test_gradients_are_those_of_the_loss(monkeypatch):
    rng = np.random.default_rng(3)
    output = gru.Output(np.array([0, 0, 0, 1, 1, 2]), np.array([0, 1, 2, 0, 1, -1]), {0: 3, 1: 2})
    model = gru.fresh(8, output, np.array([5.0, 3.0, 2.0]), {0: np.ones(3), 1: np.ones(2)})
    model.words = model.words * np.float32(10)
    model.bias = (rng.normal(size=model.bias.shape) * 0.3).astype(np.float32)
    docs = [rng.integers(0, 6, n).astype(np.int32) for n in (9, 14, 20, 1, 6)]
    monkeypatch.setattr(gru, "LEAST_LANES", 3)  # two documents follow others in their lanes
    names = ("inputs", "into", "bias", "recur", "to_class", "class_bias", "words", "word_bias")
    before = {k: getattr(model, k).copy() for k in names}
    weights = lambda: gru.Gru(**{k: v.copy() for k, v in before.items()})
    total, caught = sum(map(len, docs)), {}
    monkeypatch.setattr(gru.Trainer, "update", lambda self, grads, rate: caught.update({k: g * total for k, g in grads.items()}))
    trainer = gru.Trainer(weights(), output, np.arange(6), 7)
    trainer.learn(docs, (0.02, 0.02))
    rate, root = 0.02 * gru.ROW_RATE / gru.RATE, 4 / gru.HIDDEN
    for k in ("inputs", "words", "word_bias"):  # what a row was moved by, times the root of what it has seen
        moved, seen = before[k] - getattr(trainer.model, k), np.sqrt(trainer.seen[k])
        caught[k] = (moved * (seen[:, None] if moved.ndim == 2 else seen)) / rate
        size = (caught[k]**2).sum(axis=1) * root if moved.ndim == 2 else caught[k]**2
        assert trainer.seen[k] == pytest.approx(1 + size, rel=1e-3)

    def loss(name: str, way: np.ndarray, by: float) -> float:
        other = weights()
        setattr(other, name, (before[name] + by * way).astype(np.float32))
        return -float(gru.score(other, output, np.arange(6), 7, docs).sum())

    for k in names:
        for _ in range(3):
            way = rng.normal(size=before[k].shape)
            way /= np.linalg.norm(way)
            differences = (loss(k, way, 0.02) - loss(k, way, -0.02)) / 0.04
            assert float((caught[k] * way).sum()) == pytest.approx(differences, rel=0.02, abs=0.02), k
