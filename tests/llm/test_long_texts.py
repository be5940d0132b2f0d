"""Texts beyond a slice: same results, bounded memory; the network against a plain forward pass."""

from __future__ import annotations

import resource
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest

from harborline.llm import bottom_k, byte_cnn, divergence_rules, soft_mixing, unit_hashing
from harborline.llm import byte_text as bt

TEXTS = ["One two  three.\nFour five six seven!\n\nOne two three. Ünï çødé ☃ text\r\n" * 40, "", " \n ", "x" * 700, "a b " * 300 + "é"]


def batch(texts):
    data, off = bt.flat(pa.array(texts))
    return data, off.astype(np.int64)


def results(texts):
    data, off = batch(texts)
    starts, ends, _ = bt.words(data, off)
    counts = divergence_rules.base_counts(data, off)
    w = byte_cnn.init()
    return [*bt.span_hashes(data, (starts, ends), bt.lines(data, off)[:2]), *counts.values(), divergence_rules.class_counts(data, off),
            *unit_hashing.units(data, off, unit_hashing.UNITS, 3).values(), *soft_mixing.features(data, off),
            byte_cnn.predict(w, byte_cnn.taps(w), data, off), *bottom_k.shingle_sets(pa.array(texts), 3)]


@pytest.mark.parametrize("size", [50, 333, 4000])
def test_slices_change_nothing(monkeypatch, size):
    want = results(TEXTS)
    monkeypatch.setattr(bt, "SLICE_BYTES", size)
    monkeypatch.setattr(bt, "_POWERS", [np.ones(1, np.uint64), np.ones(1, np.uint64)])
    monkeypatch.setattr(byte_cnn, "BLOCK", 3)
    for a, b in zip(results(TEXTS), want, strict=True):
        assert np.allclose(a, b) if a.dtype.kind == "f" else np.array_equal(a, b)
    assert len(bt._POWERS[0]) <= size + 1


def test_network_equals_plain_forward_pass():
    w = byte_cnn.init(3)
    data, off = batch(TEXTS)
    for k, score in enumerate(byte_cnn.predict(w, byte_cnn.taps(w), data, off)):
        text = data[off[k]:off[k + 1]].tolist()
        step = byte_cnn.CHUNK - byte_cnn.WIDTH + 1
        maxima = []
        for at in range(0, max(1, len(text) - byte_cnn.WIDTH + 1), step):
            symbols = (text[at:at + byte_cnn.CHUNK] + [byte_cnn.SYMBOLS] * byte_cnn.CHUNK)[:byte_cnn.CHUNK]
            x = w["embedding"][symbols]
            responses = [sum(x[i + t] @ w["filters"][t] for t in range(byte_cnn.WIDTH)) for i in range(step)]
            maxima.append(np.maximum(np.max(responses, axis=0) + w["bias"], 0))
        z = np.concatenate([np.mean(maxima, axis=0), np.max(maxima, axis=0)]) @ w["out"] + w["out_bias"][0]
        assert abs(score - 1 / (1 + np.exp(-z))) < 1e-5


PROBE = """
import resource, sys
import numpy as np, pyarrow as pa
from harborline.llm import bottom_k, byte_cnn, byte_text as bt, divergence_rules, soft_mixing, unit_hashing
rng = np.random.default_rng(1)
words = np.array([f"word{i}" for i in range(5000)])
text = "\\n".join(" ".join(words[rng.integers(0, 5000, 20)]) for _ in range(140_000))
data, off = bt.flat(pa.array([text]))
off = off.astype(np.int64)
del text
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
w = byte_cnn.init()
{call}
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) * 1024 / len(data))
"""


@pytest.mark.parametrize("call,most", [
    ("divergence_rules.base_counts(data, off); divergence_rules.class_counts(data, off)", 25),
    ("soft_mixing.features(data, off)", 25), ("byte_cnn.predict(w, byte_cnn.taps(w), data, off)", 4),
    ("list(bottom_k.shingle_sets(pa.array([data.tobytes().decode()]), 5))", 25),
    ("unit_hashing.units(data, off, unit_hashing.UNITS, 5)", 25)])
def test_memory_a_byte_of_a_long_text(call, most):
    """Extra memory a byte of one text of 25 MB."""
    out = subprocess.run([sys.executable, "-c", PROBE.replace("{call}", call)], capture_output=True, text=True, check=True,
                         cwd=__file__.rsplit("/tests/", 1)[0])
    assert float(out.stdout) < most, out.stdout
    assert resource  # the probe runs in a process of its own, so earlier peaks do not count
