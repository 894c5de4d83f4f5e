"""A bidirectional gated recurrent network over bytes in numpy, trained by backpropagation through time.

Texts are read in windows of a fixed number of bytes, padded with zero bytes. Arrays have the batch
last and both directions in front: direction 0 reads a window forward, direction 1 backward. The
input weights are a table with a column per byte value, so the input step is a lookup.
"""

from __future__ import annotations

import numpy as np


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def start(hidden: int, labels: int, seed: int) -> dict[str, np.ndarray]:
    draw = np.random.default_rng(seed)
    make = lambda *shape: draw.normal(0, 0.3, shape).astype(np.float32)
    return {"table": make(2, 3 * hidden, 256), "state": make(2, 3 * hidden, hidden), "out": make(labels, 2 * hidden),
            "bias": np.zeros((labels, 1), np.float32)}


def _read(model: dict, windows: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Hidden states (step, direction * hidden, batch), each at the byte it stands for. windows: (steps, batch)."""
    steps, batch = windows.shape
    hidden = model["state"].shape[2]
    out = np.empty((steps, 2, hidden, batch), np.float32)
    h = np.zeros((2, hidden, batch), np.float32)
    g = np.empty((2, 3 * hidden, batch), np.float32)
    for t in range(steps):
        for d, at in ((0, t), (1, steps - 1 - t)):
            np.take(model["table"][d], windows[at], axis=1, out=g[d], mode="clip")
        a = model["state"] @ h
        gates = g[:, : 2 * hidden] + a[:, : 2 * hidden]
        _sigmoid(gates)
        z, r = gates[:, :hidden], gates[:, hidden:]
        n = a[:, 2 * hidden :] * r
        n += g[:, 2 * hidden :]
        np.multiply(n, 2, out=n)
        n = _sigmoid(n)
        n *= 2
        n -= 1
        if keep is not None:
            keep.append((h, z, r, n, a[:, 2 * hidden :]))
        h = h - n
        h *= z
        h += n
        out[t, 0], out[steps - 1 - t, 1] = h[0], h[1]
    return out.reshape(steps, 2 * hidden, batch)


def _softmax(logits: np.ndarray) -> np.ndarray:
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def positions(model: dict, windows: np.ndarray) -> np.ndarray:
    """Label probabilities (step, label, batch) at every byte."""
    return _softmax(model["out"] @ _read(model, windows) + model["bias"])


def gradient(model: dict, windows: np.ndarray, there: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross-entropy over the positions that are `there` (step, batch), and its gradient."""
    keep: list = []
    states = _read(model, windows, keep)
    steps, both, batch = states.shape
    hidden = both // 2
    p = _softmax(model["out"] @ states + model["bias"])
    weight = there.astype(np.float32) / max(1, there.sum())
    loss = float(-(np.log(p[:, labels, np.arange(batch)] + 1e-9) * weight).sum())
    p[:, labels, np.arange(batch)] -= 1
    p *= weight[:, None, :]
    into = model["out"].T @ p
    grad = {"out": np.einsum("tlb,thb->lh", p, states, optimize=True), "bias": p.sum(axis=(0, 2))[:, None], "state": np.zeros_like(model["state"])}
    dg = np.empty((steps, 2, 3 * hidden, batch), np.float32)
    dh = np.zeros((2, hidden, batch), np.float32)
    back = np.transpose(model["state"], (0, 2, 1))
    for t in range(steps - 1, -1, -1):
        h, z, r, n, a_n = keep[t]
        dh[0] += into[t, :hidden]
        dh[1] += into[steps - 1 - t, hidden:]
        dn = dh * (1 - z) * (1 - n * n)
        dz = dh * (h - n) * z * (1 - z)
        dr = dn * a_n * r * (1 - r)
        da = np.concatenate([dz, dr, dn * r], axis=1)
        dg[t] = np.concatenate([dz, dr, dn], axis=1)
        grad["state"] += da @ np.transpose(h, (0, 2, 1))
        dh = dh * z + back @ da
    table = np.empty_like(model["table"])
    for d, order in ((0, windows), (1, windows[::-1])):
        values = order.ravel()
        for row in range(3 * hidden):
            table[d, row] = np.bincount(values, weights=dg[:, d, row].ravel(), minlength=256)
    grad["table"] = table
    return loss, grad


def fit(windows: np.ndarray, lengths: np.ndarray, labels: np.ndarray, classes: int, hidden: int = 8, epochs: int = 5, batch: int = 256,
        rate: float = 0.02, seed: int = 1) -> dict[str, np.ndarray]:
    """Train on windows (batch, steps) of which the first `lengths` bytes count. Adam, falling rate."""
    model = start(hidden, classes, seed)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.items()}
    draw, done, total = np.random.default_rng(seed), 0, epochs * -(-len(windows) // batch)
    for _ in range(epochs):
        order = draw.permutation(len(windows))
        for at in range(0, len(order), batch):
            some = order[at : at + batch]
            there = np.arange(windows.shape[1])[:, None] < lengths[some][None, :]
            _, grad = gradient(model, np.ascontiguousarray(windows[some].T), there, labels[some])
            size = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            done += 1
            step = rate * (1 - done / (total + 1)) * np.sqrt(1 - 0.999**done) / (1 - 0.9**done)
            for name, g in grad.items():
                g = g * min(1.0, 1.0 / (size + 1e-9))
                first, second = moments[name]
                first += 0.1 * (g - first)
                second += 0.001 * (g * g - second)
                model[name] -= (step * first / (np.sqrt(second) + 1e-8)).astype(np.float32)
    return model
