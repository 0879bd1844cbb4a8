"""Byte convolutional networks in numpy: trained on the driver on a bounded sample, applied in tasks.

Filters of several widths run over the UTF-8 bytes of fixed-length windows, their largest values are taken per window,
and a hidden layer and a softmax follow. A filter over one-hot bytes is a table with a row per byte and position,
so a window's responses are sums of looked-up rows. Windows overlap and cover the whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LENGTH, OVERLAP = 256, 16


@dataclass
class Network:
    """``tables[w]``: filters of width w as (w, 256, filters); then the hidden and the output layer."""

    tables: dict[int, np.ndarray]
    bias: np.ndarray
    hidden: tuple[np.ndarray, np.ndarray]
    output: tuple[np.ndarray, np.ndarray]


def windows(text: str | None, length: int = LENGTH, overlap: int = OVERLAP) -> np.ndarray:
    """The text's bytes as windows (n, length); the last is filled up with spaces. A text without bytes has one."""
    data = (text or "").encode("utf-8", "surrogatepass")
    step = length - overlap
    n = max(1, -(-(len(data) - overlap) // step))
    padded = np.frombuffer(data.ljust((n - 1) * step + length), np.uint8)
    return np.lib.stride_tricks.as_strided(padded, (n, length), (step, 1))


def pooled(net: Network, batch: np.ndarray, places: bool = False):
    """Largest response of each filter in each window, and on request where it is."""
    best, at = [], []
    for width, table in net.tables.items():
        span = batch.shape[1] - width + 1
        total = table[0][batch[:, :span]]
        for j in range(1, width):
            total += table[j][batch[:, j : j + span]]
        if places:
            where = total.argmax(1)
            at.append(where)
            best.append(np.take_along_axis(total, where[:, None, :], 1)[:, 0])
        else:
            best.append(total.max(1))
    return np.concatenate(best, 1) + net.bias, at


def probabilities(net: Network, batch: np.ndarray, rows: int = 256) -> np.ndarray:
    """Class probabilities of each window; memory is bounded by ``rows`` windows."""
    out = []
    for lo in range(0, len(batch), rows):
        x, _ = pooled(net, batch[lo : lo + rows])
        h = np.maximum(np.maximum(x, 0) @ net.hidden[0] + net.hidden[1], 0)
        z = h @ net.output[0] + net.output[1]
        z -= z.max(1, keepdims=True)
        e = np.exp(z)
        out.append(e / e.sum(1, keepdims=True))
    return np.concatenate(out)


def trained(x: np.ndarray, y: np.ndarray, classes: int, widths=(2, 3, 4), filters: int = 16, hidden: int = 32, steps: int = 500, rows: int = 64, seed: int = 7) -> Network:
    """Fit on windows x (n, length) of classes y by ``steps`` steps of Adam; classes weigh alike."""
    rng = np.random.default_rng(seed)
    weight = len(y) / (classes * np.maximum(1, np.bincount(y, minlength=classes)))
    net = Network(
        {w: (rng.standard_normal((w, 256, filters)) * 0.3 / w**0.5).astype(np.float32) for w in widths},
        np.zeros(filters * len(widths), np.float32),
        ((rng.standard_normal((filters * len(widths), hidden)) * (2 / (filters * len(widths))) ** 0.5).astype(np.float32), np.zeros(hidden, np.float32)),
        ((rng.standard_normal((hidden, classes)) * hidden**-0.5).astype(np.float32), np.zeros(classes, np.float32)),
    )
    params = [*net.tables.values(), net.bias, *net.hidden, *net.output]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    order = np.zeros(0, int)
    for step in range(1, steps + 1):
        if len(order) < rows:
            order = np.concatenate((order, rng.permutation(len(x))))
        part, order = order[:rows], order[rows:]
        bx, by = x[part], y[part]
        a0, places = pooled(net, bx, places=True)
        a = np.maximum(a0, 0)
        h0 = a @ net.hidden[0] + net.hidden[1]
        h = np.maximum(h0, 0)
        z = h @ net.output[0] + net.output[1]
        z -= z.max(1, keepdims=True)
        p = np.exp(z)
        p /= p.sum(1, keepdims=True)
        w = weight[by].astype(np.float32) / len(part)
        dz = p
        dz[np.arange(len(part)), by] -= 1
        dz *= w[:, None]
        dh = (dz @ net.output[0].T) * (h0 > 0)
        da = (dh @ net.hidden[0].T) * (a0 > 0)
        grads = []
        for k, (width, table) in enumerate(net.tables.items()):
            g, d = np.zeros_like(table), da[:, k * filters : (k + 1) * filters]
            for j in range(width):
                np.add.at(g[j], (bx[np.arange(len(part))[:, None], places[k] + j], np.arange(filters)[None, :]), d)
            grads.append(g)
        grads += [da.sum(0), a.T @ dh, dh.sum(0), h.T @ dz, dz.sum(0)]
        rate = 0.004 * (1 - step / (steps + 1))
        for q, g, (m, v) in zip(params, grads, moments):
            m *= 0.9
            m += 0.1 * g
            v *= 0.99
            v += 0.01 * g * g
            q -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    return net
