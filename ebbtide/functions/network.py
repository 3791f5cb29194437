"""NumPy helpers for one small feed-forward network with a single logit.

They run inside Spark tasks on the batches Spark hands them. The parameters are one flat vector;
``layers`` gives the widths, for instance ``(15, 32, 16, 1)``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

# Adam decay rates and denominator term.
BETA1, BETA2, EPSILON = 0.9, 0.999, 1e-8


def shapes(layers: Sequence[int]) -> list[tuple[int, int]]:
    """Per layer (inputs + 1, outputs); the last input row is the bias."""
    return [(fan_in + 1, fan_out) for fan_in, fan_out in zip(layers, layers[1:], strict=False)]


def matrices(weights: np.ndarray, layers: Sequence[int]) -> list[np.ndarray]:
    """Views into the flat vector, one (inputs + 1, outputs) matrix per layer."""
    views, start = [], 0
    for rows, cols in shapes(layers):
        views.append(weights[start : start + rows * cols].reshape(rows, cols))
        start += rows * cols
    return views


def initial_weights(layers: Sequence[int], seed: int) -> np.ndarray:
    """Uniform in +-1/sqrt(inputs), weights and biases alike."""
    rng = np.random.default_rng(seed)
    return np.concatenate(
        [
            rng.uniform(-1.0, 1.0, rows * cols) / np.sqrt(rows - 1)
            for rows, cols in shapes(layers)
        ]
    )


def logits(x: np.ndarray, weights: np.ndarray, layers: Sequence[int]) -> np.ndarray:
    *hidden, last = matrices(weights, layers)
    for w in hidden:
        x = np.maximum(x @ w[:-1] + w[-1], 0.0)
    return (x @ last[:-1] + last[-1])[:, 0]


def loss_and_gradient(
    x: np.ndarray,
    y: np.ndarray,
    weights: np.ndarray,
    layers: Sequence[int],
    keep: np.ndarray | None = None,
) -> tuple[float, np.ndarray]:
    """Mean cross-entropy from logits and its gradient; ``keep`` scales the first hidden layer
    (the dropout mask, already divided by the keep rate)."""
    mats = matrices(weights, layers)
    inputs, active = [x], []
    for depth, w in enumerate(mats[:-1]):
        z = inputs[-1] @ w[:-1] + w[-1]
        gate = (z > 0).astype(x.dtype)
        if depth == 0 and keep is not None:
            gate *= keep
        active.append(gate)
        inputs.append(z * gate)
    z = (inputs[-1] @ mats[-1][:-1] + mats[-1][-1])[:, 0]
    loss = float(np.mean(np.maximum(z, 0) - z * y + np.log1p(np.exp(-np.abs(z)))))

    decay = np.exp(-np.abs(z))
    probability = np.where(z >= 0, 1, decay) / (1 + decay)
    delta = ((probability - y) / len(y))[:, None].astype(x.dtype)
    parts = []
    for depth in range(len(mats) - 1, -1, -1):
        parts += [delta.sum(axis=0), (inputs[depth].T @ delta).ravel()]
        if depth:
            delta = (delta @ mats[depth][:-1].T) * active[depth - 1]
    return loss, np.concatenate(parts[::-1])


class Adam:
    """Adam on a flat vector; ``state`` is weights, both moments and the step count in one."""

    def __init__(self, state: np.ndarray, rate: float) -> None:
        n = (len(state) - 1) // 3
        self.rate = rate
        self.weights, self.first, self.second = (
            state[i * n : (i + 1) * n].astype(np.float32) for i in range(3)
        )
        self.steps = float(state[-1])

    @staticmethod
    def start(weights: np.ndarray) -> np.ndarray:
        return np.concatenate([weights, np.zeros(2 * len(weights) + 1)])

    def step(self, gradient: np.ndarray) -> None:
        self.steps += 1.0
        self.first += np.float32(1 - BETA1) * (gradient - self.first)
        self.second += np.float32(1 - BETA2) * (gradient * gradient - self.second)
        first = self.first / np.float32(1 - BETA1**self.steps)
        second = self.second / np.float32(1 - BETA2**self.steps)
        self.weights -= np.float32(self.rate) * first / (np.sqrt(second) + np.float32(EPSILON))

    def state(self) -> np.ndarray:
        return np.concatenate([self.weights, self.first, self.second, [self.steps]], dtype=float)


def shuffled_batches(
    chunks: Iterator[np.ndarray], size: int, buffer: int, rng: np.random.Generator
) -> Iterator[np.ndarray]:
    """Mini-batches from a stream of row blocks, shuffled in a buffer of about ``buffer`` rows.

    Every row appears once; the last batch may be short. Memory does not grow with the stream.
    """
    held: list[np.ndarray] = []
    rows = 0
    for chunk in chunks:
        held.append(chunk)
        rows += len(chunk)
        if rows >= buffer + size:
            pool = np.concatenate(held)
            pool = pool[rng.permutation(len(pool))]  # many times faster than a shuffle of rows in place
            whole = len(pool) // size * size
            for start in range(0, whole, size):
                yield pool[start : start + size]
            held, rows = [pool[whole:]], len(pool) - whole
    if rows:
        pool = np.concatenate(held)
        pool = pool[rng.permutation(len(pool))]
        for start in range(0, len(pool), size):
            yield pool[start : start + size]
