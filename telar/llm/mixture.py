"""A Gaussian mixture with diagonal covariances, fitted by expectation maximisation in numpy."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

FLOOR = 0.02  # least variance of a standardised statistic


@dataclass
class Mixture:
    mean: np.ndarray  # of the raw statistics
    scale: np.ndarray
    weights: np.ndarray
    centres: np.ndarray
    variances: np.ndarray

    def standard(self, x: np.ndarray) -> np.ndarray:
        return (np.asarray(x, np.float64) - self.mean) / self.scale

    def log_parts(self, x: np.ndarray) -> np.ndarray:
        """Log of weight times density, of each row and component."""
        z = self.standard(x)
        inv = 1 / self.variances
        square = (z**2) @ inv.T - 2 * z @ (self.centres * inv).T + (self.centres**2 * inv).sum(1)
        return np.log(self.weights) - 0.5 * (square + np.log(self.variances).sum(1) + z.shape[1] * np.log(2 * np.pi))

    def posterior(self, x: np.ndarray) -> np.ndarray:
        p = self.log_parts(x)
        p = np.exp(p - p.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)


    def sums(self, x: np.ndarray) -> np.ndarray:
        """Per component the weight of the rows and the sums of their squares and values (standardised); the log likelihood is the last row's first."""
        z = self.standard(x)
        inv = 1 / self.variances
        y = np.hstack([z * z, z])
        p = y @ np.hstack([-0.5 * inv, self.centres * inv]).T
        p += np.log(self.weights) - 0.5 * ((self.centres**2 * inv).sum(1) + np.log(self.variances).sum(1) + z.shape[1] * np.log(2 * np.pi))
        top = p.max(1, keepdims=True)
        p -= top
        # Few components matter to a row; what is far below any rounding is 0.
        flat = p.reshape(-1)
        near = np.flatnonzero(flat > -100.0)
        shares = np.exp(flat[near])
        flat[:] = 0
        flat[near] = shares
        total = p.sum(1, keepdims=True)
        p /= total
        out = np.zeros((len(self.weights) + 1, 1 + y.shape[1]))
        out[:-1, 0] = p.sum(0)
        out[:-1, 1:] = p.T @ y
        out[-1, 0] = (top + np.log(total)).sum()
        return out


def begin(mean: np.ndarray, scale: np.ndarray, centres: np.ndarray) -> Mixture:
    """Equal components at the given centres (standardised)."""
    k = len(centres)
    return Mixture(mean, scale, np.full(k, 1 / k), centres.copy(), np.full(centres.shape, 0.5))


def apart(z: np.ndarray, most: int) -> np.ndarray:
    """At most so many of the rows, each as far as can be from those before it."""
    chosen = [0]
    far = ((z - z[0]) ** 2).sum(1)
    while len(chosen) < most and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((z - z[chosen[-1]]) ** 2).sum(1))
    return z[chosen]


def climb(m: Mixture, rounds: int, total: Callable[[Mixture], np.ndarray]) -> Mixture:
    """Expectation maximisation until the likelihood stays; ``total`` gives the sums over all rows under a mixture."""
    before = -np.inf
    width = m.centres.shape[1]
    for _ in range(rounds):
        got = total(m)
        size = got[:-1, 0] + 1e-6
        now = float(got[-1, 0] / got[:-1, 0].sum())
        m.weights = size / size.sum()
        m.centres = got[:-1, 1 + width :] / size[:, None]
        m.variances = np.maximum(got[:-1, 1 : 1 + width] / size[:, None] - m.centres**2, FLOOR)
        if now - before < 1e-5:
            break
        before = now
    return m


def fit(x: np.ndarray, components: int, rounds: int, seed: int = 7) -> Mixture:
    """Components start at rows far from each other (k-means++ with a fixed seed); rows must be in a fixed order."""
    x = np.asarray(x, np.float64)
    mean, scale = x.mean(0), x.std(0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = (x - mean) / scale
    rng = np.random.default_rng(seed)
    chosen = [int(rng.integers(len(z)))]
    far = ((z - z[chosen[0]]) ** 2).sum(1)
    components = min(components, len(np.unique(z, axis=0)))
    while len(chosen) < components:
        chosen.append(int(rng.choice(len(z), p=far / far.sum())))
        far = np.minimum(far, ((z - z[chosen[-1]]) ** 2).sum(1))
    return climb(begin(mean, scale, z[chosen]), rounds, lambda m: m.sums(x))
