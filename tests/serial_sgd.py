"""Brute force of the SGD rule."""

import numpy as np


def sgd_serial(W: np.ndarray, H: np.ndarray, xi, yi, r, eta: float) -> None:
    """One sample at a time."""
    dt = W.dtype
    eta = dt.type(eta)
    for a, b, rr in zip(xi, yi, r):
        rr = dt.type(rr)
        e = rr - np.dot(W[a], H[b])
        W[a] = W[a] - eta * (dt.type(-2.0) * e * H[b])
        H[b] = H[b] - eta * (dt.type(-2.0) * e * W[a])
