"""A bidirectional gated recurrent network with attention pooling, forward and backward in numpy.

Inputs are rows of features picked by index, so the input side of the gates is computed once per
distinct word; ``mask`` marks real places.  At a padded place the state passes through unchanged.
"""

from __future__ import annotations

import numpy as np

Params = dict[str, np.ndarray]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def init(features: int, hidden: int, attention: int, seed: int = 7) -> Params:
    rng = np.random.default_rng(seed)

    def normal(*shape):
        return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

    p: Params = {}
    for side in "fb":
        p[f"W{side}"], p[f"U{side}"] = normal(features, 3 * hidden), normal(hidden, 3 * hidden)
        p[f"c{side}"] = np.zeros(3 * hidden, np.float32)
    p["A"], p["a0"] = normal(2 * hidden, attention), np.zeros(attention, np.float32)
    p["v"], p["o"] = normal(attention), normal(2 * hidden)
    p["o0"] = np.zeros(1, np.float32)
    return p


def project(p: Params, x: np.ndarray) -> dict[str, np.ndarray]:
    """The input side of all gates for each row of features."""
    return {side: x @ p[f"W{side}"] + p[f"c{side}"] for side in "fb"}


def _run(p: Params, side: str, projected: np.ndarray, at: np.ndarray, mask: np.ndarray, keep: list | None):
    n, steps = at.shape
    u = p[f"U{side}"]
    size = u.shape[0]
    h = np.zeros((n, size), np.float32)
    out = np.empty((steps, n, size), np.float32)
    places = range(steps) if side == "f" else range(steps - 1, -1, -1)
    whole = bool(mask.all())
    for t in places:
        x, hu = projected[at[:, t]], h @ u
        zr = sigmoid(x[:, : 2 * size] + hu[:, : 2 * size])
        z, r = zr[:, :size], zr[:, size:]
        candidate = np.tanh(x[:, 2 * size :] + r * hu[:, 2 * size :])
        new = candidate + z * (h - candidate)
        if not whole:
            new = np.where(mask[:, t, None], new, h)
        if keep is not None:
            keep.append((t, h, z, r, candidate, hu[:, 2 * size :]))
        h = out[t] = new
    return out


def forward(p: Params, projected: dict[str, np.ndarray], at: np.ndarray, mask: np.ndarray, keep: dict | None = None):
    """Logits of windows; ``at`` (windows, places) indexes the rows of ``projected``."""
    kept_f, kept_b = ([], []) if keep is not None else (None, None)
    states = np.concatenate(
        [_run(p, "f", projected["f"], at, mask, kept_f), _run(p, "b", projected["b"], at, mask, kept_b)], axis=2
    )
    inner = np.tanh(states @ p["A"] + p["a0"])
    score = np.where(mask.T, inner @ p["v"], -1e9)
    score = np.exp(score - score.max(axis=0))
    share = score / score.sum(axis=0)
    pooled = np.einsum("tn,tnk->nk", share, states)
    if keep is not None:
        keep.update(f=kept_f, b=kept_b, states=states, inner=inner, share=share, pooled=pooled)
    return pooled @ p["o"] + p["o0"][0]


def backward(p: Params, x: np.ndarray, at: np.ndarray, mask: np.ndarray, k: dict, d_logit: np.ndarray) -> Params:
    """Gradients of the sum of ``d_logit`` times the logits."""
    g = {name: np.zeros_like(v) for name, v in p.items()}
    states, inner, share = k["states"], k["inner"], k["share"]
    size = p["Uf"].shape[0]
    g["o"] = k["pooled"].T @ d_logit
    g["o0"] = np.array([d_logit.sum()], np.float32)
    d_pooled = d_logit[:, None] * p["o"]
    d_share = np.einsum("nk,tnk->tn", d_pooled, states)
    d_score = share * (d_share - (share * d_share).sum(axis=0))
    g["v"] = np.einsum("tn,tna->a", d_score, inner)
    d_inner = d_score[:, :, None] * p["v"] * (1 - inner**2)
    g["A"] = np.einsum("tnk,tna->ka", states, d_inner)
    g["a0"] = d_inner.sum(axis=(0, 1))
    d_states = share[:, :, None] * d_pooled + d_inner @ p["A"].T
    for side, cut in (("f", slice(0, size)), ("b", slice(size, None))):
        u, carried = p[f"U{side}"], np.zeros((at.shape[0], size), np.float32)
        for t, h, z, r, candidate, hun in reversed(k[side]):
            real = mask[:, t, None]
            total = d_states[t][:, cut] + carried
            d_new = np.where(real, total, 0)
            d_candidate = d_new * (1 - z) * (1 - candidate**2)
            d_z = d_new * (h - candidate) * z * (1 - z)
            d_r = d_candidate * hun * r * (1 - r)
            gates = np.concatenate([d_z, d_r, d_candidate], axis=1)
            through = np.concatenate([d_z, d_r, d_candidate * r], axis=1)
            g[f"W{side}"] += x[at[:, t]].T @ gates
            g[f"c{side}"] += gates.sum(axis=0)
            g[f"U{side}"] += h.T @ through
            carried = np.where(real, d_new * z + through @ u.T, total)
    return g


def train(
    p: Params, x: np.ndarray, at: np.ndarray, mask: np.ndarray, label: np.ndarray,
    epochs: int = 4, batch: int = 256, rate: float = 0.01, seed: int = 11,
) -> Params:
    """Adam on the logistic loss of windows."""
    rng = np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(at))
        for a in range(0, len(order), batch):
            some = order[a : a + batch]
            kept: dict = {}
            logit = forward(p, project(p, x), at[some], mask[some], kept)
            d = ((sigmoid(logit) - label[some]) / len(some)).astype(np.float32)
            grads = backward(p, x, at[some], mask[some], kept, d)
            step += 1
            for name, g in grads.items():
                first[name] += 0.1 * (g - first[name])
                second[name] += 0.001 * (g * g - second[name])
                m, s = first[name] / (1 - 0.9**step), second[name] / (1 - 0.999**step)
                p[name] = (p[name] - rate * m / (np.sqrt(s) + 1e-8)).astype(np.float32)
    return p
