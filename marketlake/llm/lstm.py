"""A bidirectional LSTM in numpy that labels every element of a sequence; training by Adam on padded batches."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

Params = dict[str, np.ndarray]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


@dataclass
class Run:
    """What the way back needs of one direction: inputs, states before each step, gates, states after."""

    x: np.ndarray
    mask: np.ndarray
    steps: list


def initial(inputs: int, hidden: int, seed: int) -> Params:
    rng = np.random.default_rng(seed)
    p: Params = {}
    for way in ("f", "b"):
        p[f"wx{way}"] = rng.normal(0, inputs**-0.5, (inputs, 4 * hidden))
        p[f"wh{way}"] = rng.normal(0, hidden**-0.5, (hidden, 4 * hidden))
        p[f"c{way}"] = np.concatenate([np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)])
    p["wo"], p["ws"], p["bo"] = rng.normal(0, hidden**-0.5, 2 * hidden), np.zeros(inputs), np.zeros(1)
    return {k: v.astype(np.float32) for k, v in p.items()}


def step(p: Params, way: str, gates: np.ndarray, h: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple]:
    """One step from the projected inputs ``gates``; the new states and what the way back needs."""
    size = h.shape[1]
    z = gates + h @ p[f"wh{way}"]
    i, f, o = (_sigmoid(z[:, k * size : (k + 1) * size]) for k in (0, 1, 3))
    g = np.tanh(z[:, 2 * size : 3 * size])
    c2 = f * c + i * g
    t = np.tanh(c2)
    return o * t, c2, (i, f, g, o, t, c, h)


def states(p: Params, way: str, x: np.ndarray, mask: np.ndarray, keep: bool = False) -> tuple[np.ndarray, Run | None]:
    """Hidden states (steps, batch, hidden) of one direction; steps outside ``mask`` leave them as they are."""
    steps, batch, _ = x.shape
    hidden = p[f"wh{way}"].shape[0]
    gates = x @ p[f"wx{way}"] + p[f"c{way}"]
    h, c = np.zeros((batch, hidden), np.float32), np.zeros((batch, hidden), np.float32)
    out, kept = np.zeros((steps, batch, hidden), np.float32), [None] * steps
    for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
        h2, c2, seen = step(p, way, gates[t], h, c)
        m = mask[t][:, None]
        h, c = m * h2 + (1 - m) * h, m * c2 + (1 - m) * c
        out[t] = h
        kept[t] = seen if keep else None
    return out, Run(x, mask, kept) if keep else None


def _back(p: Params, way: str, run: Run, d_out: np.ndarray, grads: Params) -> None:
    steps, batch, _ = run.x.shape
    hidden = p[f"wh{way}"].shape[0]
    d_gates = np.zeros((steps, batch, 4 * hidden), np.float32)
    dh, dc = np.zeros((batch, hidden), np.float32), np.zeros((batch, hidden), np.float32)
    for t in range(steps - 1, -1, -1) if way == "f" else range(steps):
        i, f, g, o, tc, c, h = run.steps[t]
        m = run.mask[t][:, None]
        dh = dh + d_out[t]
        dh_in, dc_in = m * dh, m * dc
        dc_all = dc_in + dh_in * o * (1 - tc * tc)
        d = np.concatenate([dc_all * g * i * (1 - i), dc_all * c * f * (1 - f), dc_all * i * (1 - g * g), dh_in * tc * o * (1 - o)], axis=1)
        d_gates[t] = d
        grads[f"wh{way}"] += h.T @ d
        dh, dc = (1 - m) * dh + d @ p[f"wh{way}"].T, (1 - m) * dc + dc_all * f
    flat = d_gates.reshape(-1, 4 * hidden)
    grads[f"wx{way}"] += run.x.reshape(len(flat), -1).T @ flat
    grads[f"c{way}"] += flat.sum(0)


def padded(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(steps, batch, inputs) and the mask of real steps."""
    steps = max(map(len, sequences))
    x = np.zeros((steps, len(sequences), sequences[0].shape[1]), np.float32)
    mask = np.zeros((steps, len(sequences)), np.float32)
    for k, s in enumerate(sequences):
        x[: len(s), k], mask[: len(s), k] = s, 1
    return x, mask


def _loss_step(p: Params, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> Params:
    forward, run_f = states(p, "f", x, mask, keep=True)
    backward, run_b = states(p, "b", x, mask, keep=True)
    both = np.concatenate([forward, backward], axis=2)
    prob = _sigmoid(both @ p["wo"] + x @ p["ws"] + p["bo"])
    d = ((prob - y) * mask / max(1.0, mask.sum())).astype(np.float32)
    grads = {k: np.zeros_like(v) for k, v in p.items()}
    grads["wo"] += np.tensordot(d, both, ((0, 1), (0, 1)))
    grads["ws"] += np.tensordot(d, x, ((0, 1), (0, 1)))
    grads["bo"] += d.sum()
    d_both = d[:, :, None] * p["wo"]
    size = forward.shape[2]
    _back(p, "f", run_f, d_both[:, :, :size], grads)
    _back(p, "b", run_b, d_both[:, :, size:], grads)
    return grads


def train(sequences: list[np.ndarray], labels: list[np.ndarray], hidden: int, epochs: int, seed: int = 1, batch: int = 32, rate: float = 0.01) -> Params:
    """Parameters fitted to the labels (0 or 1 per element); sequences of like length share a batch. The same input gives the same result."""
    p = initial(sequences[0].shape[1], hidden, seed)
    rng = np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    order = sorted(range(len(sequences)), key=lambda k: len(sequences[k]))
    groups = [order[k : k + batch] for k in range(0, len(order), batch)]
    done, rounds = 0, epochs * len(groups)
    for _ in range(epochs):
        for g in rng.permutation(len(groups)):
            x, mask = padded([sequences[k] for k in groups[g]])
            y = np.zeros(mask.shape, np.float32)
            for col, k in enumerate(groups[g]):
                y[: len(labels[k]), col] = labels[k]
            grads = _loss_step(p, x, mask, y)
            norm = float(np.sqrt(sum((v * v).sum() for v in grads.values())))
            scale, done = min(1.0, 1.0 / max(norm, 1e-9)), done + 1
            pace = rate * (1 - done / (rounds + 1))
            for k, v in grads.items():
                v = v * scale
                first[k] = 0.9 * first[k] + 0.1 * v
                second[k] = 0.99 * second[k] + 0.01 * v * v
                p[k] = (p[k] - pace * (first[k] / (1 - 0.9**done)) / (np.sqrt(second[k] / (1 - 0.99**done)) + 1e-7)).astype(np.float32)
    return p


def scores(p: Params, sequences: list[np.ndarray]) -> list[np.ndarray]:
    """For each sequence the log odds of its elements' label."""
    x, mask = padded(sequences)
    forward, _ = states(p, "f", x, mask)
    backward, _ = states(p, "b", x, mask)
    out = np.concatenate([forward, backward], axis=2) @ p["wo"] + x @ p["ws"] + p["bo"]
    return [out[: len(s), k] for k, s in enumerate(sequences)]


def long_scores(p: Params, read, total: int, segment: int) -> np.ndarray:
    """``scores`` of one sequence that ``read(start, end)`` gives in segments; only hidden states are held for all of it."""
    hidden = p["whf"].shape[0]
    held = {way: np.zeros((total, hidden), np.float32) for way in ("f", "b")}
    skip = np.zeros(total, np.float32)
    starts = range(0, total, segment)
    for way in ("f", "b"):
        h, c = np.zeros((1, hidden), np.float32), np.zeros((1, hidden), np.float32)
        for start in starts if way == "f" else reversed(starts):
            x = read(start, min(total, start + segment))
            gates = x @ p[f"wx{way}"] + p[f"c{way}"]
            skip[start : start + len(x)] = x @ p["ws"]
            for t in range(len(x)) if way == "f" else range(len(x) - 1, -1, -1):
                h, c, _ = step(p, way, gates[t : t + 1], h, c)
                held[way][start + t] = h[0]
    return np.concatenate([held["f"], held["b"]], axis=1) @ p["wo"] + skip + p["bo"]
