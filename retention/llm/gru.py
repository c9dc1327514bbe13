"""A gated recurrent network over class ids, in numpy: forward steps, truncated backpropagation
through time and Adam. Sequences run in lanes: many at once, one after another in each lane."""

from __future__ import annotations

import heapq

import numpy as np

#: Lanes, and steps of a window: gradients go back to its beginning, the state goes on to the next one.
LANES, WINDOW = 256, 16


def fresh(classes: int, hidden: int, bias: np.ndarray, seed: int = 7) -> dict[str, np.ndarray]:
    """Parameters: input rows by class (three gates), recurrent weights, output weights and biases."""
    r = np.random.default_rng(seed)
    scale = 1 / np.sqrt(hidden)
    return {
        "G": r.uniform(-scale, scale, (classes, 3 * hidden)).astype(np.float32),
        "U": r.uniform(-scale, scale, (hidden, 3 * hidden)).astype(np.float32),
        "b": np.zeros(hidden, np.float32),
        "W": np.zeros((hidden, classes), np.float32),
        "c": bias.astype(np.float32),
    }


def flat(params: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([v.ravel() for _, v in sorted(params.items())])


def shaped(values: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, v in sorted(like.items()):
        out[k] = values[at:at + v.size].reshape(v.shape).astype(v.dtype)
        at += v.size
    return out


class Lanes:
    """Sequences dealt to lanes, the longest first to the shortest lane; lanes from long to short."""

    def __init__(self, sequences: list[np.ndarray], lanes: int = LANES):
        heap = [(0, i) for i in range(min(lanes, len(sequences)))]
        inside: list[list[int]] = [[] for _ in heap]
        for s in sorted(range(len(sequences)), key=lambda s: -len(sequences[s])):
            size, i = heapq.heappop(heap)
            inside[i].append(s)
            heapq.heappush(heap, (size + len(sequences[s]), i))
        order = [i for _, i in sorted(heap, reverse=True)]
        runs = [s for i in order for s in inside[i]]
        sizes = np.array([sum(len(sequences[s]) for s in inside[i]) for i in order], np.int64)
        self.ids = np.concatenate([sequences[s] for s in runs]) if runs else np.zeros(0, np.int64)
        self.owner = np.repeat(runs, [len(sequences[s]) for s in runs]) if runs else np.zeros(0, np.int64)
        self.end = np.cumsum(sizes)
        self.start = self.end - sizes
        self.sizes = sizes
        self.sequences = len(sequences)

    def windows(self, end_class: int):
        """(targets, inputs, begins, mask, owner), time by lane, for each window: begins marks the first
        token of a sequence; its input is the end class."""
        for t0 in range(0, int(self.sizes.max(initial=0)), WINDOW):
            k = int(np.searchsorted(-self.sizes, -t0, side="left"))  # lanes with more than t0 tokens
            at = self.start[:k] + t0 + np.arange(WINDOW)[:, None]
            mask = at < self.end[:k]
            at = np.minimum(at, self.end[:k] - 1)
            begins = (at == self.start[:k]) | (self.owner[at] != self.owner[np.maximum(at - 1, 0)])
            inputs = np.where(begins, end_class, self.ids[np.maximum(at - 1, 0)])
            yield self.ids[at], inputs, begins, mask, self.owner[at]


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


def forward(p, inputs, begins, h):
    """States after each step of a window (time, lane, hidden), and what going back needs."""
    n_h = p["U"].shape[0]
    steps, kept = np.empty((*inputs.shape, n_h), h.dtype), []
    rows = p["G"][inputs]
    for t, b in enumerate(begins):
        if b.any():
            h = np.where(b[:, None], h.dtype.type(0), h)
        g, a = rows[t], h @ p["U"]
        rz = _sigmoid(g[:, :2 * n_h] + a[:, :2 * n_h])
        r, z = rz[:, :n_h], rz[:, n_h:]
        inner = a[:, 2 * n_h:] + p["b"]
        n = np.tanh(g[:, 2 * n_h:] + r * inner)
        kept.append((h, r, z, n, inner))
        h = n + z * (h - n)
        steps[t] = h
    return steps, kept


def _logits(p, states):
    """Logits of all classes (rows: flattened states), the largest of each row 0."""
    logits = states.reshape(-1, states.shape[-1]) @ p["W"]
    logits += p["c"]
    logits -= logits.max(axis=1, keepdims=True)
    return logits


def log_softmax(p, states):
    """Log probabilities of all classes (rows: flattened states)."""
    logits = _logits(p, states)
    logits -= np.log(np.exp(logits).sum(axis=1, keepdims=True))
    return logits


def log_of(p, states, targets):
    """Log probabilities of the targets only."""
    logits = _logits(p, states)
    own = logits[np.arange(len(logits)), targets.ravel()]
    return own - np.log(np.exp(logits, out=logits).sum(axis=1))


def _sums(values, rows, n):
    """Sums of the rows of ``values`` by their numbers below n: rows in order of number, then by segment."""
    order = np.argsort(rows.astype(np.uint8 if n <= 256 else np.int64), kind="stable")
    sizes = np.bincount(rows, minlength=n)
    some = np.flatnonzero(sizes)
    out = np.zeros((n, values.shape[1]), values.dtype)
    out[some] = np.add.reduceat(values[order], (np.cumsum(sizes) - sizes)[some], axis=0)
    return out


def gradients(p, targets, inputs, begins, mask, h):
    """(loss a token, gradients, last state) of one window; lanes behind the mask don't count."""
    states, kept = forward(p, inputs, begins, h)
    n_h, weight = p["U"].shape[0], mask.reshape(-1, 1).astype(states.dtype) / max(1, int(mask.sum()))
    d = _logits(p, states)
    rows = np.arange(len(d))
    own = d[rows, targets.ravel()]
    total = np.exp(d, out=d).sum(axis=1, keepdims=True)
    loss = -float(((own - np.log(total[:, 0])) * weight[:, 0]).sum())
    d *= weight / total
    d[rows, targets.ravel()] -= weight[:, 0]
    flat_states = states.reshape(-1, n_h)
    grads = {"W": flat_states.T @ d, "c": d.sum(axis=0)}
    back = (d @ p["W"].T).reshape(states.shape)
    # of each step: what goes to the input rows, and to the products with the state
    to_input = np.empty((*inputs.shape, 3 * n_h), states.dtype)
    to_state = np.empty_like(to_input)
    dh = np.zeros_like(states[0])
    to_before = np.ascontiguousarray(p["U"].T)
    for t in range(len(inputs) - 1, -1, -1):
        before, r, z, n, inner = kept[t]
        dh = dh + back[t]
        dn = dh * (1 - z) * (1 - n * n)
        x, da = to_input[t], to_state[t]
        da[:, :n_h] = dn * inner * r * (1 - r)
        da[:, n_h:2 * n_h] = dh * (before - n) * z * (1 - z)
        da[:, 2 * n_h:] = dn * r
        x[:, :2 * n_h], x[:, 2 * n_h:] = da[:, :2 * n_h], dn
        dh = dh * z + da @ to_before
        if begins[t].any():
            dh[begins[t]] = 0
    flat_state = to_state.reshape(-1, 3 * n_h)
    grads["U"] = np.concatenate([k[0] for k in kept]).T @ flat_state
    grads["b"] = flat_state[:, 2 * n_h:].sum(axis=0)
    grads["G"] = _sums(to_input.reshape(-1, 3 * n_h), inputs.ravel(), len(p["G"]))
    return loss, grads, states[-1]


class Adam:
    def __init__(self, params, rate: float):
        self.p, self.rate, self.t = params, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads, clip: float = 1.0):
        self.t += 1
        norm = float(np.sqrt(sum(float((g * g).sum()) for g in grads.values())))
        shrink = min(1.0, clip / (norm + 1e-9))
        for k, g in grads.items():
            g = g * shrink
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.01 * (g * g - self.v[k])
            self.p[k] -= self.rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k] / (1 - 0.99**self.t)) + 1e-6)


def train(adam: Adam, sequences: list[np.ndarray], end_class: int) -> None:
    """One pass over the sequences; the state goes on from window to window, gradients don't."""
    lanes = Lanes(sequences)
    h = np.zeros((len(lanes.sizes), adam.p["U"].shape[0]), np.float32)
    for targets, inputs, begins, mask, _ in lanes.windows(end_class):
        _, grads, h = gradients(adam.p, targets, inputs, begins, mask, h[:targets.shape[1]])
        adam.step(grads)


def log10_likelihood(p, sequences: list[np.ndarray], end_class: int) -> np.ndarray:
    """The log10 probability of each whole sequence of classes, state carried through all windows."""
    lanes = Lanes(sequences)
    out = np.zeros(lanes.sequences)
    h = np.zeros((len(lanes.sizes), p["U"].shape[0]), np.float32)
    for targets, inputs, begins, mask, owner in lanes.windows(end_class):
        states, _ = forward(p, inputs, begins, h[:targets.shape[1]])
        logs = log_of(p, states, targets).astype(np.float64)
        out += np.bincount(owner.ravel(), weights=logs * mask.ravel(), minlength=lanes.sequences)
        h = states[-1]
    return out / np.log(10)
