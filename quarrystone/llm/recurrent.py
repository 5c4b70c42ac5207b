"""A small gated recurrent network over word ids with a class-factored softmax, in numpy.

Words of the head are dealt into classes of equal size by frequency; all other
words fall into tail classes and are told apart by their counts outside the
network. P(word) = P(class | state) * P(word | class, state).
"""

from __future__ import annotations

import heapq

import numpy as np

CLASS_SIZE = 64
HIDDEN = 16
WINDOW = 32
RATE = 0.25
CLIP = 4.0

Weights = dict[str, np.ndarray]


def initial(head_counts: np.ndarray, tail_counts: np.ndarray, hidden: int = HIDDEN) -> Weights:
    """Weights of a network that starts as the unigram distribution of the counts."""
    rng = np.random.default_rng(23)
    classes = -(-len(head_counts) // CLASS_SIZE)
    counts = np.full(classes * CLASS_SIZE, 1e-9)
    counts[: len(head_counts)] = head_counts + 0.1
    per_class = np.concatenate([counts.reshape(classes, -1).sum(axis=1), tail_counts + 0.1])
    inputs = classes * CLASS_SIZE + len(tail_counts) + 1
    small = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
    return {
        "E": small(inputs, 3 * hidden),
        "U": (small(hidden, 3 * hidden) * 2),
        "b": np.concatenate([np.ones(hidden), np.zeros(2 * hidden)]).astype(np.float32),
        "C": small(hidden, len(per_class)),
        "cb": np.log(per_class / per_class.sum()).astype(np.float32),
        "W": small(classes, hidden, CLASS_SIZE),
        "wb": np.log(counts / counts.sum()).reshape(classes, -1).astype(np.float32),
    }


def flat(weights: Weights) -> np.ndarray:
    return np.concatenate([weights[k].ravel() for k in sorted(weights)])


def shaped(values: np.ndarray, like: Weights) -> Weights:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = np.asarray(values[at : at + like[k].size], np.float32).reshape(like[k].shape)
        at += like[k].size
    return out


class Lanes:
    """Documents laid end to end in parallel lanes of about equal length; the state starts anew with each."""

    def __init__(self, documents: list[np.ndarray], start_id: int, most: int) -> None:
        lengths = np.array([len(d) for d in documents])
        lanes = int(min(most, len(documents), max(1, lengths.sum() // max(1, lengths.max()))))
        loads = [(0, lane) for lane in range(lanes)]
        parts: list[list[int]] = [[] for _ in range(lanes)]
        for d in np.argsort(-lengths, kind="stable"):
            load, lane = heapq.heappop(loads)
            parts[lane].append(int(d))
            heapq.heappush(loads, (load + int(lengths[d]), lane))
        depth = max(load for load, _ in loads)
        shape = (depth, lanes)
        self.inputs, self.targets = np.full(shape, start_id, np.int32), np.zeros(shape, np.int32)
        self.document, self.fresh = np.full(shape, -1, np.int32), np.zeros(shape, bool)
        for lane, own in enumerate(parts):
            at = 0
            for d in own:
                end = at + len(documents[d])
                self.targets[at:end, lane] = documents[d]
                self.inputs[at + 1 : end, lane] = documents[d][:-1]
                self.document[at:end, lane] = d
                self.fresh[at, lane] = True
                at = end

    def windows(self, size: int):
        for at in range(0, len(self.inputs), size):
            part = slice(at, at + size)
            yield self.inputs[part], self.targets[part], self.document[part], self.fresh[part]


# States, gates and logits are laid out as (units, lanes or tokens): every slice of units is one block of memory.
# Logits above this don't occur in training; the bound keeps their exponentials finite.
MOST_LOGIT = 60.0


def _states(w: Weights, inputs: np.ndarray, fresh: np.ndarray, h: np.ndarray, kept: list | None = None):
    """Hidden states (steps, units, lanes) of a window and the last one; ``kept`` gets what the way back needs."""
    size, lanes = h.shape
    table = np.ascontiguousarray(w["E"].T) + w["b"][:, None]
    turn = np.ascontiguousarray(w["U"].T)
    out = np.empty((len(inputs), size, lanes), h.dtype)
    any_fresh = fresh.any(axis=1)
    for t in range(len(inputs)):
        if any_fresh[t]:
            h = h * ~fresh[t]
        x, a = table.take(inputs[t], axis=1), turn @ h
        # The logistic function as a hyperbolic tangent, in place.
        gates = x[: 2 * size]
        gates += a[: 2 * size]
        gates *= 0.5
        np.tanh(gates, out=gates)
        gates += 1
        gates *= 0.5
        z, r = gates[:size], gates[size:]
        n = x[2 * size :]
        n += r * a[2 * size :]
        np.tanh(n, out=n)
        if kept is not None:
            kept.append((h, z, r, n, a[2 * size :]))
        after = out[t]
        np.subtract(h, n, out=after)
        after *= z
        after += n
        h = after
    return out, h


def _classes(w: Weights, targets: np.ndarray) -> np.ndarray:
    """Class of each id: heads by size, then one per tail id."""
    heads = w["W"].shape[0]
    return np.where(targets < heads * CLASS_SIZE, targets // CLASS_SIZE, targets - heads * CLASS_SIZE + heads)


def _softmax(x: np.ndarray, target: np.ndarray, columns: np.ndarray, gradient: bool) -> np.ndarray:
    """Log probability of each column's target. ``x`` is used up; with ``gradient`` it becomes that of the negative."""
    np.minimum(x, MOST_LOGIT, out=x)
    picked = x[target, columns]
    np.exp(x, out=x)
    total = x.sum(axis=0)
    if gradient:
        x /= total
        x[target, columns] -= 1
    return picked - np.log(total)


def _outputs(w: Weights, states: np.ndarray, targets: np.ndarray, grads: Weights | None):
    """Natural log probability of each target from states (units, tokens); with ``grads`` also the gradients of their negative sum."""
    own, columns, learn = _classes(w, targets), np.arange(len(targets)), grads is not None
    d = w["C"].T @ states
    d += w["cb"][:, None]
    logs = _softmax(d, own, columns, learn)
    back = None
    if learn:
        grads["C"], grads["cb"] = states @ d.T, d.sum(axis=1)
        back = w["C"] @ d
        grads["W"], grads["wb"] = np.zeros_like(w["W"]), np.zeros_like(w["wb"])
    heads = w["W"].shape[0]
    # Tokens in the order of their classes, so that each class is one slice.
    order = np.argsort(own.astype(np.int16), kind="stable")
    cuts = np.searchsorted(own[order], np.arange(heads + 1))
    order = order[: cuts[-1]]
    inner, places, found = states.take(order, axis=1), targets[order] % CLASS_SIZE, np.empty(len(order), logs.dtype)
    into = np.empty_like(inner)
    for c in range(heads):
        part = slice(cuts[c], cuts[c + 1])
        if cuts[c] == cuts[c + 1]:
            continue
        own_states = inner[:, part]
        d = w["W"][c].T @ own_states
        d += w["wb"][c][:, None]
        found[part] = _softmax(d, places[part], columns[: d.shape[1]], learn)
        if learn:
            grads["W"][c], grads["wb"][c] = own_states @ d.T, d.sum(axis=1)
            into[:, part] = w["W"][c] @ d
    logs[order] += found
    if learn:
        back[:, order] += into
    return logs, back


def _backward(w: Weights, inputs: np.ndarray, fresh: np.ndarray, kept: list, back: np.ndarray, grads: Weights) -> None:
    """Backpropagation through the steps of one window; the state that came in is taken as given."""
    steps, size, lanes = back.shape
    dx, dh, turn = np.empty((steps, 3 * size, lanes), back.dtype), np.zeros_like(back[0]), w["U"]
    grads["U"] = np.zeros_like(turn)
    da, any_fresh = np.empty((3 * size, lanes), back.dtype), fresh.any(axis=1)
    for t in range(steps - 1, -1, -1):
        h, z, r, n, an = kept[t]
        dh = dh + back[t]
        step = dx[t]
        open_ = dh * z
        rest = dh - open_
        np.multiply(open_, 1 - z, out=step[:size])
        step[:size] *= h - n
        dn = step[2 * size :]
        np.multiply(rest, 1 - n * n, out=dn)
        passed = da[2 * size :]
        np.multiply(dn, r, out=passed)
        np.multiply(passed, an, out=step[size : 2 * size])
        step[size : 2 * size] *= 1 - r
        da[: 2 * size] = step[: 2 * size]
        grads["U"] += h @ da.T
        dh = turn @ da
        dh += open_
        if any_fresh[t]:
            dh *= ~fresh[t]
    rows = dx.transpose(0, 2, 1).reshape(-1, 3 * size)
    grads["b"] = rows.sum(axis=0)
    order = np.argsort(inputs.ravel().astype(np.uint16), kind="stable")
    ids = inputs.ravel()[order]
    starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
    grads["E ids"], grads["E"] = ids[starts], np.add.reduceat(rows[order], starts, axis=0)


def _by_token(states: np.ndarray, known: np.ndarray) -> np.ndarray:
    """(steps, units, lanes) to (units, known tokens)."""
    flat = states.transpose(1, 0, 2).reshape(states.shape[1], -1)
    return flat if known.all() else flat[:, known.ravel()]


def gradients(w: Weights, inputs: np.ndarray, targets: np.ndarray, known: np.ndarray, fresh: np.ndarray, h: np.ndarray):
    """(sum of log probabilities, gradients of its negative, state after) of one window; ``known`` marks real tokens."""
    kept: list = []
    states, after = _states(w, inputs, fresh, h, kept)
    grads: Weights = {}
    logs, back_known = _outputs(w, _by_token(states, known), targets[known], grads)
    flat = np.zeros((h.shape[0], inputs.size), states.dtype)
    flat[:, known.ravel()] = back_known
    back = np.ascontiguousarray(flat.reshape(h.shape[0], *inputs.shape).transpose(1, 0, 2))
    _backward(w, inputs, fresh, kept, back, grads)
    return float(logs.sum()), grads, after


class Trainer:
    """Adagrad over the windows of documents; the state runs on from window to window."""

    def __init__(self, weights: Weights, rate: float = RATE) -> None:
        self.w = {k: v.copy() for k, v in weights.items()}
        self.rate, self.seen = rate, {k: np.full_like(v, 1e-2) for k, v in weights.items()}
        self.tokens = 0

    def learn(self, documents: list[np.ndarray], most: int = 256) -> None:
        """One pass. Lanes are as many as leave about 64 windows, so that few documents still make many steps."""
        w = self.w
        h = None
        lanes = int(np.clip(sum(map(len, documents)) // (64 * WINDOW), 16, most))
        plan = Lanes(documents, w["E"].shape[0] - 1, lanes)
        for inputs, targets, document, fresh in plan.windows(WINDOW):
            known = document >= 0
            h = np.zeros((w["U"].shape[0], inputs.shape[1]), np.float32) if h is None else h
            _, grads, h = gradients(w, inputs, targets, known, fresh, h)
            self.tokens += int(known.sum())
            scale = np.float32(1 / np.sqrt(max(1, known.sum())))
            for k in ("U", "b", "C", "cb", "W", "wb"):
                g = np.clip(grads[k] * scale, -CLIP, CLIP)
                self.seen[k] += g * g
                w[k] -= self.rate * g / np.sqrt(self.seen[k])
            at, g = grads["E ids"], np.clip(grads["E"] * scale, -CLIP, CLIP)
            self.seen["E"][at] += g * g
            w["E"][at] -= self.rate * g / np.sqrt(self.seen["E"][at])


def log10_likelihoods(w: Weights, documents: list[np.ndarray], lanes: int = 256) -> np.ndarray:
    """Log10 probability of every whole document, states carried from window to window."""
    plan = Lanes(documents, w["E"].shape[0] - 1, lanes)
    totals = np.zeros(len(documents))
    h = np.zeros((w["U"].shape[0], plan.inputs.shape[1]), np.float32)
    for inputs, targets, document, fresh in plan.windows(WINDOW):
        states, h = _states(w, inputs, fresh, h)
        known = document >= 0
        logs, _ = _outputs(w, _by_token(states, known), targets[known], None)
        totals += np.bincount(document[known], logs, len(documents))
    return totals / np.log(10)
