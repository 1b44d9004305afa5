"""A gated recurrent network with a class-factored softmax over leaves, in numpy: training by truncated backpropagation and scoring.

A leaf is a frequent token or a group of rarer ones; leaf k belongs to class k // MEMBERS. The probability of a leaf is that of its
class times that of the leaf among the class's members, both from the state after the tokens before it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

HIDDEN, EMBED = 32, 24
CLASSES, MEMBERS = 16, 16
LEAVES = CLASSES * MEMBERS
#: Steps through which an error is carried back.
SPAN = 32
#: Largest logit in scoring; exp(60) is far within float32.
SAFE_LOGIT = 60.0
#: Occurrences of an input up to which its sum is made side by side with those of others.
FEW = 16

Params = dict[str, np.ndarray]


def new_params(inputs: int, leaf_counts: np.ndarray, seed: int = 5) -> Params:
    """Small random weights; the output biases start at the corpus's leaf shares."""
    r = np.random.RandomState(seed)
    share = np.log((leaf_counts + 1.0) / (leaf_counts + 1.0).sum()).reshape(CLASSES, MEMBERS)
    top = np.log(np.exp(share).sum(1))
    make = lambda *s: (r.standard_normal(s) / np.sqrt(s[-2] if len(s) > 1 else 1)).astype(np.float32)
    return {
        "E": make(inputs, EMBED) * np.float32(np.sqrt(inputs) * 0.3), "W": make(EMBED, 3 * HIDDEN), "b": np.zeros(3 * HIDDEN, np.float32), "U": make(HIDDEN, 3 * HIDDEN),
        "Wc": make(HIDDEN, CLASSES) * np.float32(0.1), "bc": top.astype(np.float32), "Wm": make(CLASSES, HIDDEN, MEMBERS) * np.float32(0.1), "bm": (share - top[:, None]).astype(np.float32),
    }


def _softmax_error(x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, float]:
    """x: (choices, rows) logits, overwritten by the loss's derivative; at: each row's target. The derivative and the summed log-probability.

    A row is a column here, so that maxima and sums run over whole vectors."""
    rows = np.arange(x.shape[1])
    x -= x.max(0)
    picked = float(x[at, rows].sum())
    np.exp(x, out=x)
    total = x.sum(0)
    x /= total
    x[at, rows] -= 1
    return x, picked - float(np.log(total).sum())


def _by_class(leaves: np.ndarray) -> list[tuple[int, np.ndarray]]:
    of = (leaves // MEMBERS).astype(np.uint8)
    order = np.argsort(of, kind="stable")
    cuts = np.searchsorted(of[order], np.arange(CLASSES + 1))
    return [(k, order[cuts[k] : cuts[k + 1]]) for k in range(CLASSES) if cuts[k + 1] > cuts[k]]


def _picked(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log-softmax of each row at one place. Logits are at most SAFE_LOGIT (see `safe`), so their exponentials don't overflow."""
    picked = x[np.arange(len(x)), at]
    return picked - np.log(np.exp(x, out=x) @ np.ones(x.shape[1], x.dtype))


def safe(p: Params) -> Params:
    """p with output weights scaled down, class by class, where a logit could exceed SAFE_LOGIT for some state in [-1, 1]."""
    out = dict(p)
    for w, b in (("Wc", "bc"), ("Wm", "bm")):
        most = np.abs(p[w]).sum(-2).max(-1) + np.abs(p[b]).max(-1)
        scale = np.minimum(1, SAFE_LOGIT / np.maximum(most, 1e-9)).astype(p[w].dtype)
        out[w], out[b] = p[w] * scale[..., None, None], p[b] * scale[..., None]
    return out


def leaf_log_probs(p: Params, states: np.ndarray, leaves: np.ndarray) -> np.ndarray:
    """Natural log-probability of each leaf given its state, p being safe."""
    out = _picked(states @ p["Wc"] + p["bc"], leaves // MEMBERS)
    for k, rows in _by_class(leaves):
        out[rows] += _picked(states.take(rows, axis=0) @ p["Wm"][k] + p["bm"][k], leaves[rows] % MEMBERS)
    return out


def _summed_rows(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """(n, width): the sum of the values of each row number."""
    out = np.zeros((n, values.shape[1]), values.dtype)
    if len(rows):
        order = np.argsort(rows.astype(np.uint16) if n <= 1 << 16 else rows, kind="stable")  # sixteen bits are sorted by radix
        found = rows[order]
        starts = np.flatnonzero(np.append(True, found[1:] != found[:-1]))
        sizes = np.diff(np.append(starts, len(found)))
        by_size = np.argsort(-sizes, kind="stable")
        starts, sizes = starts[by_size], sizes[by_size]
        names, many = found[starts], int((sizes > FEW).sum())
        for i in range(many):
            out[names[i]] = np.add.reduce(values.take(order[starts[i] : starts[i] + sizes[i]], axis=0), axis=0)
        # the others' first values at once, then their second ones, and so on
        starts, sizes, names = starts[many:], sizes[many:], names[many:]
        sums = np.zeros((len(names), values.shape[1]), values.dtype)
        for k in range(int(sizes[0]) if len(sizes) else 0):
            live = int(np.searchsorted(-sizes, -k, side="left"))
            sums[:live] += values.take(order[starts[:live] + k], axis=0)
        out[names] = sums
    return out


def _gradients(p: Params, ids: np.ndarray, leaves: np.ndarray, h: np.ndarray, fresh: np.ndarray | None = None, valid: np.ndarray | None = None) -> tuple[Params, np.ndarray, float]:
    """ids, leaves: (steps, lanes) inputs and targets; h: the state carried in; fresh: where a text begins (the state is zero there);
    valid: which places hold a token. Gradients of the mean loss over tokens, the state out and the loss."""
    steps, lanes = ids.shape
    H, kind = HIDDEN, p["U"].dtype
    table = p["E"] @ p["W"] + p["b"]
    x = table.take(ids, axis=0)
    before, z, r, c, part, states = (np.empty((steps, lanes, H), kind) for _ in range(6))
    half, one = kind.type(0.5), kind.type(1)
    begins = fresh.any(1) if fresh is not None else np.zeros(steps, bool)
    for t in range(steps):
        if begins[t]:
            h = np.where(fresh[t][:, None], kind.type(0), h)
        before[t] = h
        hu = h @ p["U"]
        gates = x[t, :, : 2 * H] + hu[:, : 2 * H]
        gates *= half
        np.tanh(gates, out=gates)
        gates += one
        gates *= half
        z[t], r[t], part[t] = gates[:, :H], gates[:, H:], hu[:, 2 * H :]
        np.multiply(r[t], part[t], out=c[t])
        c[t] += x[t, :, 2 * H :]
        np.tanh(c[t], out=c[t])
        h = h - c[t]
        h *= z[t]
        h += c[t]
        states[t] = h
    there = None if valid is None or valid.all() else np.flatnonzero(valid.ravel())
    flat, target = states.reshape(-1, H), leaves.ravel()
    if there is not None:
        flat, target = flat[there], target[there]
    n = len(target)
    g: Params = {}
    d, log_p = _softmax_error(p["Wc"].T @ flat.T + p["bc"][:, None], target // MEMBERS)
    loss = -log_p
    g["Wc"], g["bc"] = flat.T @ d.T, d.sum(1)
    ds = d.T @ p["Wc"].T
    g["Wm"], g["bm"] = np.zeros_like(p["Wm"]), np.zeros_like(p["bm"])
    for k, rows in _by_class(target):
        own = flat.take(rows, axis=0)
        e, log_p = _softmax_error(p["Wm"][k].T @ own.T + p["bm"][k][:, None], target[rows] % MEMBERS)
        loss -= log_p
        g["Wm"][k], g["bm"][k] = own.T @ e.T, e.sum(1)
        ds[rows] += e.T @ p["Wm"][k].T
    if there is not None:
        whole = np.zeros((steps * lanes, H), kind)
        whole[there] = ds
        ds = whole
    ds = ds.reshape(steps, lanes, H)
    # what does not depend on the error is made for all steps at once
    for_c, for_z = (one - z) * (one - c * c), (before - c) * z * (one - z)
    for_r = part * r * (one - r)
    dx, du = np.empty((steps, lanes, 3 * H), kind), np.empty((steps, lanes, 3 * H), kind)
    back = np.ascontiguousarray(p["U"].T)
    carry = np.zeros((lanes, H), kind)
    for t in range(steps - 1, -1, -1):
        dh = ds[t] + carry
        dc = dh * for_c[t]
        np.multiply(dh, for_z[t], out=du[t, :, :H])
        np.multiply(dc, for_r[t], out=du[t, :, H : 2 * H])
        np.multiply(dc, r[t], out=du[t, :, 2 * H :])
        dx[t, :, 2 * H :] = dc
        carry = du[t] @ back
        dh *= z[t]
        carry += dh
        if begins[t]:
            carry[fresh[t]] = 0
    dx[:, :, : 2 * H] = du[:, :, : 2 * H]
    g["U"] = before.reshape(-1, H).T @ du.reshape(-1, 3 * H)
    by_row = _summed_rows(ids.ravel(), dx.reshape(-1, 3 * H), len(table))
    g["E"], g["W"], g["b"] = by_row @ p["W"].T, p["E"].T @ by_row, by_row.sum(0)
    return {k: v / kind.type(max(n, 1)) for k, v in g.items()}, h, loss / max(n, 1)


def deal(sizes: np.ndarray, most_lanes: int) -> list[list[int]]:
    """Documents dealt to lanes, the longest first and always to the shortest lane; lanes in descending length."""
    lanes = int(np.clip(sizes.sum() // max(1, sizes.max()), 1, most_lanes))
    load, taken = np.zeros(lanes, dtype=np.int64), [[] for _ in range(lanes)]
    for i in np.argsort(-sizes, kind="stable"):
        k = int(load.argmin())
        taken[k].append(int(i))
        load[k] += sizes[i]
    return [taken[k] for k in np.argsort(-load, kind="stable") if taken[k]]


def spans(documents: list[tuple[np.ndarray, np.ndarray]], lanes: list[list[int]], span: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(ids, leaves, fresh, valid), each (steps, live lanes), of span after span; lanes drop out as they end."""
    rows = [tuple(np.concatenate([documents[i][part] for i in lane]) for part in (0, 1)) for lane in lanes]
    length = np.array([len(x) for x, _ in rows])
    begins = []
    for lane in lanes:
        sizes = [len(documents[i][0]) for i in lane]
        f = np.zeros(sum(sizes), dtype=bool)
        f[np.cumsum([0, *sizes[:-1]])] = True
        begins.append(f)
    for begin in range(0, int(length.max()), span):
        live = int((length > begin).sum())
        n = np.minimum(length[:live] - begin, span)
        steps = int(n[0])
        ids, leaves = (np.zeros((steps, live), np.int32) for _ in range(2))
        fresh = np.zeros((steps, live), bool)
        for j in range(live):
            ids[: n[j], j], leaves[: n[j], j] = rows[j][0][begin : begin + n[j]], rows[j][1][begin : begin + n[j]]
            fresh[: n[j], j] = begins[j][begin : begin + n[j]]
        yield ids, leaves, fresh, np.arange(steps)[:, None] < n[None, :]


def train(p: Params, documents: list[tuple[np.ndarray, np.ndarray]], rate: float = 4e-3, epochs: int = 2, lanes: int = 64, seed: int = 3) -> tuple[Params, float]:
    """Adam over whole documents (inputs, leaves) side by side in lanes; the state is carried from span to span and starts anew with
    each document; only tokens are learned. Returns the mean loss of the last round too."""
    documents = [d for d in documents if len(d[0])]
    p = {k: v.copy() for k, v in p.items()}
    if not documents:
        return p, 0.0
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    r, at, losses = np.random.RandomState(seed), 0, []
    sizes = np.array([len(x) for x, _ in documents], dtype=np.int64)
    dealt = deal(sizes, lanes)
    rounds = max(1, epochs * -(-int(sizes[dealt[0]].sum()) // SPAN))
    for _ in range(epochs):
        h, losses = np.zeros((len(dealt), HIDDEN), np.float32), []
        for lane in dealt:
            r.shuffle(lane)
        for ids, leaves, fresh, valid in spans(documents, dealt, SPAN):
            g, h, loss = _gradients(p, ids, leaves, h[: ids.shape[1]], fresh, valid)
            losses.append((loss, int(valid.sum())))
            at += 1
            size = np.sqrt(sum(float(np.vdot(x, x)) for x in g.values()))
            scale, step = min(1.0, 1.0 / max(size, 1e-9)), rate * (1 - 0.9 * at / rounds)
            for k, x in g.items():
                x *= np.float32(scale)
                m[k] += np.float32(0.1) * (x - m[k])
                x *= x
                v[k] += np.float32(0.01) * (x - v[k])
                p[k] -= np.float32(step / (1 - 0.9**at)) * m[k] / (np.sqrt(v[k] / np.float32(1 - 0.99**at)) + np.float32(1e-8))
    return p, sum(a * b for a, b in losses) / sum(b for _, b in losses)


class Scorer:
    """Log-likelihoods of whole documents: lanes take document after document, window by window, the state carried across windows."""

    def __init__(self, p: Params):
        self.p = p = safe(p)
        self.table = (p["E"] @ p["W"] + p["b"]).astype(np.float32)

    def score(self, documents: list[tuple[np.ndarray, np.ndarray]], most_lanes: int = 512, window: int = SPAN) -> np.ndarray:
        """Sum of natural leaf log-probabilities of each document (inputs, leaves), all of its tokens."""
        sizes = np.array([len(x[0]) for x in documents], dtype=np.int64)
        out = np.zeros(len(documents))
        if not len(documents) or not sizes.sum():
            return out
        lanes = deal(sizes, most_lanes)
        owners = [np.repeat(lane, sizes[lane]) for lane in lanes]
        H, U = HIDDEN, self.p["U"]
        h, begin = np.zeros((len(lanes), H), np.float32), 0
        for ids, leaves, first, there in spans(documents, lanes, window):
            steps, live = ids.shape
            h = h[:live]
            x = self.table.take(ids, axis=0)
            states = np.empty((steps, live, H), np.float32)
            some = first.any(1)
            for t in range(steps):
                if some[t]:
                    h = np.where(first[t][:, None], np.float32(0), h)
                hu = h @ U
                gates = x[t, :, : 2 * H]
                gates += hu[:, : 2 * H]
                gates *= np.float32(0.5)
                np.tanh(gates, out=gates)
                gates += np.float32(1)
                gates *= np.float32(0.5)
                hu = hu[:, 2 * H :]
                hu *= gates[:, H:]
                hu += x[t, :, 2 * H :]
                np.tanh(hu, out=hu)
                h = (h - hu) * gates[:, :H]
                h += hu
                states[t] = h
            held = there.T
            flat = states.transpose(1, 0, 2)[held]
            logs = leaf_log_probs(self.p, flat, leaves.T[held])
            owner = np.concatenate([owners[j][begin : begin + steps] for j in range(live)])
            out += np.bincount(owner, weights=logs, minlength=len(documents))
            begin += window
        return out
