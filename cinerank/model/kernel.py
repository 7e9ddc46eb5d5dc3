"""Numpy forward / backward passes, Adam and the cosine schedule.

Runs inside Spark tasks (``mapInPandas``) on Arrow batches; nothing here
touches Spark. Inputs are column arrays: gender, age, occ, zip (int) and the
genre multi-hot as a float matrix (built from the int genre mask).
"""

from __future__ import annotations

import math

import numpy as np

from .spec import BN_EPS, BN_MOMENTUM, ModelSpec, bn_fold, flatten, unflatten

N_GENRES = 18


def multihot(mask: np.ndarray, n: int = N_GENRES) -> np.ndarray:
    mask = np.asarray(mask, dtype=np.int64)
    return ((mask[:, None] >> np.arange(n)[None, :]) & 1).astype(np.float64)


# ---------------------------------------------------------------------------
# Towers
# ---------------------------------------------------------------------------

EMBEDDINGS = ("gender_emb", "age_emb", "occ_emb", "zip_emb")


def _user_fwd(P, p, g, a, o, z):
    """The projection of the four embeddings: each table is projected, then its rows are looked up and added."""
    fd = P[f"{p}.gender_emb"].shape[1]
    out = P[f"{p}.proj_b"] + np.zeros((len(g), 1))
    for k, (name, ix) in enumerate(zip(EMBEDDINGS, (g, a, o, z))):
        out += (P[f"{p}.{name}"] @ P[f"{p}.proj_w"][:, k * fd:(k + 1) * fd].T)[ix]
    return out


def _one_hot(P, p, idx):
    """Ones at each row's four embeddings, the tables side by side."""
    sizes = [len(P[f"{p}.{name}"]) for name in EMBEDDINGS]
    hot = np.zeros((len(idx[0]), sum(sizes)))
    rows = np.arange(len(hot))
    for start, ix in zip(np.cumsum([0] + sizes), idx):
        hot[rows, start + ix] = 1.0
    return hot


def _user_bwd(P, G, p, hot, du):
    G[f"{p}.proj_b"] += du.sum(0)
    sums = hot.T @ du  # of each embedding's rows
    fd, at = P[f"{p}.gender_emb"].shape[1], 0
    for k, name in enumerate(EMBEDDINGS):
        table, block = P[f"{p}.{name}"], slice(k * fd, (k + 1) * fd)
        part = sums[at:at + len(table)]
        G[f"{p}.proj_w"][:, block] += part.T @ table
        G[f"{p}.{name}"] += part @ P[f"{p}.proj_w"][:, block]
        at += len(table)


def _movie_fwd(P, p, gen):
    return gen @ P[f"{p}.proj_w"].T + P[f"{p}.proj_b"]


def _movie_bwd(P, G, p, gen, dm):
    G[f"{p}.proj_w"] += dm.T @ gen
    G[f"{p}.proj_b"] += dm.sum(0)


# ---------------------------------------------------------------------------
# MLP stack
# ---------------------------------------------------------------------------

def _normalised(P, i, h):
    """What follows hidden layer ``i``'s linear part in evaluation, in place: batch normalisation and the positive part."""
    scale, shift = bn_fold(P, i)
    h *= scale
    h += shift
    np.maximum(h, 0.0, out=h)


def _arrays(shape: tuple, i: int, scratch: dict | None):
    """Arrays of layer ``i`` by their name, kept in ``scratch`` from batch to batch."""
    def array(name, kind=np.float64):
        key = (name, i, kind)
        if scratch is None:
            return np.empty(shape, kind)
        if key not in scratch or scratch[key].shape != shape:
            scratch[key] = np.empty(shape, kind)
        return scratch[key]
    return array


def _passed(spec: ModelSpec, out, rng, array):
    """The positive part and dropout of a layer, in place; what an output was multiplied by: 0 or the dropout's scale."""
    kept = np.greater(out, 0, out=array("kept", np.bool_))
    passes = array("passes")
    if spec.dropout > 0:
        draws = rng.random(out=passes) if isinstance(rng, np.random.Generator) else rng.random(out.shape)
        kept &= np.greater_equal(draws, spec.dropout, out=array("stays", np.bool_))
    np.multiply(kept, 1.0 / (1.0 - spec.dropout), out=passes)
    out *= passes
    return passes


def _mlp_fwd(P, spec: ModelSpec, h, train: bool, rng, bn_stats: dict | None, scratch: dict | None = None, first: int = 0):
    """Output and, per layer from ``first`` on, what the gradient needs. Arrays are changed in place: a batch is walked as few times as can be.
    ``scratch`` keeps the arrays from batch to batch, so that the system need not clear new memory for each."""
    caches = []
    for i in range(first, len(spec.hidden_dims)):
        if not train:
            h = h @ P[f"mlp.{i}.w"].T
            h += P[f"mlp.{i}.b"]
            _normalised(P, i, h)
            continue
        array = _arrays((len(h), len(P[f"mlp.{i}.b"])), i, scratch)
        zhat = np.matmul(h, P[f"mlp.{i}.w"].T, out=array("zhat"))  # without the bias, which normalisation takes away again
        n = len(zhat)
        mu = np.ones(n) @ zhat / n
        zhat -= mu
        var = np.einsum("ij,ij->j", zhat, zhat) / n
        inv = 1.0 / np.sqrt(var + BN_EPS)
        zhat *= inv
        if bn_stats is not None:
            unbiased = var * n / max(n - 1, 1)
            bn_stats[f"mlp.{i}.run_mean"] = (1 - BN_MOMENTUM) * bn_stats[f"mlp.{i}.run_mean"] + BN_MOMENTUM * (mu + P[f"mlp.{i}.b"])
            bn_stats[f"mlp.{i}.run_var"] = (1 - BN_MOMENTUM) * bn_stats[f"mlp.{i}.run_var"] + BN_MOMENTUM * unbiased
        out = np.multiply(zhat, P[f"mlp.{i}.gamma"], out=array("out"))
        out += P[f"mlp.{i}.beta"]
        caches.append((h, zhat, inv, _passed(spec, out, rng, array)))
        h = out
    return h, caches


def _mlp_bwd(P, G, spec, caches, dh, first: int = 0):
    """``dh`` and the caches (of the layers from ``first`` on) are used up."""
    for i in reversed(range(first, len(spec.hidden_dims))):
        h_in, zhat, inv, passes = caches[i - first]
        n = len(zhat)
        dh *= passes
        dgamma, dbeta = np.einsum("ij,ij->j", dh, zhat), np.ones(n) @ dh
        G[f"mlp.{i}.gamma"] += dgamma
        G[f"mlp.{i}.beta"] += dbeta
        zhat *= dgamma / n
        dh -= zhat
        dh -= dbeta / n
        dh *= P[f"mlp.{i}.gamma"] * inv
        G[f"mlp.{i}.w"] += dh.T @ h_in
        G[f"mlp.{i}.b"] += np.ones(n) @ dh
        dh = dh @ P[f"mlp.{i}.w"]
    return dh


# ---------------------------------------------------------------------------
# Whole network
# ---------------------------------------------------------------------------

def forward(P, spec: ModelSpec, g, a, o, z, gen, train=False, rng=None, bn_stats=None, scratch=None):
    """Raw (unclamped) output and the cache needed by :func:`backward`."""
    E = spec.embed_dim
    if spec.model_type == "ncf":
        u = _user_fwd(P, "user", g, a, o, z)
        m = _movie_fwd(P, "movie", gen)
        h, caches = _mlp_fwd(P, spec, np.concatenate([u, m], axis=1), train, rng, bn_stats, scratch)
        raw = h @ P["out.w"][0] + P["out.b"][0]
        return raw, {"h": h, "caches": caches}
    gu = _user_fwd(P, "gmf_user", g, a, o, z)
    gm = _movie_fwd(P, "gmf_movie", gen)
    mu_ = _user_fwd(P, "mlp_user", g, a, o, z)
    mm = _movie_fwd(P, "mlp_movie", gen)
    h, caches = _mlp_fwd(P, spec, np.concatenate([mu_, mm], axis=1), train, rng, bn_stats, scratch)
    comb = np.concatenate([gu * gm, h], axis=1)
    raw = comb @ P["out.w"][0] + P["out.b"][0]
    return raw, {"gu": gu, "gm": gm, "comb": comb, "caches": caches, "E": E}


class Scorer:
    """Raw outputs in evaluation, as :func:`forward` gives them, for many batches of one network.

    What a row's user adds to the first layer, and to its GMF vector, is looked up in tables made once: fields share a table, a row for each
    combination of theirs, as long as it has at most ``MOST_ROWS`` (the four default fields make one of 3,234). A movie's is the sum of
    two rows, one for each half of its genre mask: no multi-hot, and no product but those after the first layer. Batch normalisation is part of
    the weights. Rows are scored ``TILE`` at a time, so that what is made of them stays in a core's cache.
    """

    TILE = 256

    MOST_ROWS = 4096
    HALF = N_GENRES // 2

    def __init__(self, P, spec: ModelSpec):
        self.P, self.spec = P, spec
        E, gmf = spec.embed_dim, spec.model_type == "neumf"
        user, movie = ("mlp_user", "mlp_movie") if gmf else ("user", "movie")
        self.gmf = E if gmf else 0  # columns of a table before those of the first layer
        # Without a hidden layer, the output is the first layer.
        w, b = (P["out.w"][:, self.gmf:], np.zeros(1))
        if spec.hidden_dims:
            (w, b), *self.layers = (self._folded(P, i) for i in range(len(spec.hidden_dims)))

        def columns(tower, block, part):
            own = part(tower) @ w[:, block].T
            return np.hstack([part("gmf_" + tower.split("_")[-1]), own]) if gmf else own

        self.users = []  # (table, [what each value of a field adds to the row's number])
        for k, name in enumerate(EMBEDDINGS):
            def part(p):
                fd = P[f"{p}.gender_emb"].shape[1]
                return P[f"{p}.{name}"] @ P[f"{p}.proj_w"][:, k * fd:(k + 1) * fd].T
            table = columns(user, slice(0, E), part)
            n = len(table)
            if self.users and len(self.users[-1][0]) * n <= self.MOST_ROWS:
                held, numbers = self.users.pop()
                self.users.append(((held[:, None] + table).reshape(-1, table.shape[1]), [x * n for x in numbers] + [np.arange(n)]))
            else:
                self.users.append((table, [np.arange(n)]))
        self.users[0][0][:] += columns(user, slice(0, E), lambda p: P[f"{p}.proj_b"][None])
        self.users[0][0][:, self.gmf:] += b
        bits = multihot(np.arange(1 << self.HALF), self.HALF)
        self.low, self.high = (columns(movie, slice(E, 2 * E), lambda p: bits @ P[f"{p}.proj_w"][:, start:start + self.HALF].T) for start in (0, self.HALF))
        self.low += columns(movie, slice(E, 2 * E), lambda p: P[f"{p}.proj_b"][None])

    @staticmethod
    def _folded(P, i):
        """Weights and bias of hidden layer ``i``, with its normalisation."""
        scale, shift = bn_fold(P, i)
        return P[f"mlp.{i}.w"] * scale[:, None], P[f"mlp.{i}.b"] * scale + shift

    def __call__(self, g, a, o, z, mask) -> np.ndarray:
        out = np.empty(len(mask))
        for start in range(0, len(mask), self.TILE):
            rows = slice(start, start + self.TILE)
            out[rows] = self._scored(g[rows], a[rows], o[rows], z[rows], mask[rows])
        return out

    def _scored(self, g, a, o, z, mask) -> np.ndarray:
        fields, u = iter((g, a, o, z)), None
        for table, numbers in self.users:
            rows = table.take(sum(x.take(next(fields)) for x in numbers), axis=0)
            u = rows if u is None else u + rows
        m = self.low.take(mask & ((1 << self.HALF) - 1), axis=0)
        m += self.high.take((mask >> self.HALF) & ((1 << self.HALF) - 1), axis=0)
        P, w, h = self.P, self.P["out.w"][0], u[:, self.gmf:] + m[:, self.gmf:]
        if self.spec.hidden_dims:
            np.maximum(h, 0.0, out=h)
            for weights, bias in self.layers:
                h = h @ weights.T
                h += bias
                np.maximum(h, 0.0, out=h)
            raw = h @ w[self.gmf:]
        else:
            raw = h[:, 0]
        if self.gmf:
            raw += (u[:, :self.gmf] * m[:, :self.gmf]) @ w[:self.gmf]
        raw += P["out.b"][0]
        return raw


def predict(P, spec: ModelSpec, g, a, o, z, gen) -> np.ndarray:
    raw, _ = forward(P, spec, g, a, o, z, gen, train=False)
    return np.clip(raw, spec.rating_min, spec.rating_max)


def backward(P, spec: ModelSpec, cache, draw, g, a, o, z, gen, out: dict | None = None) -> dict:
    """Gradients of all trainable parameters given d(loss)/d(raw), added to ``out`` (zeros if none is given). The cache is used up."""
    G = {n: np.zeros_like(P[n]) for n in spec.trainable_names()} if out is None else out
    E = spec.embed_dim
    hot = _one_hot(P, "user" if spec.model_type == "ncf" else "mlp_user", (g, a, o, z))
    if spec.model_type == "ncf":
        h = cache["h"]
        G["out.w"][0] += draw @ h
        G["out.b"][0] += draw.sum()
        dh = np.outer(draw, P["out.w"][0])
        d0 = _mlp_bwd(P, G, spec, cache["caches"], dh)
        _user_bwd(P, G, "user", hot, d0[:, :E])
        _movie_bwd(P, G, "movie", gen, d0[:, E:])
        return G
    comb = cache["comb"]
    G["out.w"][0] += draw @ comb
    G["out.b"][0] += draw.sum()
    dcomb = np.outer(draw, P["out.w"][0])
    dgmf, dh = dcomb[:, :E], dcomb[:, E:].copy()
    _user_bwd(P, G, "gmf_user", hot, dgmf * cache["gm"])
    _movie_bwd(P, G, "gmf_movie", gen, dgmf * cache["gu"])
    d0 = _mlp_bwd(P, G, spec, cache["caches"], dh)
    _user_bwd(P, G, "mlp_user", hot, d0[:, :E])
    _movie_bwd(P, G, "mlp_movie", gen, d0[:, E:])
    return G


def loss_and_grads(P, spec, g, a, o, z, gen, y, rng=None, bn_stats=None, clamp_in_training=False, out=None, scratch=None):
    """Mean squared error of one mini-batch and its gradients, added to ``out`` if given."""
    raw, cache = forward(P, spec, g, a, o, z, gen, train=True, rng=rng, bn_stats=bn_stats, scratch=scratch)
    if clamp_in_training:
        pred = np.clip(raw, spec.rating_min, spec.rating_max)
        inside = (raw >= spec.rating_min) & (raw <= spec.rating_max)
    else:
        pred, inside = raw, None
    err = pred - y
    loss = float(np.mean(err * err))
    draw = 2.0 * err / len(y)
    if inside is not None:
        draw = draw * inside
    return loss, backward(P, spec, cache, draw, g, a, o, z, gen, out)


def design(P, spec: ModelSpec, g, a, o, z, mask) -> np.ndarray:
    """Rows as :func:`train_step` takes them: ones at the four embeddings, the genre flags, and a last column of ones."""
    tower = "user" if spec.model_type == "ncf" else "mlp_user"
    sizes = [len(P[f"{tower}.{name}"]) for name in EMBEDDINGS]
    X = np.zeros((len(g), sum(sizes) + N_GENRES + 1))
    rows = np.arange(0, X.size, X.shape[1])
    for start, n, ix in zip(np.cumsum([0] + sizes), sizes, (g, a, o, z)):
        if len(ix) and not (0 <= ix.min() and ix.max() < n):
            raise IndexError(f"a feature index is not in 0 to {n - 1}")
        X.reshape(-1)[rows + (start + ix)] = 1.0
    X[:, sum(sizes):-1] = (mask[:, None] >> np.arange(N_GENRES)) & 1
    X[:, -1] = 1.0
    return X


def train_step(P, spec: ModelSpec, X, y, rng, bn_stats: dict, out: dict, scratch: dict, clamp_in_training: bool = False) -> float:
    """:func:`loss_and_grads` of a network with a hidden layer, for rows of :func:`design`: the same loss, gradients, running moments and
    draws, but for the order in which sums are added up.

    Towers and first layer are one product: the towers are linear in X, so the layer is X @ C with a small C made for each step (less its means, by
    the column of ones). Its variances follow from X.T @ X, and normalisation is a scale and shift of C, so that the rows are
    walked for the product and the positive part only; backwards, all but X.T @ d is as small as C. A bias before normalisation has no gradient.
    """
    n, E, gmf = len(y), spec.embed_dim, spec.model_type == "neumf"
    user, movie = ("mlp_user", "mlp_movie") if gmf else ("user", "movie")
    W, F = P["mlp.0.w"], X.shape[1] - 1 - N_GENRES
    tables = _side_by_side(P, user, scratch)
    both = _kept(scratch, "both", (F + N_GENRES, 2 * E))  # user tower and movie tower, as one matrix
    np.matmul(tables, P[f"{user}.proj_w"].T, out=both[:F, :E])
    both[F:, E:] = P[f"{movie}.proj_w"].T
    C = _kept(scratch, "C", (F + N_GENRES + 1, len(W)))
    np.matmul(both, W.T, out=C[:-1])
    moments = X.T @ X
    mean = moments[-1, :-1] / n
    mu = mean @ C[:-1]
    np.negative(mu, out=C[-1])
    XZ = moments @ C  # X.T @ Z, Z = X @ C
    var = np.maximum(np.einsum("ij,ij->j", C, XZ), 0.0)
    var /= n
    inv = 1.0 / np.sqrt(var + BN_EPS)
    shift = W @ np.concatenate([P[f"{user}.proj_b"], P[f"{movie}.proj_b"]]) + P["mlp.0.b"]
    bn_stats["mlp.0.run_mean"] = (1 - BN_MOMENTUM) * bn_stats["mlp.0.run_mean"] + BN_MOMENTUM * (mu + shift)
    bn_stats["mlp.0.run_var"] = (1 - BN_MOMENTUM) * bn_stats["mlp.0.run_var"] + BN_MOMENTUM * (var * n / max(n - 1, 1))
    scale = P["mlp.0.gamma"] * inv
    array = _arrays((n, len(scale)), 0, scratch)
    layer = C * scale
    layer[-1] += P["mlp.0.beta"]
    h0 = np.matmul(X, layer, out=array("out"))
    passes = _passed(spec, h0, rng, array)
    h, caches = _mlp_fwd(P, spec, h0, True, rng, bn_stats, scratch, first=1)
    G, w = out, P["out.w"][0]
    raw = h @ w[-h.shape[1]:]
    raw += P["out.b"][0]
    if gmf:
        hot, gen = X[:, :F], X[:, F:-1]
        gu = hot @ (_side_by_side(P, "gmf_user", scratch) @ P["gmf_user.proj_w"].T) + P["gmf_user.proj_b"]
        gm = _movie_fwd(P, "gmf_movie", gen)
        product = gu * gm
        raw += product @ w[:E]
    err, inside = raw, None
    if clamp_in_training:
        inside = (raw >= spec.rating_min) & (raw <= spec.rating_max)
        err = np.clip(raw, spec.rating_min, spec.rating_max)
    err = err - y
    loss = float(err @ err) / n
    draw = err * (2.0 / n)
    if inside is not None:
        draw *= inside
    G["out.w"][0, -h.shape[1]:] += draw @ h
    G["out.b"][0] += draw.sum()
    if gmf:
        G["out.w"][0, :E] += draw @ product
        dgmf = np.outer(draw, w[:E])
        _user_bwd(P, G, "gmf_user", hot, dgmf * gm)
        _movie_bwd(P, G, "gmf_movie", gen, dgmf * gu)
    d = _mlp_bwd(P, G, spec, caches, np.outer(draw, w[-h.shape[1]:]), first=1)
    d *= passes
    sums = X.T @ d
    dgamma = inv * np.einsum("ij,ij->j", C, sums)
    G["mlp.0.gamma"] += dgamma
    G["mlp.0.beta"] += sums[-1]
    XZ *= inv * dgamma / n
    sums -= XZ
    sums = sums[:-1] - mean[:, None] * sums[-1]
    sums *= scale  # the gradient of C
    G["mlp.0.w"] += sums.T @ both
    sums = sums @ W  # of ``both``
    G[f"{movie}.proj_w"] += sums[F:, E:].T
    G[f"{user}.proj_w"] += sums[:F, :E].T @ tables
    sums, at = sums[:F, :E] @ P[f"{user}.proj_w"], 0
    for k, name in enumerate(EMBEDDINGS):
        table = G[f"{user}.{name}"]
        table += sums[at:at + len(table), k * table.shape[1]:(k + 1) * table.shape[1]]
        at += len(table)
    return loss


def _kept(scratch: dict, name: str, shape: tuple) -> np.ndarray:
    """Zeros, of which a caller always sets the same part."""
    if name not in scratch:
        scratch[name] = np.zeros(shape)
    return scratch[name]


def _side_by_side(P, p, scratch: dict) -> np.ndarray:
    """The four embedding tables as blocks of one matrix: a row for each value of a field, columns of its field only."""
    tables = [P[f"{p}.{name}"] for name in EMBEDDINGS]
    rows, columns = sum(len(t) for t in tables), sum(t.shape[1] for t in tables)
    out, at = _kept(scratch, f"tables of {p}", (rows, columns)), 0
    for k, t in enumerate(tables):
        out[at:at + len(t), k * t.shape[1]:(k + 1) * t.shape[1]] = t
        at += len(t)
    return out


class KeyedDraws:
    """Uniform numbers that depend on each row's 64-bit key, the call and the column only: a row gets the same
    dropout on whichever worker it lies."""

    def __init__(self, keys: np.ndarray, seed: int):
        self.keys, self.calls = keys.astype(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 % 2 ** 64), 0

    def random(self, shape) -> np.ndarray:
        self.calls += 1
        column = np.arange(shape[1], dtype=np.uint64) + (np.uint64(self.calls) << np.uint64(32))
        x = self.keys[:, None] + column[None, :] * np.uint64(0xD1B54A32D192ED03)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) * 2.0 ** -53


# ---------------------------------------------------------------------------
# Optimiser
# ---------------------------------------------------------------------------

def clip_grad_norm(G: dict, max_norm: float = 1.0) -> float:
    total = math.sqrt(sum(float((v * v).sum()) for v in G.values()))
    coef = max_norm / (total + 1e-6)
    if coef < 1.0:
        for v in G.values():
            v *= coef
    return total


def adam_step(P, G, M, V, t: int, lr: float, betas=(0.9, 0.999), eps=1e-8, weight_decay=1e-5):
    """One Adam step with L2 weight decay added to the gradient; updates in place."""
    b1, b2 = betas
    c1, c2 = 1.0 - b1 ** t, 1.0 - b2 ** t
    for n, gr in G.items():
        if weight_decay:
            gr = gr + weight_decay * P[n]
        M[n] = b1 * M[n] + (1 - b1) * gr
        V[n] = b2 * V[n] + (1 - b2) * gr * gr
        P[n] = P[n] - lr * (M[n] / c1) / (np.sqrt(V[n] / c2) + eps)


class FlatAdam:
    """Clipping and Adam over all trainable parameters at once: ``params``, ``grads`` and the moments are views of one vector each, changed in place.
    The same numbers as :func:`clip_grad_norm` and :func:`adam_step`, but for the order in which the norm is added up."""

    def __init__(self, P: dict, M: dict, V: dict, spec: ModelSpec, names: list):
        self.p, self.m, self.v = (flatten(x, names) for x in (P, M, V))
        self.g, self.a, self.b = (np.zeros_like(self.p) for _ in range(3))
        self.params, self.grads, self.M, self.V = (unflatten(x, spec, names) for x in (self.p, self.g, self.m, self.v))

    def step(self, t: int, lr: float, betas=(0.9, 0.999), eps=1e-8, weight_decay=1e-5, max_norm: float = 1.0) -> None:
        """One step by the gradients in ``grads``, which are zero afterwards."""
        (b1, b2), g, a, b = betas, self.g, self.a, self.b
        coef = max_norm / (math.sqrt(float(g @ g)) + 1e-6)
        if coef < 1.0:
            g *= coef
        if weight_decay:
            g += np.multiply(self.p, weight_decay, out=a)
        self.m *= b1
        self.m += np.multiply(g, 1 - b1, out=a)
        self.v *= b2
        g *= g
        g *= 1 - b2
        self.v += g
        c = math.sqrt(1.0 - b2 ** t)
        np.sqrt(self.v, out=b)
        b += eps * c
        np.divide(self.m, b, out=a)
        a *= lr * c / (1.0 - b1 ** t)
        self.p -= a
        g[:] = 0.0


def cosine_lr(epoch: int, num_epochs: int, lr: float, min_ratio: float = 0.01) -> float:
    """Learning rate of ``epoch`` (0-based) under cosine annealing to lr * min_ratio."""
    eta_min = lr * min_ratio
    return eta_min + (lr - eta_min) * (1 + math.cos(math.pi * epoch / max(num_epochs, 1))) / 2
