"""Gradient checks of the numpy kernel by central finite differences."""
import numpy as np
import pytest

from cinerank.model import kernel as K
from cinerank.model.spec import ModelSpec, fixed_params, init_params, param_count


def _batch(rng, n=12):
    return (rng.integers(0, 2, n), rng.integers(0, 7, n), rng.integers(0, 21, n),
            rng.integers(0, 11, n), K.multihot(rng.integers(0, 1 << 18, n)),
            rng.integers(1, 6, n).astype(float))


@pytest.mark.parametrize("model_type", ["ncf", "neumf"])
def test_gradients_match_finite_differences(model_type):
    spec = ModelSpec(model_type, embed_dim=4, hidden_dims=[5, 3], dropout=0.0)
    P = init_params(spec, seed=1, out_bias=3.0)
    rng = np.random.default_rng(0)
    g, a, o, z, gen, y = _batch(rng)
    _, G = K.loss_and_grads(P, spec, g, a, o, z, gen, y)
    h = 1e-6
    for name in spec.trainable_names():
        flat = P[name].ravel()
        for j in rng.choice(flat.size, size=min(4, flat.size), replace=False):
            old = flat[j]
            flat[j] = old + h
            lp, _ = K.loss_and_grads(P, spec, g, a, o, z, gen, y)
            flat[j] = old - h
            lm, _ = K.loss_and_grads(P, spec, g, a, o, z, gen, y)
            flat[j] = old
            num = (lp - lm) / (2 * h)
            assert abs(num - G[name].ravel()[j]) < 1e-5 * max(1.0, abs(num)), (name, j)


def test_param_counts_at_defaults():
    assert param_count(ModelSpec("ncf")) == 20369
    assert param_count(ModelSpec("neumf")) == 23745


def test_cosine_schedule_endpoints():
    assert K.cosine_lr(0, 10, 1e-3) == pytest.approx(1e-3)
    assert K.cosine_lr(10, 10, 1e-3) == pytest.approx(1e-5)


@pytest.mark.parametrize("model_type", ["ncf", "neumf"])
def test_flat_adam_in_kept_arrays_is_clipping_and_adam(model_type):
    """Steps on one vector, in arrays kept from batch to batch (also of other sizes), equal steps array by array."""
    spec = ModelSpec(model_type, embed_dim=4, hidden_dims=[5, 3], dropout=0.3)
    P = init_params(spec, seed=1, out_bias=3.0)
    names, bufs = spec.trainable_names(), spec.buffer_names()
    M, V = ({n: np.zeros_like(P[n]) for n in names} for _ in range(2))
    adam, scratch = K.FlatAdam(P, M, V, spec, names), {}
    flat = {**P, **adam.params}
    draws, flat_draws, rng = np.random.default_rng(3), np.random.default_rng(3), np.random.default_rng(0)
    for t, n in enumerate((12, 12, 7, 12), 1):
        batch = _batch(rng, n)
        loss, G = K.loss_and_grads(P, spec, *batch, rng=draws, bn_stats=P)
        K.clip_grad_norm(G, 0.5)
        K.adam_step(P, G, M, V, t, 1e-2)
        got, _ = K.loss_and_grads(flat, spec, *batch, rng=flat_draws, bn_stats=flat, out=adam.grads, scratch=scratch)
        adam.step(t, 1e-2, max_norm=0.5)
        assert got == pytest.approx(loss, rel=1e-12)
    for name in names + bufs:
        assert np.allclose(flat[name], P[name], rtol=1e-9, atol=1e-8), name  # biases before a normalisation move by rounding alone
    assert all(np.allclose(adam.M[n], M[n], atol=1e-12) and np.allclose(adam.V[n], V[n], atol=1e-12) for n in names)


@pytest.mark.parametrize("model_type", ["ncf", "neumf"])
@pytest.mark.parametrize("hidden", [[], [4], [6, 5]])
@pytest.mark.parametrize("most_rows", [1, 50, 4096])  # a table per field, some fields together, one for all
def test_scorer_from_tables_equals_forward(monkeypatch, model_type, hidden, most_rows):
    monkeypatch.setattr(K.Scorer, "MOST_ROWS", most_rows)
    spec, rng = ModelSpec(model_type, embed_dim=4, hidden_dims=hidden), np.random.default_rng(0)
    P = {n: v + rng.uniform(0.1, 0.4, v.shape) for n, v in init_params(spec, seed=1).items()}
    kept = {n: v.copy() for n, v in P.items()}
    score = K.Scorer(P, spec)
    for n in (200, 0, 1):
        g, a, o, z = (rng.integers(0, size, n).astype(np.int32) for size in (2, 7, 21, 11))
        mask = rng.integers(0, 1 << 18, n).astype(np.int32)
        raw, _ = K.forward(P, spec, g, a, o, z, K.multihot(mask))
        assert np.allclose(score(g, a, o, z, mask), raw, rtol=1e-12, atol=1e-12)
    assert all((P[n] == kept[n]).all() for n in P)
    one = np.zeros(1, int)
    for field, size in enumerate((2, 7, 21, 11)):  # no value of a field is taken for one of its neighbour
        with pytest.raises(IndexError):
            score(*(np.full(1, size) if k == field else one for k in range(4)), one)


@pytest.mark.parametrize("model_type", ["ncf", "neumf"])
def test_scorer_gives_the_same_bits_for_dyadic_parameters(model_type):
    spec = ModelSpec(model_type, embed_dim=4, hidden_dims=[4], dropout=0.0)
    P, rng = fixed_params(spec), np.random.default_rng(0)
    g, a, o, z = (rng.integers(0, size, 500) for size in (2, 7, 21, 11))
    mask = rng.integers(0, 1 << 18, 500)
    raw, _ = K.forward(P, spec, g, a, o, z, K.multihot(mask))
    assert (K.Scorer(P, spec)(g, a, o, z, mask) == raw).all()


@pytest.mark.parametrize("model_type", ["ncf", "neumf"])
@pytest.mark.parametrize("hidden,clamp", [([16, 8], False), ([8], True), ([12, 8, 6], False)])
def test_a_training_step_is_that_of_loss_and_grads(model_type, hidden, clamp):
    """Towers and first layer as one product: the same loss, gradients, running moments and dropout, for odd batches too."""
    spec = ModelSpec(model_type, embed_dim=8, hidden_dims=hidden)
    P = init_params(spec, 3, 3.0)
    for i, (name, v) in enumerate(P.items()):
        P[name] = v + 0.1 * np.random.default_rng(i).random(v.shape)  # biases and moments that aren't zero
    for n in (2, 65, 256):
        r = np.random.default_rng(n)
        x = [r.integers(0, m, n) for m in (2, 7, 21, 11)]
        mask, y = r.integers(0, 1 << 18, n), r.integers(1, 6, n).astype(float)
        seen = [{k: v.copy() for k, v in P.items() if "run_" in k} for _ in range(2)]
        loss, G = K.loss_and_grads(P, spec, *x, K.multihot(mask), y, rng=np.random.default_rng(1), bn_stats=seen[0], clamp_in_training=clamp)
        out = {name: np.zeros_like(P[name]) for name in spec.trainable_names()}
        got = K.train_step(P, spec, K.design(P, spec, *x, mask), y, np.random.default_rng(1), seen[1], out, {}, clamp)
        assert got == pytest.approx(loss, rel=1e-12)
        for k, v in G.items():
            assert np.abs(out[k] - v).max() < 1e-9 * max(1.0, np.abs(v).max()), (n, k)
        assert all(np.allclose(seen[1][k], v, rtol=1e-10) for k, v in seen[0].items())
    with pytest.raises(IndexError):
        K.design(P, spec, np.array([2]), *(np.array([0]) for _ in range(4)))
