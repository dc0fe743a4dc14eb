import numpy as np
import pytest

from wordloom.config import ModelConfig
from wordloom.operators import network
from wordloom.operators.network import Network, Trainer, dropout, layout, log_softmax, model_sizes, parameter_count

SIZES = [5, 7, 6, 4]


def sample(rows=9):
    rng = np.random.default_rng(3)
    x, labels = rng.normal(size=(rows, 5)), rng.integers(0, 4, rows)
    mask = np.ones(rows)
    mask[2] = 0
    return x, labels, mask


def trainer():
    return Trainer(np.random.default_rng(1).normal(size=parameter_count(SIZES)) * 0.5, SIZES)


def test_default_architecture():
    sizes = model_sizes(ModelConfig())
    assert sizes == [32, 128, 128, 3001] and parameter_count(sizes) == 407_865
    assert len({layer for layer, _, _ in layout(sizes)}) == 3


@pytest.mark.parametrize("drop_prob", [0.0, 0.4])
def test_gradient_by_finite_differences(drop_prob):
    net, (x, labels, mask) = trainer(), sample()
    keeps = dropout(len(x), SIZES, drop_prob, [1, 2], np.float64)
    gradient = net.gradient(x, labels, mask, keeps).copy()

    def loss():
        logp = log_softmax(net._layers(x, keeps)[-1])
        return -(logp[np.arange(len(x)), labels] * mask).sum() / len(x)

    for at in range(0, net.flat.size, 5):
        kept, step = net.flat[at], 1e-6
        net.flat[at] = kept + step
        up = loss()
        net.flat[at] = kept - step
        down = loss()
        net.flat[at] = kept
        assert gradient[at] == pytest.approx((up - down) / (2 * step), abs=1e-6)


def test_loss_is_masked_mean():
    net, (x, labels, mask) = trainer(), sample()
    logp = log_softmax(net.logits(x).copy())
    np.testing.assert_allclose(np.exp(logp).sum(axis=1), 1)
    assert net.loss(x, labels, mask) == pytest.approx(-(logp[np.arange(9), labels] * mask).sum() / 9)


def test_adam_against_its_definition():
    net, (x, labels, mask) = trainer(), sample()
    flat, m, v = net.flat.copy(), np.zeros(net.flat.size), np.zeros(net.flat.size)
    for t in range(1, 6):
        g = net.gradient(x, labels, mask).copy()
        net.adam(0.01)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        flat -= 0.01 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        np.testing.assert_allclose(net.flat, flat, atol=1e-12)


def test_units_that_are_zero_in_a_batch_are_left_out(monkeypatch):
    """The output layer's products take the units that some row uses; results and gradients are those of all units."""
    sizes, rng = [5, 30, 40, 6], np.random.default_rng(4)
    flat = rng.normal(size=parameter_count(sizes)) * 0.3
    x, labels, mask = rng.normal(size=(50, 5)), rng.integers(0, 6, 50), np.ones(50)
    net = Trainer(flat.copy(), sizes)
    for dead in (slice(0, 15), slice(10, 20), slice(0, 0), slice(30, 40)):
        net.tensors[3][:] = 0
        net.tensors[3][dead] = -1e3
        found = net.gradient(x, labels, mask).copy()
        assert (net.live is not None) == (dead.stop > 0) and not net.grad_tensors[4][dead].any()
        scored = net.loss(x, labels, mask), net.logits(x).copy()
        with monkeypatch.context() as all_units:
            all_units.setattr(network, "LEAST_ROWS", 51)
            whole = Trainer(net.flat.copy(), sizes)
            np.testing.assert_allclose(found, whole.gradient(x, labels, mask), atol=1e-14)
            assert whole.live is None and scored[0] == pytest.approx(whole.loss(x, labels, mask))
            np.testing.assert_allclose(scored[1], whole.logits(x))


def test_adam_by_blocks_adds_up_the_parameters(monkeypatch):
    whole, parts, (x, labels, mask) = trainer(), trainer(), sample()
    total, want = np.zeros(whole.flat.size), np.zeros(whole.flat.size)
    for _ in range(3):
        whole.gradient(x, labels, mask)
        whole.adam(0.01)
        want += whole.flat
        parts.gradient(x, labels, mask)
        with monkeypatch.context() as small:
            small.setattr(network, "ADAM_BLOCK", 7)
            parts.adam(0.01, total=total)
    np.testing.assert_array_equal(whole.flat, parts.flat)
    np.testing.assert_array_equal(total, want)


def test_dropout_scale_and_key():
    assert dropout(3, SIZES, 0.0, [1], np.float32) is None
    first, second = (dropout(4000, SIZES, 0.2, [1, 2], np.float32) for _ in range(2))
    other = dropout(4000, SIZES, 0.2, [1, 3], np.float32)
    assert all((a == b).all() for a, b in zip(first, second)) and (first[0] != other[0]).any()
    assert set(np.unique(first[0])) == {0, np.float32(1.25)} and first[0].mean() == pytest.approx(1, abs=0.02)


def test_buffers_serve_batches_of_any_size():
    net = Network(trainer().flat, SIZES)
    x, _, _ = sample(9)
    whole = net.logits(x).copy()
    np.testing.assert_allclose(net.logits(x[:4]), whole[:4])
    np.testing.assert_allclose(net.logits(np.tile(x, (3, 1)))[9:18], whole)


def test_learning_rates():
    cfg = ModelConfig()
    assert [cfg.learning_rate(e) for e in (1, 2, 3)] == pytest.approx([0.005, 0.0045, 0.00405])


@pytest.mark.parametrize("positions", [1, 5, 128, 129, 512])
@pytest.mark.parametrize("projected", [False, True])
def test_attention_by_blocks_of_keys(positions, projected):
    from wordloom.operators.network import attention, projections

    rng = np.random.default_rng(positions)
    x = rng.normal(size=(3, positions, 8)) * 4
    weights = projections(8, 5) if projected else None
    q, k, v = (x @ w for w in weights) if projected else (x, x, x)
    scores = np.einsum("nqe,nke->nqk", q, k) / np.sqrt(8)
    shares = np.exp(scores - scores.max(axis=2, keepdims=True))
    want = np.einsum("nqk,nke->nqe", shares / shares.sum(axis=2, keepdims=True), v)
    np.testing.assert_allclose(attention(x, weights), want, atol=1e-12)
    np.testing.assert_allclose(attention(x, weights, block=7), want, atol=1e-12)


def test_memory_of_wide_attention_is_no_square():
    import tracemalloc

    from wordloom.operators.network import attention

    peaks = []
    for positions in (1024, 4096):
        x = np.random.default_rng(0).normal(size=(1, positions, 4))
        tracemalloc.start()
        attention(x)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 5 * peaks[0] < 4096 * 4096 * 8
