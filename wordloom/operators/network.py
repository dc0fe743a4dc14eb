"""The one network of this package, in NumPy, for use inside Spark tasks.

Two hidden layers with ReLU, a softmax output, all parameters in one flat array.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np

from wordloom.config import ModelConfig
from wordloom.functions.draws import TWO_32
from wordloom.functions.vectors import ANGLE_BASE, EMBEDDING_SCALE

# An odd number near 2^64 over the golden ratio, and two odd factors that spread bits.
GOLDEN = 0x9E3779B97F4A7C15
MIXERS = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
KEY_BLOCK = 128
# Of RFC 1321: steps from sines, and the turns of each round. Keys hashed at once: their arrays fit a core's cache.
MD5_STEPS = [np.uint32(int(abs(math.sin(i + 1)) * 2**32)) for i in range(64)]
MD5_SHIFTS = ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21))
MD5_KEYS = 8192
FEW_KEYS = 256
# Elements of each array that an Adam update takes at once: a core's cache holds them.
ADAM_BLOCK = 32_768
# The output layer's products leave out units that are zero in the whole batch, if so many rows and units are left: BLAS
# takes other ways for less, which may round otherwise.
LEAST_ROWS, LEAST_UNITS = 32, 16


def layout(sizes: list[int]) -> list[tuple[int, str, tuple[int, ...]]]:
    """(layer, name, shape) of each tensor, in flat order, for [inputs, hidden..., outputs]."""
    tensors = []
    for layer, (fan_in, fan_out) in enumerate(zip(sizes, sizes[1:])):
        tensors += [(layer, "weight", (fan_in, fan_out)), (layer, "bias", (fan_out,))]
    return tensors


def model_sizes(cfg: ModelConfig) -> list[int]:
    """The last output stands for every word beyond the first vocabulary_size: no sample is left out."""
    return [cfg.input_size, cfg.layer_size, cfg.layer_size, cfg.vocabulary_size + 1]


def as_outputs(labels: np.ndarray, outputs: int) -> np.ndarray:
    """The output of each label: its own, or the last one for all ids from there on."""
    return np.minimum(labels, outputs - 1)


def parameter_count(sizes: list[int]) -> int:
    return sum(int(np.prod(shape)) for _, _, shape in layout(sizes))


def views(flat: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    out, at = [], 0
    for _, _, shape in layout(sizes):
        n = int(np.prod(shape))
        out.append(flat[at : at + n].reshape(shape))
        at += n
    return out


def log_softmax(logits: np.ndarray) -> np.ndarray:
    shifted = logits - logits.max(axis=1, keepdims=True)
    return shifted - np.log(np.exp(shifted).sum(axis=1, keepdims=True))


class Network:
    """Forward and backward passes on one flat parameter array.

    Layer outputs live in buffers that the next pass overwrites: batches are small and many, and
    fresh arrays for each would cost as much as the arithmetic.
    """

    def __init__(self, flat: np.ndarray, sizes: list[int]):
        self.flat, self.sizes = flat, sizes
        self.tensors = views(flat, sizes)
        self.buffers: list[np.ndarray] = []
        # Of the last pass: the output layer's units that are not zero in all rows, if the others are left out.
        self.live: np.ndarray | None = None
        self.live_weight: np.ndarray | None = None

    def _layers(self, x: np.ndarray, keeps: list[np.ndarray] | None = None) -> list[np.ndarray]:
        rows, depth = len(x), len(self.sizes) - 1
        if not self.buffers or len(self.buffers[0]) < rows:
            self.buffers = [np.empty((rows, width), dtype=self.flat.dtype) for width in self.sizes[1:]]
        acts = [x]
        for layer in range(depth):
            out = self.buffers[layer][:rows]
            if layer == depth - 1:
                self.factors = self._factors(acts[-1])
            np.matmul(*(self.factors if layer == depth - 1 else (acts[-1], self.tensors[2 * layer])), out=out)
            out += self.tensors[2 * layer + 1]
            if layer < depth - 1:
                np.maximum(out, 0, out=out)
                if keeps is not None:
                    out *= keeps[layer]
            acts.append(out)
        return acts

    def _factors(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The factors of the output layer, without the units that are zero in all rows: these add nothing."""
        weight, self.live = self.tensors[-2], None
        if len(self.sizes) < 3 or len(x) < LEAST_ROWS:
            return x, weight
        live = np.flatnonzero(x.max(axis=0) != 0)
        if not LEAST_UNITS <= len(live) <= 0.9 * x.shape[1]:
            return x, weight
        self.live = live
        if self.live_weight is None:
            self.live_weight = np.empty_like(weight)
        # With any mode but the default, take writes to out without a copy.
        return x[:, live], weight.take(live, axis=0, out=self.live_weight[: len(live)], mode="clip")

    def logits(self, x: np.ndarray) -> np.ndarray:
        return self._layers(x)[-1]

    def loss(self, x: np.ndarray, labels: np.ndarray, mask: np.ndarray) -> float:
        """Masked negative log-likelihood, summed and divided by the rows of the batch."""
        out = self.logits(x)
        out -= out.max(axis=1, keepdims=True)
        picked = out[np.arange(len(labels)), labels]
        nll = np.log(np.exp(out, out=out).sum(axis=1)) - picked
        return float((nll * mask).sum(dtype=np.float64) / len(labels))


class Trainer(Network):
    """A network with its gradient and Adam's state."""

    def __init__(self, flat: np.ndarray, sizes: list[int]):
        super().__init__(flat, sizes)
        self.grad = np.zeros_like(flat)
        self.grad_tensors = views(self.grad, sizes)
        self.first, self.second = np.zeros_like(flat), np.zeros_like(flat)
        self.scratch, self.steps = np.empty(min(ADAM_BLOCK, flat.size), flat.dtype), 0
        self.live_grad: np.ndarray | None = None

    def gradient(self, x, labels, mask, keeps=None) -> np.ndarray:
        """Gradient of loss, by back-propagation, into one flat array."""
        acts = self._layers(x, keeps)
        delta, last = acts[-1], len(self.sizes) - 2
        delta -= delta.max(axis=1, keepdims=True)
        np.exp(delta, out=delta)
        delta /= delta.sum(axis=1, keepdims=True)
        delta[np.arange(len(labels)), labels] -= 1
        delta *= (mask / len(labels)).astype(delta.dtype)[:, None]
        for layer in range(last, -1, -1):
            delta.sum(axis=0, out=self.grad_tensors[2 * layer + 1])
            if layer == last:
                self._output_gradient(delta)
            else:
                np.matmul(acts[layer].T, delta, out=self.grad_tensors[2 * layer])
            if layer:
                delta = self._before_outputs(delta) if layer == last else delta @ self.tensors[2 * layer].T
                delta[acts[layer] <= 0] = 0
                if keeps is not None:
                    delta *= keeps[layer - 1]
        return self.grad

    def _output_gradient(self, delta: np.ndarray) -> None:
        """Gradient of the output layer's weight; that of the units that were left out is zero."""
        x, grad = self.factors[0], self.grad_tensors[-2]
        if self.live is None:
            np.matmul(x.T, delta, out=grad)
            return
        if self.live_grad is None:
            self.live_grad = np.empty_like(grad)
        dead = np.ones(len(grad), dtype=bool)
        dead[self.live] = False
        grad[self.live] = np.matmul(x.T, delta, out=self.live_grad[: len(self.live)])
        grad[dead] = 0

    def _before_outputs(self, delta: np.ndarray) -> np.ndarray:
        found = delta @ self.factors[1].T
        if self.live is None:
            return found
        out = np.zeros((len(delta), self.sizes[-2]), found.dtype)
        out[:, self.live] = found
        return out

    def adam(
        self, rate: float, beta1: float = 0.9, beta2: float = 0.999, eps: float = 1e-8, total: np.ndarray | None = None
    ) -> None:
        """One Adam update from the last gradient, in place, block by block; the new parameters are added to total."""
        self.steps += 1
        scale1, scale2 = rate / (1 - beta1**self.steps), 1 / (1 - beta2**self.steps)
        for start in range(0, self.flat.size, ADAM_BLOCK):
            at = slice(start, start + ADAM_BLOCK)
            p, g, m, v = self.flat[at], self.grad[at], self.first[at], self.second[at]
            tmp = self.scratch[: len(p)]
            m *= beta1
            np.multiply(g, 1 - beta1, out=tmp)
            m += tmp
            v *= beta2
            np.multiply(g, g, out=tmp)
            tmp *= 1 - beta2
            v += tmp
            np.multiply(v, scale2, out=tmp)
            np.sqrt(tmp, out=tmp)
            tmp += eps
            np.divide(m, tmp, out=tmp)
            tmp *= scale1
            p -= tmp
            if total is not None:
                total[at] += p


def mixed(x: np.ndarray) -> np.ndarray:
    """Numbers below 2^64 whose bits all depend on all bits of x."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(MIXERS[0])
    x ^= x >> np.uint64(27)
    x *= np.uint64(MIXERS[1])
    x ^= x >> np.uint64(31)
    return x


def dropout(rows: int, sizes: list[int], drop_prob: float, key: list[int], dtype) -> list[np.ndarray] | None:
    """Scaled keep masks of the hidden layers, by a hash of key, layer, row and unit alone."""
    if drop_prob <= 0:
        return None
    start = np.zeros(1, np.uint64)
    for part in key:
        start = mixed(start * np.uint64(GOLDEN) + np.uint64(part + 1))
    scale, least, masks = np.dtype(dtype).type(1.0 / (1.0 - drop_prob)), np.uint64(drop_prob * (1 << 24)), []
    for layer, width in enumerate(sizes[1:-1]):
        place = (np.arange(rows, dtype=np.uint64)[:, None] << np.uint64(20)) + np.arange(width, dtype=np.uint64)
        drawn = mixed(start + (place + np.uint64(layer << 56)) * np.uint64(GOLDEN)) >> np.uint64(40)
        masks.append((drawn >= least) * scale)
    return masks


def md5_words(keys: list[str]) -> np.ndarray:
    """First twelve bytes of each key's md5 as three unsigned 32-bit numbers."""
    digests = b"".join(hashlib.md5(k.encode(), usedforsecurity=False).digest() for k in keys)
    return np.frombuffer(digests, dtype=">u4").reshape(-1, 4).astype(np.int64)


def md5_of_numbers(seed: int, numbers: np.ndarray, size: int) -> np.ndarray:
    """md5_words of seed:number:d for each number and each d below size, by operations on arrays of keys.

    A key of less than 56 bytes is one block of md5. Numbers of the same length are taken together. Longer keys, and so
    few that arrays do not pay, are hashed one by one.
    """
    if len(numbers) * size < FEW_KEYS or len(f"{seed}:{-2**63}:{size}") > 55:
        return md5_words([f"{seed}:{t}:{d}" for t in numbers.tolist() for d in range(size)])[:, :3]
    out = np.empty((len(numbers), size, 3), dtype=np.int64)
    digits = np.char.str_len(numbers.astype(str))
    widths = [len(str(d)) for d in range(size)]
    for n in np.unique(digits):
        at = np.flatnonzero(digits == n)
        text = numbers[at].astype(f"S{n}").view(np.uint8).reshape(len(at), n)
        for width in sorted(set(widths)):
            dims = [d for d in range(size) if widths[d] == width]
            tails = np.array([f":{d}".encode() for d in dims]).view(np.uint8).reshape(len(dims), -1)
            head = np.frombuffer(f"{seed}:".encode(), np.uint8)
            length = len(head) + n + tails.shape[1]
            for start in range(0, len(at), max(1, MD5_KEYS // len(dims))):
                some = slice(start, start + max(1, MD5_KEYS // len(dims)))
                block = np.zeros((len(at[some]), len(dims), 64), np.uint8)
                block[:, :, : len(head)] = head
                block[:, :, len(head) : len(head) + n] = text[some][:, None, :]
                block[:, :, len(head) + n : length] = tails
                block[:, :, length], block[:, :, 56:64] = 128, np.frombuffer(int(8 * length).to_bytes(8, "little"), np.uint8)
                found = _md5_blocks(np.ascontiguousarray(block.view("<u4").reshape(-1, 16).T))
                out[at[some][:, None], dims] = found.byteswap().astype(np.int64).T.reshape(-1, len(dims), 3)
    return out.reshape(-1, 3)


def _md5_blocks(words: np.ndarray) -> np.ndarray:
    """The first three numbers of the md5 (RFC 1321) of messages of one block, given as [16, n] numbers."""
    start = [np.uint32(v) for v in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)]
    a, b, c, d = (np.full(words.shape[1], v) for v in start)
    for i in range(64):
        turn, shift = divmod(i, 16)[0], MD5_SHIFTS[i // 16][i % 4]
        if turn == 0:
            f, g = d ^ (b & (c ^ d)), i
        elif turn == 1:
            f, g = c ^ (d & (b ^ c)), (5 * i + 1) % 16
        elif turn == 2:
            f, g = b ^ c ^ d, (3 * i + 5) % 16
        else:
            f, g = c ^ (b | ~d), (7 * i) % 16
        f += a
        f += words[g]
        f += MD5_STEPS[i]
        a, d, c, b = d, c, b, b + ((f << np.uint32(shift)) | (f >> np.uint32(32 - shift)))
    return np.stack([a + start[0], b + start[1], c + start[2]])


def uniform_draws(keys: list[str]) -> np.ndarray:
    """Same draws as functions.draws.uniform(key, 1)."""
    return (md5_words(keys)[:, 0] + 1) / TWO_32


def projections(size: int, seed: int) -> list[np.ndarray]:
    """Seeded query, key and value matrices: gauss(seed, name, i, j) / sqrt(size)."""
    words = md5_words([f"{seed}:{name}:{i}:{j}" for name in "qkv" for i in range(size) for j in range(size)])
    radius = np.sqrt(-2.0 * np.log((words[:, 0] + 1) / TWO_32))
    drawn = radius * np.cos(2.0 * np.pi * (words[:, 1] + 1) / TWO_32) / np.sqrt(size)
    return list(drawn.reshape(3, size, size))


def attention(x: np.ndarray, projected: list[np.ndarray] | None = None, block: int = KEY_BLOCK) -> np.ndarray:
    """softmax(Q Kt / sqrt(size)) V for matrices [n, positions, size]; Q, K and V are x unless projected.

    Keys are taken block by block. Each query keeps the largest score so far, and the sum and weighted values relative to
    it, so a window's memory grows with its positions times a block, not with their square.
    """
    q, k, v = (x @ w for w in projected) if projected else (x, x, x)
    positions, scale = x.shape[1], np.sqrt(x.shape[2])
    top = total = out = None
    for at in range(0, positions, block):
        scores = np.einsum("nqe,nke->nqk", q, k[:, at : at + block]) / scale
        peak = scores.max(axis=2, keepdims=True)
        peak = peak if top is None else np.maximum(top, peak)
        weights = np.exp(scores - peak)
        part, values = weights.sum(axis=2, keepdims=True), np.einsum("nqk,nke->nqe", weights, v[:, at : at + block])
        if top is None:
            top, total, out = peak, part, values
        else:
            fade = np.exp(top - peak)
            top, total, out = peak, total * fade + part, out * fade + values
    return out / total if positions else np.zeros_like(x)


# The vectors of recent tokens in this process, by seed and size: the tasks and epochs that follow need the same ones.
# Those of one seed and size are kept at a time.
_RECENT: dict[tuple[int, int], dict[int, np.ndarray]] = {}


def _recent(seed: int, size: int) -> dict[int, np.ndarray]:
    if (seed, size) not in _RECENT:
        _RECENT.clear()
    return _RECENT.setdefault((seed, size), {})


class ContextFeatures:
    """The features of operators.features for whole batches, with the vectors of recent tokens kept."""

    def __init__(self, cfg: ModelConfig, kept_bytes: int = 16 * 1024 * 1024):
        self.cfg, self.kept_tokens = cfg, kept_bytes // (8 * cfg.embedding_size)
        size = cfg.embedding_size
        self.known = _recent(cfg.seed, size)
        self.projected = projections(size, cfg.seed) if cfg.projected else None
        pos = np.arange(cfg.window_size)[:, None]
        dim = np.arange(size)[None, :]
        angle = pos / np.power(ANGLE_BASE, 2 * dim / size)
        self.positions = np.where(dim % 2 == 0, np.sin(angle), np.cos(angle))

    def _vectors(self, tokens: np.ndarray) -> np.ndarray:
        size, seed = self.cfg.embedding_size, self.cfg.seed
        if len(self.known) > self.kept_tokens:
            self.known.clear()
        fresh = [t for t in tokens.tolist() if t not in self.known]
        if fresh:
            words = md5_of_numbers(seed, np.array(fresh, dtype=np.int64), size)
            radius = np.sqrt(-2.0 * np.log((words[:, 0] + 1) / TWO_32))
            values = radius * np.cos(2.0 * np.pi * (words[:, 1] + 1) / TWO_32) * EMBEDDING_SCALE
            self.known.update(zip(fresh, values.reshape(-1, size)))
            if len(fresh) == len(tokens):
                return values.reshape(-1, size)
        return np.stack([self.known[t] for t in tokens.tolist()])

    def vectors_at(self, tokens: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Token vectors with the values of their positions, one row each."""
        if not len(tokens):
            return np.zeros((0, self.cfg.embedding_size))
        ids, at = np.unique(tokens, return_inverse=True)
        return self._vectors(ids)[at] + self.positions[places]

    def __call__(self, contexts: np.ndarray, full: np.ndarray) -> np.ndarray:
        """contexts [n, positions]; rows that are not full give zeros."""
        n, width = contexts.shape
        out = np.zeros((n, width * self.cfg.embedding_size))
        if full.any():
            ids, places = np.unique(contexts[full], return_inverse=True)
            x = self._vectors(ids)[places.reshape(-1, width)] + self.positions[:width]
            if width > 1 or self.projected:
                x = attention(x, self.projected)
            out[full] = x.reshape(len(x), -1)
        return out


def running_sums(probs: np.ndarray, temperature: float, logits: bool = False) -> np.ndarray:
    """Running sums of softmax(p / temperature), row by row."""
    scaled = np.asarray(probs, dtype=np.float64) / temperature
    scaled = np.exp(scaled - scaled.max(axis=1, keepdims=True)) if logits else np.exp(scaled)
    return np.cumsum(scaled / scaled.sum(axis=1, keepdims=True), axis=1)


def sample_rows(probs: np.ndarray, draws: np.ndarray, temperature: float, logits: bool = False) -> np.ndarray:
    """Next index of each row: softmax(p / temperature), then the first running sum >= draw, else 0."""
    return first_reached(running_sums(probs, temperature, logits), np.arange(len(probs)), draws)


def first_reached(running: np.ndarray, rows: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """The first place of each of the given rows of running sums that is at least its draw, else 0: by bisection."""
    width = running.shape[1]
    low, high = np.zeros(len(rows), dtype=np.int64), np.full(len(rows), width)
    for _ in range(width.bit_length()):
        middle = (low + high) // 2
        open_, below = low < high, running[rows, np.minimum(middle, width - 1)] < draws
        low, high = np.where(open_ & below, middle + 1, low), np.where(open_ & ~below, middle, high)
    return np.where(low < width, low, 0)
