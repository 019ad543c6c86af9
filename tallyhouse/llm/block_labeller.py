"""A bidirectional LSTM in numpy that says of each block of a page whether it is article.

A block enters as one vector: its tag path and its words, each hashed into slots,
and a few measures. One pass reads a page from its first block, one from its last,
so every block is judged with the whole page in view.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np

from tallyhouse.llm import html_examples
from tallyhouse.llm.html_blocks import Block, blocks

PATH_SLOTS, WORD_SLOTS, MEASURES = 192, 32, 5
INPUTS = PATH_SLOTS + WORD_SLOTS + MEASURES
HIDDEN = 20
EXAMPLES, ROUNDS, AT_ONCE, RATE = 2800, 6, 32, 0.01


@lru_cache(maxsize=1 << 16)
def _slot(word: str, slots: int) -> int:
    return zlib.crc32(word.encode("utf-8", "replace")) % slots


def vector(block: Block) -> np.ndarray:
    out = np.zeros(INPUTS, dtype=np.float32)
    depth = len(block.path)
    for place, name in enumerate(block.path):
        out[_slot(name, PATH_SLOTS)] = 1.0 if place < depth - 2 else 1.5
    words = block.text.split()
    slots = [_slot(word.lower(), WORD_SLOTS) for word in words]
    out[PATH_SLOTS:-MEASURES] = np.bincount(slots, minlength=WORD_SLOTS) / max(len(words), 1)
    out[-5] = np.log1p(len(block.text)) / 5
    out[-4] = block.link_share
    out[-3] = np.log1p(len(words)) / 4
    out[-2] = block.text[-1:] in ".!?"
    out[-1] = "©" in block.text
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Pass:
    """One direction: weights, the pass itself, and its gradient."""

    def __init__(self, draw: np.random.Generator):
        self.w = draw.normal(0, 0.1, (INPUTS, 4 * HIDDEN)).astype(np.float32)
        self.u = draw.normal(0, 0.1, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
        self.b = np.zeros(4 * HIDDEN, dtype=np.float32)
        self.b[HIDDEN:2 * HIDDEN] = 1  # remember at first

    def run(self, x: np.ndarray, mask: np.ndarray, steps: list[int], keep: list | None = None):
        """States (page, step, HIDDEN); steps beyond a page's end leave the state as it is."""
        n, length, _ = x.shape
        inputs = (x.reshape(n * length, -1) @ self.w).reshape(n, length, -1) + self.b
        h = np.zeros((n, HIDDEN), np.float32)
        c = np.zeros((n, HIDDEN), np.float32)
        out = np.zeros((n, length, HIDDEN), np.float32)
        for t in steps:
            z = inputs[:, t] + h @ self.u
            gates = _sigmoid(z[:, :3 * HIDDEN])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
            g = np.tanh(z[:, 3 * HIDDEN:])
            m = mask[:, t, None]
            new = f * c + i * g
            tanh = np.tanh(new)
            if keep is not None:
                keep.append((t, h, c, i, f, o, g, tanh, m))
            c = m * new + (1 - m) * c
            h = m * (o * tanh) + (1 - m) * h
            out[:, t] = h
        return out

    def gradient(self, x: np.ndarray, kept: list, outer: np.ndarray) -> list[np.ndarray]:
        n, length, _ = x.shape
        dz = np.zeros((n, length, 4 * HIDDEN), np.float32)
        du = np.zeros_like(self.u)
        dh = np.zeros((n, HIDDEN), np.float32)
        dc = np.zeros((n, HIDDEN), np.float32)
        for t, h, c, i, f, o, g, tanh, m in reversed(kept):
            dh = dh + outer[:, t]
            now, past = dh * m, dh * (1 - m)
            inner = (dc * m) + now * o * (1 - tanh ** 2)
            z = np.concatenate([
                inner * g * i * (1 - i), inner * c * f * (1 - f), now * tanh * o * (1 - o),
                inner * i * (1 - g ** 2),
            ], axis=1)
            dz[:, t] = z
            du += h.T @ z
            dh = past + z @ self.u.T
            dc = inner * f + dc * (1 - m)
        flat = dz.reshape(n * length, -1)
        return [x.reshape(n * length, -1).T @ flat, du, flat.sum(0)]


class Labeller:
    def __init__(self, seed: int = 5):
        draw = np.random.default_rng(seed)
        self.forward, self.backward = Pass(draw), Pass(draw)
        self.v = draw.normal(0, 0.1, 2 * HIDDEN).astype(np.float32)
        self.a = np.zeros(1, np.float32)

    def _padded(self, pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        length = max(len(page) for page in pages)
        x = np.zeros((len(pages), length, INPUTS), np.float32)
        mask = np.zeros((len(pages), length), np.float32)
        for row, page in enumerate(pages):
            x[row, :len(page)], mask[row, :len(page)] = page, 1
        return x, mask

    def scores(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """For each page (block, INPUTS), how likely each of its blocks is article."""
        x, mask = self._padded(pages)
        steps = list(range(x.shape[1]))
        both = np.concatenate([
            self.forward.run(x, mask, steps), self.backward.run(x, mask, steps[::-1])
        ], axis=2)
        out = _sigmoid(both @ self.v + self.a)
        return [out[row, :len(page)] for row, page in enumerate(pages)]

    def _weights(self) -> list[np.ndarray]:
        return [self.forward.w, self.forward.u, self.forward.b,
                self.backward.w, self.backward.u, self.backward.b, self.v, self.a]

    def _gradients(self, pages: list[np.ndarray], labels: list[np.ndarray]) -> list[np.ndarray]:
        x, mask = self._padded(pages)
        steps, kept, back = list(range(x.shape[1])), [], []
        both = np.concatenate([
            self.forward.run(x, mask, steps, kept), self.backward.run(x, mask, steps[::-1], back)
        ], axis=2)
        wanted = np.zeros_like(mask)
        for row, label in enumerate(labels):
            wanted[row, :len(label)] = label
        error = (_sigmoid(both @ self.v + self.a) - wanted) * mask / mask.sum()
        outer = error[:, :, None] * self.v
        return [
            *self.forward.gradient(x, kept, outer[:, :, :HIDDEN]),
            *self.backward.gradient(x, back, outer[:, :, HIDDEN:]),
            np.einsum("nt,nth->h", error, both), error.sum(keepdims=True)[0],
        ]

    def fit(self, pages: list[np.ndarray], labels: list[np.ndarray], seed: int = 3) -> None:
        """Adam over batches of pages of like length."""
        draw = np.random.default_rng(seed)
        weights = self._weights()
        first = [np.zeros_like(w) for w in weights]
        second = [np.zeros_like(w) for w in weights]
        order = sorted(range(len(pages)), key=lambda n: len(pages[n]))
        batches = [order[i:i + AT_ONCE] for i in range(0, len(order), AT_ONCE)]
        step = 0
        for round_ in range(ROUNDS):
            for at in draw.permutation(len(batches)).tolist():
                step += 1
                found = self._gradients([pages[n] for n in batches[at]], [labels[n] for n in batches[at]])
                norm = np.sqrt(sum(float((g ** 2).sum()) for g in found))
                rate = RATE * (1 - round_ / ROUNDS) * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
                for w, m, s, g in zip(weights, first, second, found):
                    g = g / max(norm, 1.0)
                    m += 0.1 * (g - m)
                    s += 0.001 * (g * g - s)
                    w -= (rate * m / (np.sqrt(s) + 1e-8)).astype(np.float32)


def example(html: str) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and labels of a page of `html_examples`, the marks taken off first."""
    marked = [block for block in blocks(html) if len(block.text) > 2]
    labels = np.array([block.text.startswith("+~") for block in marked], np.float32)
    return np.stack([vector(b._replace(text=b.text[2:].strip())) for b in marked]), labels


@lru_cache(maxsize=1)
def trained() -> Labeller:
    """The labeller, taught with `EXAMPLES` pages; once a process."""
    rows = [example(html) for html in html_examples.pages(EXAMPLES)]
    labeller = Labeller()
    labeller.fit([x for x, _ in rows], [y for _, y in rows])
    return labeller
