"""Log-bilinear language model in numpy, trained by noise-contrastive estimation.

Tokens: 0 is the end of a text (and what stands before its start), the others are words and classes of words. The two tokens before predict a vector, each through a matrix of its own, and the score of a
token is the product with its vector plus a bias. Training tells true tokens from noise drawn by frequency.

Scores add up over the two context tokens, so the sum over the vocabulary for every pair of context
tokens is one product of two matrices of exponentials; with it log-probabilities are exactly normalised and
scoring a text is looking up three tables.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np

END = 0


@dataclass
class Bilinear:
    context: np.ndarray  # tokens x d
    near: np.ndarray  # d x d, for the token before
    far: np.ndarray  # d x d, for the one before that
    target: np.ndarray  # tokens x d
    bias: np.ndarray

    @classmethod
    def start(cls, frequency: np.ndarray, d: int, seed: int = 7) -> "Bilinear":
        """A model that predicts by frequency alone."""
        rng = np.random.default_rng(seed)
        n = len(frequency)
        eye = np.eye(d, dtype=np.float32)
        return cls(rng.normal(0, 0.3, (n, d)).astype(np.float32), eye.copy(), 0.5 * eye, np.zeros((n, d), np.float32), np.log(frequency).astype(np.float32))

    def parts(self) -> list[np.ndarray]:
        return [self.context, self.near, self.far, self.target, self.bias]

    def pack(self) -> bytes:
        return np.concatenate([p.ravel() for p in self.parts()]).astype(np.float32).tobytes()

    def unpack(self, raw: bytes) -> "Bilinear":
        """A model of the same shape from packed numbers."""
        flat, out, at = np.frombuffer(raw, np.float32), [], 0
        for p in self.parts():
            out.append(flat[at:at + p.size].reshape(p.shape).copy())
            at += p.size
        return Bilinear(*out)

    def train(self, one: np.ndarray, two: np.ndarray, token: np.ndarray, frequency: np.ndarray, seed: int, batch: int = 512, noise: int = 128, rate: float = 0.1) -> None:
        """One pass over (token before, the one before that, token), in place; noise is shared within a batch."""
        rng = np.random.default_rng(seed)
        cumulated = np.cumsum(frequency)
        log_noise = (np.log(frequency) + np.log(noise)).astype(np.float32)
        seen = [np.full(p.shape, 1e-2, np.float32) for p in self.parts()]

        # numbers of two bytes are sorted by digits
        short = np.int16 if len(frequency) <= 1 << 15 else np.int64

        def sigmoid(x: np.ndarray) -> np.ndarray:
            np.clip(x, -30, 30, out=x)
            np.exp(np.negative(x, out=x), out=x)
            x += 1
            return np.reciprocal(x, out=x)

        def groups(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """Order by token, where each token begins, and the tokens."""
            rows = rows.astype(short)
            order = rows.argsort(kind="stable")
            put = rows[order]
            first = np.empty(len(put), bool)
            first[0] = True
            np.not_equal(put[1:], put[:-1], out=first[1:])
            starts = first.nonzero()[0]
            return order, starts, put[starts]

        def step(i: int, gradient: np.ndarray, by: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None) -> None:
            value, square = parts[i], seen[i]
            if by is None:
                square += gradient * gradient
                value += rate * gradient / np.sqrt(square)
                return
            order, starts, unique = by
            total = np.add.reduceat(gradient.take(order, axis=0), starts, axis=0)
            now = square.take(unique, axis=0)
            now += total * total
            square[unique] = now
            total *= rate
            total /= np.sqrt(now, out=now)
            value[unique] += total

        parts = self.parts()
        for at in range(0, len(token), batch):
            u, v, w = one[at:at + batch], two[at:at + batch], token[at:at + batch]
            drawn = np.minimum(np.searchsorted(cumulated, rng.random(noise) * cumulated[-1], side="right"), len(frequency) - 1)
            ru, rv, tw, td = self.context.take(u, axis=0), self.context.take(v, axis=0), self.target.take(w, axis=0), self.target.take(drawn, axis=0)
            said = ru @ self.near
            said += rv @ self.far
            true = 1 - sigmoid((said * tw).sum(1) + self.bias[w] - log_noise[w])
            false = said @ td.T
            false += self.bias[drawn]
            false -= log_noise[drawn]
            false = np.negative(sigmoid(false), out=false)
            back = true[:, None] * tw
            back += false @ td
            near, far = self.near.copy(), self.far.copy()
            by = groups(np.concatenate([w, drawn]))
            step(3, np.concatenate([true[:, None] * said, false.T @ said]), by)
            step(4, np.concatenate([true, false.sum(0)]), by)
            step(1, ru.T @ back)
            step(2, rv.T @ back)
            step(0, np.concatenate([back @ near.T, back @ far.T]), groups(np.concatenate([u, v])))

    def tables(self) -> "Tables":
        a = (self.context @ self.near) @ self.target.T + self.bias
        b = (self.context @ self.far) @ self.target.T
        top_a, top_b = a.max(1), b.max(1)
        whole = np.exp(a - top_a[:, None]) @ np.exp(b - top_b[:, None]).T
        return Tables(a, b, np.log(whole) + top_a[:, None] + top_b)


@dataclass
class Tables:
    one: np.ndarray
    two: np.ndarray
    whole: np.ndarray  # log of the sum over all tokens, by (token before, the one before that)

    def log_prob(self, u: np.ndarray, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Natural log-probability of each token after its two context tokens."""
        return self.one[u, w].astype(np.float64) + self.two[v, w] - self.whole[u, v]
