"""Linear-chain conditional random fields over hashed features: fitting, marginals, best paths.

A model is small (one weight per hashed feature and tag, one per pair of tags) and is
fitted on the driver from a bounded sample; inside tasks only its arrays are used.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from zlib import crc32

import numpy as np

# Feature 0 is padding and always weighs nothing.
WIDTH = 1 << 18


def feature(name: str) -> int:
    return crc32(name.encode()) % (WIDTH - 1) + 1


@dataclass
class Chain:
    """Scores of features by tag, of the first tag, and of a tag after a tag."""

    weights: np.ndarray
    start: np.ndarray
    moves: np.ndarray

    def emission(self, features: Sequence[int]) -> np.ndarray:
        return self.weights[np.asarray(features, np.int64)].sum(axis=0)


def _log_sum(scores: np.ndarray, axis: int) -> np.ndarray:
    top = scores.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(scores - top).sum(axis=axis))


def _posteriors(chain: Chain, scores: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of tags (sequence, step, tag), and expected counts of moves, over padded sequences."""
    count, steps, tags = scores.shape
    ahead, back = np.empty_like(scores), np.zeros_like(scores)
    ahead[:, 0] = chain.start + scores[:, 0]
    for t in range(1, steps):
        ahead[:, t] = _log_sum(ahead[:, t - 1, :, None] + chain.moves, 1) + scores[:, t]
    for t in range(steps - 2, -1, -1):
        later = _log_sum(chain.moves + (scores[:, t + 1] + back[:, t + 1])[:, None, :], 2)
        back[:, t] = np.where((t + 1 < lengths)[:, None], later, 0.0)
    last = ahead[np.arange(count), lengths - 1]
    total = _log_sum(last, 1)
    alone = np.exp(ahead + back - total[:, None, None])
    inside = np.arange(1, steps)[None, :] < lengths[:, None]
    joint = ahead[:, :-1, :, None] + chain.moves + (scores[:, 1:] + back[:, 1:])[:, :, None, :] - total[:, None, None, None]
    moved = np.where(inside[:, :, None, None], np.exp(np.minimum(joint, 0.0)), 0.0).sum(axis=(0, 1))
    alone[np.arange(steps)[None, :] >= lengths[:, None]] = 0.0
    return alone, moved


def fit(
    sequences: Sequence[np.ndarray], tags: Sequence[np.ndarray], n_tags: int = 2, epochs: int = 8, batch: int = 256, seed: int = 7
) -> Chain:
    """Fit by Adam on the log-likelihood; a sequence is an array (step, feature) with zeros for padding."""
    chain = Chain(np.zeros((WIDTH, n_tags)), np.zeros(n_tags), np.zeros((n_tags, n_tags)))
    parts = [chain.weights, chain.start, chain.moves]
    first, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    order = np.argsort([len(s) for s in sequences], kind="stable")
    batches = [order[i : i + batch] for i in range(0, len(order), batch)]
    shuffle, step = np.random.default_rng(seed), 0
    wide = max((s.shape[1] for s in sequences), default=1)
    eye = np.eye(n_tags)
    for _ in range(epochs):
        for at in shuffle.permutation(len(batches)):
            chosen = batches[at]
            lengths = np.array([len(sequences[i]) for i in chosen])
            features = np.zeros((len(chosen), lengths.max(), wide), np.int64)
            gold = np.zeros((len(chosen), lengths.max(), n_tags))
            moved_gold = np.zeros((n_tags, n_tags))
            for row, i in enumerate(chosen):
                features[row, : lengths[row], : sequences[i].shape[1]] = sequences[i]
                gold[row, : lengths[row]] = eye[tags[i]]
                np.add.at(moved_gold, (tags[i][:-1], tags[i][1:]), 1.0)
            alone, moved = _posteriors(chain, chain.weights[features].sum(axis=2), lengths)
            off = (alone - gold) / len(chosen)
            touched, place = np.unique(features, return_inverse=True)
            place = place.ravel()
            slope = np.empty((len(touched), n_tags))
            for k in range(n_tags):
                slope[:, k] = np.bincount(place, np.repeat(off[:, :, k].ravel(), wide), len(touched))
            slope += 1e-6 * chain.weights[touched]
            step += 1
            slopes = [slope, off[:, 0].sum(axis=0), (moved - moved_gold) / len(chosen)]
            # Only the weights of features in the batch move.
            for part, m, v, g, rows in zip(parts, first, second, slopes, [touched, slice(None), slice(None)], strict=True):
                m[rows] += 0.1 * (g - m[rows])
                v[rows] += 0.01 * (g * g - v[rows])
                part[rows] -= 0.1 * (m[rows] / (1 - 0.9**step)) / (np.sqrt(v[rows] / (1 - 0.99**step)) + 1e-6)
            chain.weights[0] = 0.0
    return chain


def pair_marginals(chain: Chain, leads: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Probability of tag 1 for each token of many two-tag sequences laid end to end.

    leads: score of tag 1 less that of tag 0, per token. begins: whether a token starts
    a sequence. A step multiplies by a 2 by 2 matrix, a step into a new sequence by one with
    equal rows, which forgets what came before. Products over blocks of tokens advance
    together, so the number of numpy steps is about the square root of that of tokens.
    """
    n = len(leads)
    if n == 0:
        return np.zeros(0)
    height = max(1, int(np.sqrt(n)))
    width = -(-n // height)
    # One matrix per token, [from][to]; tokens added at the end are identities.
    steps = np.zeros((2, 2, width * height))
    steps[0, 0, n:] = steps[1, 1, n:] = 1.0
    moves = np.exp(chain.moves - chain.moves.max())
    start = np.exp(chain.start - chain.start.max())
    lift = np.exp(np.clip(leads, -30.0, 30.0))
    for i in range(2):
        for j in range(2):
            steps[i, j, :n] = np.where(begins, start[j], moves[i, j]) * (lift if j else 1.0)
    steps = steps.reshape(2, 2, width, height)

    # ahead[..., t]: product of a block's first t + 1 matrices; back[..., t]: of those after t.
    ahead, back = np.empty_like(steps), np.empty_like(steps)
    running = np.broadcast_to(np.eye(2)[:, :, None], (2, 2, width)).copy()
    for t in range(height):
        running = np.einsum("ijw,jkw->ikw", running, steps[:, :, :, t])
        running /= running.max(axis=(0, 1))
        ahead[:, :, :, t] = running
    running = np.broadcast_to(np.eye(2)[:, :, None], (2, 2, width)).copy()
    for t in range(height - 1, -1, -1):
        back[:, :, :, t] = running
        running = np.einsum("ijw,jkw->ikw", steps[:, :, :, t], running)
        running /= running.max(axis=(0, 1))
    into, outof = np.empty((2, width)), np.empty((2, width))
    vector = np.ones(2)
    for w in range(width):
        into[:, w] = vector
        vector = vector @ ahead[:, :, w, -1]
        vector /= vector.max()
    vector = np.ones(2)
    for w in range(width - 1, -1, -1):
        outof[:, w] = vector
        vector = ahead[:, :, w, -1] @ vector
        vector /= vector.max()
    left = np.einsum("iw,ijwt->jwt", into, ahead)
    right = np.einsum("ijwt,jw->iwt", back, outof)
    both = left * right
    return (both[1] / (both[0] + both[1])).reshape(-1)[:n]


def best_tags(chain: Chain, sequences: Sequence[np.ndarray]) -> list[np.ndarray]:
    """The best path of each sequence of emission scores (step, tag). Those of like length advance together."""
    found: list[np.ndarray] = [np.zeros(0, np.int8)] * len(sequences)
    order = sorted(range(len(sequences)), key=lambda i: len(sequences[i]))
    while order:
        # None is filled up to more than twice its length and some steps, so one long sequence widens no others.
        most = 2 * len(sequences[order[0]]) + 64
        group = [i for i in order if len(sequences[i]) <= most]
        order = order[len(group) :]
        for i, path in zip(group, _best_together(chain, [sequences[i] for i in group]), strict=True):
            found[i] = path
    return found


def _best_together(chain: Chain, sequences: Sequence[np.ndarray]) -> list[np.ndarray]:
    lengths = np.array([len(s) for s in sequences])
    steps, tags = max(1, lengths.max()), len(chain.start)
    scores = np.zeros((len(sequences), steps, tags))
    for row, sequence in enumerate(sequences):
        scores[row, : len(sequence)] = sequence
    best = chain.start + scores[:, 0]
    came = np.zeros((len(sequences), steps, tags), np.int8)
    ends = np.zeros(len(sequences), np.int64)
    ends[lengths == 1] = best[lengths == 1].argmax(axis=1)
    for t in range(1, steps):
        options = best[:, :, None] + chain.moves
        came[:, t] = options.argmax(axis=1)
        best = options.max(axis=1) + scores[:, t]
        over = lengths == t + 1
        ends[over] = best[over].argmax(axis=1)
    found = []
    for row, length in enumerate(lengths):
        path = np.zeros(length, np.int8)
        tag = ends[row]
        for t in range(length - 1, -1, -1):
            path[t] = tag
            tag = came[row, t, tag]
        found.append(path)
    return found
