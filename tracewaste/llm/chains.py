"""Linear chains over ragged batches of sequences: scaled forward and backward recursions.

A batch is the concatenation of its sequences. All sequences step together, longest first, so that
those still running are always the first ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Tokens of one batch or of one segment of a long sequence; bounds the memory of a recursion.
BATCH_TOKENS = 400_000


def batches(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Indexes of the sequences of each batch, longest first; empty sequences are left out."""
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    cut = np.cumsum(lengths[order]) // BATCH_TOKENS
    for group in np.split(order, np.flatnonzero(np.diff(cut)) + 1):
        if len(group):
            yield group


def gather(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the tokens of the chosen sequences, and the start of each in their concatenation."""
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    return np.repeat(starts - first, lengths) + np.arange(lengths.sum()), first


def running(lengths: np.ndarray) -> np.ndarray:
    """How many sequences are longer than t, for each step t; lengths fall."""
    return np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")


def by_step(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of all tokens step by step, how many run in each step, and where each step begins."""
    counts = running(lengths)
    begins = np.concatenate([[0], np.cumsum(counts)[:-1]])
    which = np.arange(counts.sum()) - np.repeat(begins, counts)
    return starts[which] + np.repeat(np.arange(len(counts)), counts), counts, begins


def forward(unary, starts, lengths, first, trans):
    """Scaled forward recursion: (state probabilities given the past, scale) of each token.

    The product of a sequence's scales is its likelihood. The recursion keeps a row a state and the
    tokens of a step side by side, so that a step works on plain slices.
    """
    at, counts, begins = by_step(starts, lengths)
    states = np.ascontiguousarray(unary[at].T)
    sums = np.empty(len(at), unary.dtype)
    move = np.ascontiguousarray(trans.T)
    before = None
    for t, (n, begin) in enumerate(zip(counts.tolist(), begins.tolist(), strict=True)):
        now, total = states[:, begin : begin + n], sums[begin : begin + n]
        now *= first[:, None] if t == 0 else move @ before[:, :n]
        np.add.reduce(now, axis=0, out=total)
        now /= total
        before = now
    alpha, scale = np.empty_like(unary), np.empty(len(unary), unary.dtype)
    alpha[at] = states.T
    scale[at] = sums
    return alpha, scale


def backward(unary, scale, starts, lengths, trans, last=None):
    """Scaled backward recursion: beta, and unary * beta / scale, which the transitions need.

    ``last`` is the beta of the sequences' last tokens, 1 if they end there.
    """
    at, counts, begins = by_step(starts, lengths)
    next_to = np.ascontiguousarray(unary[at].T)
    next_to /= scale[at]
    states = np.ones_like(next_to)
    if last is not None:
        ends = begins[lengths - 1] + np.arange(len(lengths))
        states[:, ends] = last.T
        next_to[:, ends] *= last.T
    sizes, firsts = counts.tolist(), begins.tolist()
    for t in range(len(sizes) - 2, -1, -1):
        n, begin, after = sizes[t + 1], firsts[t], firsts[t + 1]
        b = trans @ next_to[:, after : after + n]
        states[:, begin : begin + n] = b
        next_to[:, begin : begin + n] *= b
    beta, ahead = np.ones_like(unary), np.empty_like(unary)
    beta[at] = states.T
    ahead[at] = next_to.T
    return beta, ahead


def expected_transitions(alpha, ahead, starts, lengths, trans) -> np.ndarray:
    """Expected count of each transition, summed over all sequences."""
    inner = np.ones(len(alpha), bool)
    inner[starts + lengths - 1] = False
    at = np.flatnonzero(inner)
    return trans * (alpha[at].T @ ahead[at + 1]).astype(np.float64)


def segments(n: int) -> list[slice]:
    """A long sequence cut into segments of BATCH_TOKENS."""
    return [slice(i, min(n, i + BATCH_TOKENS)) for i in range(0, n, BATCH_TOKENS)]


def forward_segments(unary_of, n: int, first, trans):
    """(segment, alpha, scale) of one long sequence in turn; ``unary_of(segment)`` gives its unaries.

    Only the last alpha of a segment is carried into the next.
    """
    start = first
    for part in segments(n):
        length = np.array([part.stop - part.start])
        alpha, scale = forward(unary_of(part), np.zeros(1, np.int64), length, start, trans)
        yield part, alpha, scale
        start = alpha[-1] @ trans


def expected_segments(unary_of, n: int, first, trans):
    """(segment, state probabilities, expected transitions) of one long sequence, last segment first.

    The forward pass keeps what each segment starts from, one row a segment; the segments' recursions
    are then run again from there, backwards, so that one segment is held at a time.
    """
    parts, starts, start = segments(n), [], first
    for part, alpha, _ in forward_segments(unary_of, n, first, trans):
        starts.append(start)
        start = alpha[-1] @ trans
        del part
    zero, last, following = np.zeros(1, np.int64), None, None
    for part, start in zip(reversed(parts), reversed(starts), strict=True):
        unary, length = unary_of(part), np.array([part.stop - part.start])
        alpha, scale = forward(unary, zero, length, start, trans)
        if following is not None:
            last = (following @ trans.T)[None, :]
        beta, ahead = backward(unary, scale, zero, length, trans, last)
        moves = expected_transitions(alpha, ahead, zero, length, trans)
        if following is not None:
            moves = moves + trans * np.outer(alpha[-1], following).astype(np.float64)
        following = ahead[0].copy()
        yield part, alpha * beta, moves
