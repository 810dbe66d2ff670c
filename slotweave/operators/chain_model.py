"""Linear chains over tag sequences, as array code for one Arrow batch: sums over all paths, best paths, spans.

Sequences lie one after the other in flat arrays; ``offsets`` has the place where each begins, and the end. They are
worked on in blocks of similar lengths, longest first, one step of all sequences at a time. Steps that break the BIOES
rules have no weight at all: no path takes them.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

_CELLS = 1 << 15
_FORBIDDEN = -1e9
#: Weights count within e^-200 and e^200, which keeps every product of two steps a number.
_BOUND = 200.0


class Rules(NamedTuple):
    """Which tag may follow which, begin and end a sequence."""

    follows: np.ndarray
    begins: np.ndarray
    ends: np.ndarray


def bioes_rules(tags: list[str]) -> Rules:
    """A span is S, or B, any number of I, and E, all of one type; O stands between."""
    prefix = np.array([tag[0] for tag in tags])
    kind = np.array([tag[2:] for tag in tags])
    opens, closed = np.isin(prefix, list("OBS")), np.isin(prefix, list("OES"))
    inside = np.isin(prefix, list("BI"))[:, None] & np.isin(prefix, list("IE")) & (kind[:, None] == kind)
    return Rules(inside | closed[:, None] & opens, opens, closed)


class Chain(NamedTuple):
    """Weights of steps between tags, and of the first and last tag."""

    step: np.ndarray
    first: np.ndarray
    last: np.ndarray


class Block(NamedTuple):
    """Sequences of a block, longest first: where they begin, and how many have a step t."""

    number: np.ndarray
    start: np.ndarray
    active: np.ndarray


def blocks(offsets: np.ndarray) -> Iterator[Block]:
    lengths = np.diff(offsets)
    order = np.argsort(-lengths, kind="stable")
    order = order[:np.count_nonzero(lengths)]
    at = 0
    while at < len(order):
        longest = lengths[order[at]]
        number = order[at:at + max(1, _CELLS // longest)]
        at += len(number)
        active = np.searchsorted(-lengths[number], -np.arange(longest), "left")
        yield Block(number, offsets[number], active)


def _factors(weights: np.ndarray, allowed: np.ndarray) -> np.ndarray:
    return np.where(allowed, np.exp(np.clip(weights, -_BOUND, _BOUND)), 0.0)


class Expectation(NamedTuple):
    """Logarithm of the sum over all paths, summed over sequences, and expected counts of tags, steps, first and last."""

    log_total: float
    tags: np.ndarray
    chain: Chain


def expectation(scores: np.ndarray, offsets: np.ndarray, chain: Chain, rules: Rules) -> Expectation:
    """Forward and backward sums with each step scaled to 1; ``scores`` has one row per token."""
    step, first, last = (_factors(w, a) for w, a in zip(chain, rules, strict=True))
    out, total = np.zeros_like(scores), 0.0
    counts = Chain(np.zeros_like(chain.step), np.zeros_like(chain.first), np.zeros_like(chain.last))
    best = scores.max(axis=1, initial=-np.inf)
    factors = np.exp(np.maximum(scores - best[:, None], -_BOUND))
    for block in blocks(offsets):
        start, active = block.start, block.active
        forward, scale = [], []
        for t, m in enumerate(active):
            now = (first if t == 0 else forward[-1][:m] @ step) * factors[start[:m] + t]
            scale.append(now.sum(axis=1))
            forward.append(now / scale[-1][:, None])
            total += np.log(scale[-1]).sum() + best[start[:m] + t].sum()
        back = np.zeros((0, len(first)))
        for t in range(len(active) - 1, -1, -1):
            m, longer = active[t], len(back)
            ending = forward[t][longer:m]
            closing = ending @ last
            total += np.log(closing).sum()
            now = np.empty((m, len(first)))
            now[longer:] = last / closing[:, None]
            now[:longer] = back @ step.T
            both = forward[t] * now
            out[start[:m] + t] = both
            counts.last[:] += both[longer:].sum(axis=0)
            # What the step before sees: the tag's own factor, and the scale of its step.
            back = factors[start[:m] + t] * now / scale[t][:, None]
            if t:
                counts.step[:] += step * (forward[t - 1][:m].T @ back)
            else:
                counts.first[:] += both.sum(axis=0)
    return Expectation(total, out, counts)


def path_counts(ids: np.ndarray, offsets: np.ndarray, size: int) -> Chain:
    """Counts of the steps, first and last tags of given sequences."""
    counts = Chain(np.zeros((size, size)), np.zeros(size), np.zeros(size))
    filled = offsets[:-1][np.diff(offsets) > 0]
    inner = np.ones(len(ids), bool)
    inner[filled] = False
    at = np.flatnonzero(inner)
    np.add.at(counts.step, (ids[at - 1], ids[at]), 1)
    np.add.at(counts.first, ids[filled], 1)
    np.add.at(counts.last, ids[offsets[1:][np.diff(offsets) > 0] - 1], 1)
    return counts


def path_scores(scores: np.ndarray, ids: np.ndarray, offsets: np.ndarray, chain: Chain) -> float:
    """Sum of the weights along given sequences."""
    counts = path_counts(ids, offsets, scores.shape[1])
    return float(scores[np.arange(len(ids)), ids].sum() + sum((c * w).sum() for c, w in zip(counts, chain, strict=True)))


def keeps_rules(ids: np.ndarray, offsets: np.ndarray, rules: Rules) -> np.ndarray:
    """Which sequences take allowed steps only; empty ones do."""
    bad = np.zeros(len(ids) + 1, np.int64)
    filled = np.diff(offsets) > 0
    firsts, lasts = offsets[:-1][filled], offsets[1:][filled] - 1
    if len(ids):
        bad[1:len(ids)] += ~rules.follows[ids[:-1], ids[1:]]
        bad[firsts] = ~rules.begins[ids[firsts]]
        bad[lasts] += ~rules.ends[ids[lasts]]
    sums = np.concatenate([[0], np.cumsum(bad)])
    return sums[offsets[1:]] == sums[offsets[:-1]]


def best_paths(scores: np.ndarray, offsets: np.ndarray, chain: Chain, rules: Rules) -> np.ndarray:
    """Tag ids of the allowed path with the largest sum of weights; the lower id wins a tie."""
    step, first, last = (np.where(a, w, _FORBIDDEN) for w, a in zip(chain, rules, strict=True))
    out = np.zeros(len(scores), np.int32)
    for block in blocks(offsets):
        start, active = block.start, block.active
        reached, came = first + scores[start], []
        state = np.zeros(len(start), np.int64)
        for t, m in enumerate(active):
            if t:
                ways = reached[:m, :, None] + step
                came.append(ways.argmax(axis=1))
                reached[:m] = np.take_along_axis(ways, came[-1][:, None], axis=1)[:, 0] + scores[start[:m] + t]
            ending = active[t + 1] if t + 1 < len(active) else 0
            state[ending:m] = (reached[ending:m] + last).argmax(axis=1)
        for t in range(len(active) - 1, -1, -1):
            m = active[t]
            out[start[:m] + t] = state[:m]
            if t:
                state[:m] = came[t - 1][np.arange(m), state[:m]]
    return out


def span_ends(ids: np.ndarray, offsets: np.ndarray, tags: list[str]) -> np.ndarray:
    """For each token its span's last place if a well-formed span begins there, else -1."""
    prefix = np.array([tag[0] for tag in tags])[ids] if len(ids) else np.zeros(0, "U1")
    kinds = {kind: k for k, kind in enumerate(sorted({tag[2:] for tag in tags}))}
    kind = np.array([kinds[tag[2:]] for tag in tags])[ids] if len(ids) else np.zeros(0, np.int64)
    out = np.where(prefix == "S", np.arange(len(ids)), -1)
    opening, stops = np.flatnonzero(prefix == "B"), np.append(np.flatnonzero(prefix != "I"), len(ids))
    until = stops[np.searchsorted(stops, opening, "right")]
    changes = np.concatenate([[0], np.cumsum(kind[1:] != kind[:-1])]) if len(ids) else kind
    sequence = np.searchsorted(offsets, np.arange(len(ids)), "right")
    inside = until < len(ids)
    opening, until = opening[inside], until[inside]
    whole = (prefix[until] == "E") & (sequence[until] == sequence[opening]) & (changes[until] == changes[opening])
    out[opening[whole]] = until[whole]
    return out


def span_counts(true: np.ndarray, found: np.ndarray, offsets: np.ndarray, tags: list[str]) -> tuple[int, int, int]:
    """Well-formed spans in both sequences, in ``found`` and in ``true``; equal ones have the same places and type."""
    a, b = span_ends(true, offsets, tags), span_ends(found, offsets, tags)
    kind = np.array([tag[2:] for tag in tags])
    same = (a >= 0) & (a == b) & (kind[true] == kind[found])
    return int(same.sum()), int((b >= 0).sum()), int((a >= 0).sum())
