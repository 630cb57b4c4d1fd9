"""Burrows-Wheeler transforms of blocks of strings, merged by interleave refinement.

A block is a set of byte strings, each with an end of its own. Its suffixes are sorted once; the
transform is the symbol in front of each suffix in that order. Blocks are merged without looking
at a suffix again: starting from the blocks one after the other, each round deals the suffixes out
by the symbol in front of them, which puts them in the order of one more symbol. Where neighbours part in round k their common prefix is k symbols long, so after the
last round the intervals not yet parted are the repeated strings of that length.

A symbol is ``STEP`` bytes, so a string of n bytes is read as STEP sequences, one from each of its
first STEP bytes, and a round is worth STEP bytes. Which order symbols have does not matter, as long
as all blocks share it: they are named by doubling (8, 16, 32 bytes), so that equal names are equal
bytes.
"""

from __future__ import annotations

import numpy as np

STEP = 40
WORD = 8


def symbols(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbol at every byte of the strings, and the position of the suffix one symbol on.

    ``data`` holds the strings one after the other. A suffix too short for a whole symbol is an
    end: its symbol is 0 for all, and nothing follows it (-1).
    """
    n = len(data)
    left = np.repeat(starts + lengths, lengths) - np.arange(n)
    padded = np.concatenate([data, np.zeros(STEP, np.uint8)])
    word = np.zeros(n, np.uint64)
    for i in range(WORD):
        word = (word << np.uint64(8)) | padded[i:i + n]
    whole = np.flatnonzero(left >= STEP)
    names = np.zeros(n, np.int64)
    names[whole] = _named(word, whole) + 1
    follow = np.where(left > STEP, np.arange(n) + STEP, -1)
    return names, follow


def _named(word: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Numbers of the STEP-byte strings at ``whole``, from the WORD-byte ones everywhere."""
    _, eight = np.unique(word, return_inverse=True)

    def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.unique(a * (int(b.max(initial=0)) + 1) + b, return_inverse=True)[1]

    ahead = np.minimum(np.arange(len(word)) + WORD, len(word) - 1)
    sixteen = joined(eight, eight[ahead])
    pair = joined(sixteen[whole], sixteen[whole + 2 * WORD])
    return joined(pair, eight[whole + 4 * WORD])


def sort_block(names: np.ndarray, follow: np.ndarray) -> np.ndarray:
    """Order of the positions by their whole sequences, by doubling of ranks; equal ones by
    place, which keeps what follows them in the same order."""
    rank, jump = names, follow
    while True:
        after = np.where(jump >= 0, rank[jump], -1) + 1
        _, rank = np.unique(rank * (int(after.max()) + 1) + after, return_inverse=True)
        if (jump < 0).all():
            return np.argsort(rank, kind="stable")
        jump = np.where(jump >= 0, jump[jump], -1)


def transform(names: np.ndarray, follow: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each suffix in order, the symbol in front of it; -1 where a sequence starts."""
    front = np.full(len(names), -1, np.int64)
    has = np.flatnonzero(follow >= 0)
    front[follow[has]] = names[has]
    return front[order]


def merge(transforms: list[np.ndarray], tails: list[np.ndarray], depth: int
          ) -> tuple[np.ndarray, np.ndarray]:
    """Interleave of the blocks by ``depth`` symbols: (block of each suffix, number of its interval).

    ``transforms`` are the blocks' symbols in front, ``tails`` the symbols of each block's
    suffixes that nothing follows, in order. Suffixes of one interval have their first ``depth``
    symbols in common; each block's own come in the block's order.
    """
    sizes = [len(t) for t in transforms]
    total = sum(sizes)
    front = np.concatenate(transforms)
    ends = np.concatenate(tails)
    end_block = np.repeat(np.arange(len(tails), dtype=np.uint16), [len(t) for t in tails])
    interleave = np.repeat(np.arange(len(sizes), dtype=np.uint16), sizes)
    interval = np.zeros(total, np.int64)
    bits = int(total).bit_length()
    for round_ in range(depth):
        # The interleave says whose suffix is next; each block's come in its own order.
        ahead = front[own_rank(interleave)]
        dealt = np.flatnonzero(ahead >= 0)
        # A tail is before all that goes on with the same symbol, and parts from them a round
        # later, when their second symbols count.
        symbol = np.concatenate([ends, ahead[dealt]])
        behind = np.concatenate([np.full(len(ends), -1 if round_ else 0), interval[dealt]])
        source = np.concatenate([end_block, interleave[dealt]])
        # A stable sort by symbol: places go along in the low bits.
        order = np.sort((symbol << bits) | np.arange(total)) & ((1 << bits) - 1)
        interleave, symbol, behind = source[order], symbol[order], behind[order]
        parted = (symbol[1:] != symbol[:-1]) | (behind[1:] != behind[:-1])
        interval = np.concatenate([[0], np.cumsum(parted)])
    return interleave, interval


def own_rank(interleave: np.ndarray) -> np.ndarray:
    """Place among all blocks' suffixes, block after block, of each suffix of the interleave."""
    rank = np.empty(len(interleave), np.int64)
    rank[np.argsort(interleave, kind="stable")] = np.arange(len(interleave))
    return rank


def repeated_intervals(strings: list[bytes], depth_bytes: int, block: int = 1024
                       ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, offset, interval) of every suffix of at least ``depth_bytes``; suffixes of one
    interval begin with the same ``depth_bytes`` bytes. ``depth_bytes`` is a multiple of STEP."""
    depth = depth_bytes // STEP
    if depth * STEP != depth_bytes:
        raise ValueError(f"depth must be a multiple of {STEP}")
    lengths = np.array([len(s) for s in strings], np.int64)
    data = np.frombuffer(b"".join(strings), np.uint8)
    if not len(data):
        nothing = np.zeros(0, np.int64)
        return nothing, nothing, nothing
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    owner = np.repeat(np.arange(len(strings)), lengths)
    names, follow = symbols(data, starts, lengths)
    orders, transforms, tails = [], [], []
    for i in range(0, len(strings), block):
        low = int(starts[i])
        high = int(starts[i + block]) if i + block < len(strings) else len(data)
        if low == high:
            continue
        own, on = names[low:high], follow[low:high]
        on = np.where(on >= 0, on - low, -1)
        order = sort_block(own, on)
        orders.append(order + low)
        transforms.append(transform(own, on, order))
        tails.append(own[order[on[order] < 0]])
    which, interval = merge(transforms, tails, depth)
    at = np.concatenate(orders)[own_rank(which)]
    offset = at - starts[owner[at]]
    long_enough = lengths[owner[at]] - offset >= depth_bytes
    return owner[at][long_enough], offset[long_enough], interval[long_enough]
