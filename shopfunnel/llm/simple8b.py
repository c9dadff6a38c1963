"""Token shards in Simple-8b: small integers packed by selectors into 64-bit words.

The four high bits of a word select how many values its low 60 bits hold and of what width. A
selector of 0 marks an escape: the word after it is one value as it is. A shard's values are cut
into blocks that are coded independently, and the words of a block can be located from the
offsets kept beside it, so that all words of one selector are unpacked in one numpy step.
"""

from __future__ import annotations

import numpy as np

#: Values and bits of each, by selector from 1 on. Selector 0 is the escape.
LAYOUT = [(60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]
COUNTS = np.array([1, *(n for n, _ in LAYOUT)])
WIDTHS = np.array([64, *(b for _, b in LAYOUT)])
#: Values of a block.
BLOCK = 1024


def _choices(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The selector with the most values that a word beginning at each place can take.

    ``ends`` has the end of each place's block. Near a block's end a word holds fewer values than
    its selector says, the rest being zero.
    """
    n = len(values)
    places = np.arange(n)
    best = np.zeros(n, dtype=np.int8)
    undecided = np.ones(n, dtype=bool)
    for selector, (count, bits) in enumerate(LAYOUT, 1):
        wide = values >> np.uint64(bits) > 0
        if bits < 15 and np.count_nonzero(wide) > 0.98 * n and count > 8:
            continue  # hardly a run of such narrow values; a later selector takes them
        blocked = np.where(wide, places, n)
        blocked = np.minimum.accumulate(blocked[::-1])[::-1]
        fits = undecided & (np.minimum(places + count, ends) <= blocked)
        best[fits] = selector
        undecided &= ~fits
    return best


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of the values, and the first word of each block with the number of all words last."""
    values = np.asarray(values, dtype=np.uint64)
    n = len(values)
    blocks = -(-n // BLOCK)
    ends = np.minimum((np.arange(n) // BLOCK + 1) * BLOCK, n)
    choice = _choices(values, ends)
    step = np.minimum(COUNTS[choice], ends - np.arange(n))
    # all blocks go forward together, a word each at a time
    at, stop = np.arange(blocks) * BLOCK, np.minimum((np.arange(blocks) + 1) * BLOCK, n)
    begins = []
    while len(at):
        begins.append(at)
        at = at + step[at]
        going = at < stop
        at, stop = at[going], stop[going]
    starts = np.sort(np.concatenate(begins)) if begins else np.empty(0, np.int64)
    kinds = choice[starts]
    size = 1 + (kinds == 0)
    place = np.concatenate([[0], np.cumsum(size)])
    words = np.zeros(place[-1], dtype=np.uint64)
    for selector in np.unique(kinds):
        chosen = np.flatnonzero(kinds == selector)
        first = starts[chosen]
        if selector == 0:
            words[place[chosen] + 1] = values[first]
            continue
        count, bits = LAYOUT[selector - 1]
        packed = np.full(len(chosen), np.uint64(int(selector) << 60))
        for k in range(count):
            inside = first + k < ends[first]
            packed[inside] |= values[first[inside] + k] << np.uint64(bits * k)
        words[place[chosen]] = packed
    offsets = place[np.searchsorted(starts, np.arange(blocks) * BLOCK)]
    return words, np.append(offsets, len(words)).astype(np.int64)


def decode(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values that :func:`encode` made the words of."""
    words = np.asarray(words, dtype=np.uint64)
    if not n:
        return np.empty(0, np.uint64)
    kinds = (words >> np.uint64(60)).astype(np.int64)
    raw = _after_escapes(words, kinds)
    heads = np.flatnonzero(~raw)
    counts = COUNTS[kinds[heads]]
    # a block's last word may hold fewer values than its selector says
    block_first = np.searchsorted(heads, offsets[:-1])
    before = np.cumsum(counts) - counts
    sizes = np.full(len(block_first), BLOCK)
    sizes[-1] = n - BLOCK * (len(sizes) - 1)
    block = np.repeat(np.arange(len(block_first)), np.diff(np.append(block_first, len(heads))))
    within = before - before[block_first][block]
    counts = np.minimum(counts, sizes[block] - within)
    place = BLOCK * block + within
    out = np.empty(n, dtype=np.uint64)
    for selector in np.unique(kinds[heads]):
        chosen = kinds[heads] == selector
        to, word, count = place[chosen], words[heads[chosen]], counts[chosen]
        if selector == 0:
            out[to] = words[heads[chosen] + 1]
            continue
        most, bits = LAYOUT[selector - 1]
        mask = np.uint64((1 << bits) - 1)
        for k in range(most):
            inside = k < count
            out[to[inside] + k] = word[inside] >> np.uint64(bits * k) & mask
    return out


def _after_escapes(words: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Which words are raw values. An escape is all zero, which only a raw value can be too."""
    raw = np.zeros(len(words), dtype=bool)
    for k in np.flatnonzero(kinds == 0):
        if not raw[k] and k + 1 < len(words):
            raw[k + 1] = True
    return raw
