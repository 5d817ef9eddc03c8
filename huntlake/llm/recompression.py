"""Recompression of word sequences: rounds that name runs and pairs of symbols.

A text is a sequence of symbols, at first its words, each named by a 64-bit
hash. A round first names maximal runs of one symbol by (symbol, length), then
names pairs: a hash of a symbol's name and the round puts it on the left or
the right side, and each left symbol followed by a right one becomes one
symbol. A name is a hash of what it stands for, so all tasks give equal parts
equal names without exchanging a dictionary; names only nominate, and repeats
are verified on the words.

Every symbol carries its *context*: the words that settle that it exists. Any
other occurrence of those words holds the same symbol at the same place. So
the highest symbol whose context lies inside a window of words is a function
of that window alone: its anchor. Equal windows have equal anchors, and
neighbouring windows mostly share one.

The arrays here cover a block of documents laid end to end; nothing is named
across the border of two documents.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import xxhash

ROUNDS = 3
#: Bytes of texts that are named together.
NAMED_BYTES = 1 << 16
#: Longer words are hashed one by one.
LONG_WORD = 256
#: The bytes that ``bytes.split`` splits at, and masks of the first 0 to 8 bytes of eight.
GAPS = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: Powers that are kept for the next block, at most.
KEPT_POWERS = 1 << 16
#: Odd multipliers and seeds of the hashes.
STEP_A = 0x9E3779B97F4A7C15
STEP_B = 0xC2B2AE3D27D4EB4F
MIX_A = np.uint64(0xBF58476D1CE4E5B9)
MIX_B = np.uint64(0x94D049BB133111EB)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    values = (values ^ (values >> np.uint64(30))) * MIX_A
    values = (values ^ (values >> np.uint64(27))) * MIX_B
    return values ^ (values >> np.uint64(31))


def paired(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The name of a pair of names; the order counts."""
    return mix(left * np.uint64(STEP_A) + mix(right + np.uint64(STEP_B)))


def word_names(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The words of a text, as ``bytes.split`` has them: a 64-bit hash and the first byte of each.

    A word is read eight bytes at a time, each scrambled together with what came
    before; words of one length up to eight have different names.
    """
    gap = GAPS.take(np.frombuffer(text + b" ", np.uint8))
    edges = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    if not gap[0]:
        edges = np.concatenate([[0], edges])
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    eights = np.frombuffer(text + bytes(16 - len(text) % 8), "<u8")
    names = mix(sizes.astype(np.uint64) * np.uint64(STEP_A))
    at, left, which = starts, sizes, slice(None)
    for _ in range(LONG_WORD // 8):
        shift = (at & 7).astype(np.uint64) << np.uint64(3)
        low, high = eights.take(at >> 3) >> shift, eights.take((at >> 3) + 1) << np.uint64(1) << (np.uint64(63) - shift)
        names[which] = mix(names[which] ^ ((low | high) & FIRST_BYTES.take(np.minimum(left, 8))))
        more = np.flatnonzero(left > 8)
        if not len(more):
            break
        at, left = at.take(more) + 8, left.take(more) - 8
        which = more if isinstance(which, slice) else which.take(more)
    for i in np.flatnonzero(sizes > LONG_WORD).tolist():
        names[i] = xxhash.xxh64_intdigest(text[starts[i] : starts[i] + sizes[i]])
    return names, starts


def names_by_text(texts: Iterable[bytes]) -> Iterator[np.ndarray]:
    """The names of the words of each text; short texts are named together."""

    def named() -> Iterator[np.ndarray]:
        names, starts = word_names(b" ".join(held))
        bounds = np.searchsorted(starts, np.cumsum([0] + [len(text) + 1 for text in held])).tolist()
        yield from (names[a:b] for a, b in zip(bounds, bounds[1:]))

    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= NAMED_BYTES:
            yield from named()
            held, size = [], 0
    if held:
        yield from named()


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers ``starts[i] .. starts[i] + sizes[i] - 1`` for each i, end to end."""
    offsets = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(starts - offsets, sizes)


@lru_cache(maxsize=8)
def _powers(step: int, size: int) -> np.ndarray:
    """``step ** 0 .. step ** (size - 1)``, modulo ``1 << 64``."""
    powers = np.full(size, step, np.uint64)
    powers[0] = 1
    return np.cumprod(powers, dtype=np.uint64)


def powers(step: int, size: int) -> np.ndarray:
    """The same for sizes that vary from block to block: a part of a kept array, or a new one if it is long."""
    most = 1 << max(size - 1, 0).bit_length()
    return (_powers if most <= KEPT_POWERS else _powers.__wrapped__)(step, most)[:size]


class Spans:
    """Hashes of any span of the words of a block, by prefix sums of ``name * step ** place``."""

    def __init__(self, names: np.ndarray, step: int):
        n = len(names)
        self.back = powers(pow(step, -1, 1 << 64), n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(names) * powers(step, n), dtype=np.uint64, out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums.take(ends) - self.sums.take(starts)) * self.back.take(starts))


@dataclass
class Symbols:
    """Symbols of one level in text order: names, words covered, context."""

    name: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # context: from this word
    last: np.ndarray  # up to before this one

    def __len__(self) -> int:
        return len(self.name)

    def take(self, where: np.ndarray) -> Symbols:
        """Those at the places ``where``, or where it is true."""
        at = np.flatnonzero(where) if where.dtype == bool else where
        return Symbols(*(part.take(at) for part in (self.name, self.start, self.end, self.first, self.last)))


def name_runs(s: Symbols, words: np.ndarray, opens: np.ndarray, shuts: np.ndarray) -> Symbols:
    """Put one symbol in place of each maximal run of equal symbols.

    ``opens`` and ``shuts`` are the first word and the end of the document of
    each word. That a run ends is settled by the next word, if it differs from
    the word that a further copy would bring there, and else by the context of
    the neighbour. A run at the border of its document is settled by no words;
    its context then reaches outside.
    """
    n = len(s)
    joined = np.zeros(n, bool)
    again = np.flatnonzero(s.name[1:] == s.name[:-1]) + 1  # few
    joined[again] = opens[s.start[again]] == opens[s.start[again - 1]]
    heads = np.flatnonzero(~joined)
    tails = np.append(heads[1:], n) - 1
    length = tails - heads + 1
    name, start, end = s.name.take(heads), s.start.take(heads), s.end.take(tails)
    long = np.flatnonzero(length > 1)
    name[long] = paired(name[long], length[long].astype(np.uint64))

    # a neighbour settles a border of a run only where a word does not
    reach = np.maximum(start - 1, 0)
    same = np.flatnonzero(words.take(reach) == words.take(s.end.take(heads) - 1))
    reach[same] = s.first[np.maximum(heads[same] - 1, 0)]
    borders = opens.take(start)
    at_open = np.flatnonzero(start == borders)
    reach[at_open] = borders[at_open] - 1
    first = np.minimum(s.first.take(heads), reach)
    reach = np.minimum(end, len(words) - 1)
    same = np.flatnonzero(words.take(reach) == words.take(s.start.take(tails)))
    reach += 1
    reach[same] = s.last[np.minimum(tails[same] + 1, n - 1)]
    borders = shuts.take(start)
    at_shut = np.flatnonzero(end == borders)
    reach[at_shut] = borders[at_shut] + 1
    return Symbols(name, start, end, first, np.maximum(s.last.take(tails), reach))


def name_pairs(s: Symbols, opens: np.ndarray, shuts: np.ndarray, turn: int) -> Symbols:
    """Put one symbol in place of each left symbol that a right one follows.

    A symbol left alone is settled by its neighbour too: a left one by the
    next, a right one by the previous.
    """
    n = len(s)
    right = (mix(s.name + np.uint64(turn * STEP_B % (1 << 64))) & np.uint64(1)).astype(bool)
    borders, same = opens.take(s.start), np.zeros(n, bool)
    same[:-1] = borders[1:] == borders[:-1]
    opened = same & ~right
    opened[:-1] &= right[1:]
    closed = np.zeros(n, bool)
    closed[1:] = opened[:-1]

    first, last = s.first.copy(), s.last.copy()
    alone_left = np.flatnonzero(~right & ~opened)
    following = np.minimum(alone_left + 1, n - 1)
    last[alone_left] = np.where(same[alone_left], np.maximum(last[alone_left], s.last[following]), shuts[s.start[alone_left]] + 1)
    alone_right = np.flatnonzero(right & ~closed)
    previous = np.maximum(alone_right - 1, 0)
    inside = s.start[alone_right] != opens[s.start[alone_right]]
    first[alone_right] = np.where(inside, np.minimum(first[alone_right], s.first[previous]), opens[s.start[alone_right]] - 1)

    heads = np.flatnonzero(opened)
    name, end = s.name.copy(), s.end.copy()
    name[heads] = paired(s.name.take(heads), s.name.take(heads + 1))
    end[heads] = s.end.take(heads + 1)
    first[heads] = np.minimum(first.take(heads), first.take(heads + 1))
    last[heads] = np.maximum(last.take(heads), last.take(heads + 1))
    return Symbols(name, s.start, end, first, last).take(~closed)


@dataclass
class Block:
    """The words of some documents end to end, and the anchors of their windows."""

    names: np.ndarray
    bounds: np.ndarray  # of the documents, in words

    def windows(self, width: int) -> np.ndarray:
        """The first words of all windows of ``width`` words inside one document."""
        opens, shuts = self.borders()
        at = np.arange(len(self.names))
        return at[at + width <= shuts]

    def borders(self) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.diff(self.bounds)
        return np.repeat(self.bounds[:-1], sizes), np.repeat(self.bounds[1:], sizes)

    def anchors(self, width: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
        """For each window: its first word, and the key of its anchor.

        The key hashes the anchor's name, its words of context and its place
        in them. A word is its own context, so each window has an anchor.
        """
        names, n = self.names, len(self.names)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        opens, shuts = self.borders()
        places = np.arange(n)
        levels = [Symbols(names, places, places + 1, places, places + 1)]
        for turn in range(rounds):
            levels.append(name_pairs(name_runs(levels[-1], names, opens, shuts), opens, shuts, turn))
        spans = Spans(names, STEP_A)
        key = np.zeros(n, np.uint64)
        open_windows = places + width <= shuts
        starts = np.flatnonzero(open_windows)
        for s in reversed(levels):
            # windows from low to high hold the whole context; keep symbols that an unsettled window can use
            opened = opens.take(s.start)
            inside = np.flatnonzero((s.first >= opened) & (s.last <= shuts.take(s.start)) & (s.last - s.first <= width))
            low = np.maximum(s.last.take(inside) - width, opened.take(inside))
            unsettled = np.concatenate([[0], np.cumsum(open_windows)])
            keep = np.flatnonzero(unsettled.take(s.first.take(inside) + 1) > unsettled.take(low))
            s, low = s.take(inside.take(keep)), low.take(keep)
            if not len(s):
                continue
            # all windows a symbol can serve, symbols by rank, so that the highest is the last to be set
            order = np.argsort(mix(s.name), kind="stable")
            width_of = (s.first - low + 1).take(order)
            chosen = np.full(n, -1, np.int64)
            chosen[ranges(low.take(order), width_of)] = np.repeat(order, width_of)
            settled = np.flatnonzero(open_windows & (chosen >= 0))
            pick = chosen[settled]
            body = spans.of(s.first[pick], s.last[pick])
            key[settled] = paired(paired(s.name[pick], body), (s.start[pick] - s.first[pick]).astype(np.uint64))
            open_windows[settled] = False
            if not open_windows.any():
                break
        return starts, key[starts]


def block_of_names(texts: list[np.ndarray]) -> Block:
    """The block of documents given as the names of their words."""
    bounds = np.concatenate([[0], np.cumsum([len(names) for names in texts])]).astype(np.int64)
    return Block(np.concatenate([np.zeros(0, np.uint64), *texts]), bounds)


def block_of(texts: list[list[bytes]]) -> Block:
    """The block of documents given as lists of words."""
    return block_of_names(list(names_by_text(b" ".join(words) for words in texts)))
