"""Suffix and common-prefix arrays by induced sorting, for one block of strings.

The strings, none of them empty, are laid one after the other, each followed by a separator that is smaller than
every byte. Suffixes are S (smaller than their right neighbour) or L; an S after an L is S*.

1. S* suffixes are named by their S*-substrings (up to the next S*) and the string of names is
   sorted by doubling the compared length.
2. L suffixes are induced from left to right, then S suffixes from right to left: a sorted
   suffix i puts i - 1 into the queue of that suffix's first byte. The queues hold tuples
   (suffix, common prefix with the tuple before it); within a byte they are first in, first
   out, which is the order a priority queue would give. Tuples beyond ``memory`` go to disk.
3. The common prefix of two successive tuples of a queue is one more than the smallest common
   prefix between their sources.

Common prefixes are counted up to ``DEPTH`` bytes; more is not needed.
"""

from __future__ import annotations

import tempfile

import numpy as np

DEPTH = 100
_END = b"\xff"  # larger than every byte of UTF-8, moved up by one


class _Queues:
    """One queue of (suffix, common prefix) tuples per first byte; large ones wait on disk."""

    def __init__(self, memory: int) -> None:
        self.memory, self.held, self.parts, self.file = memory, 0, [[] for _ in range(256)], None

    def put(self, byte: int, suffixes: np.ndarray, common: np.ndarray) -> None:
        self.parts[byte].append((suffixes, common))
        self.held += len(suffixes)
        if self.held > self.memory:
            self.file = self.file or tempfile.TemporaryFile()
            for parts in self.parts:
                for k, part in enumerate(parts):
                    if isinstance(part, tuple):
                        at = self.file.seek(0, 2)
                        np.save(self.file, part[0])
                        np.save(self.file, part[1])
                        parts[k] = at
            self.held = 0

    def take(self, byte: int) -> tuple[np.ndarray, np.ndarray] | None:
        """What comes next in the queue, in order: all tuples up to the next part on disk, or that part."""
        parts = self.parts[byte]
        if not parts:
            return None
        n = next((k for k, part in enumerate(parts) if not isinstance(part, tuple)), len(parts))
        if n:
            suffixes, common = (np.concatenate(x) for x in zip(*parts[:n], strict=True))
            del parts[:n]
            self.held -= len(suffixes)
            return suffixes, common
        self.file.seek(parts.pop(0))
        return np.load(self.file), np.load(self.file)


class _Smallest:
    """Smallest value of any range of an array."""

    def __init__(self, values: np.ndarray) -> None:
        self.levels, step = [values], 1
        while 2 * step <= len(values):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Over values[start:stop]; DEPTH where that is empty."""
        size = stop - start
        out = np.full(len(size), DEPTH, np.uint8)
        level = np.frexp(np.maximum(size, 1))[1] - 1
        for k in np.unique(level):
            use = (level == k) & (size > 0)
            row = self.levels[k]
            out[use] = np.minimum(row[start[use]], row[stop[use] - (1 << int(k))])
        return out


def eights(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place as one number."""
    n = len(data) - 7
    words = np.empty(n + -n % 8, np.uint64)
    table = words.reshape(-1, 8)
    for r in range(8):
        count = (n - r + 7) // 8
        if count > 0:
            table[:count, r] = np.frombuffer(data, "<u8", count, r)
    return words[:n]


def _common(words: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Common prefix of the suffixes a and b, eight bytes at a time, up to DEPTH."""
    out = np.full(len(a), DEPTH, np.uint8)
    on = np.arange(len(a))
    for k in range(0, DEPTH, 8):
        differ = words[a[on] + k] ^ words[b[on] + k]
        ends = np.flatnonzero(differ)
        equal = k + (differ[ends].view(np.uint8).reshape(-1, 8) != 0).argmax(axis=1)
        out[on[ends]] = np.minimum(equal, DEPTH)
        on = on[differ == 0]
        if not len(on):
            break
    return out


def _sorted_stars(text: np.ndarray, stars: np.ndarray) -> np.ndarray:
    raw = text.tobytes()
    stops = np.append(stars[1:] + 1, len(text)).tolist()
    parts = [raw[a:b] + _END for a, b in zip(stars.tolist(), stops, strict=True)]
    names = {p: k for k, p in enumerate(sorted(set(parts)))}
    rank = np.fromiter(map(names.__getitem__, parts), np.int64, len(parts))
    # The last one is the end of the text, smaller than all that start alike.
    rank += 1
    rank[-1] = 0
    step, n = 1, len(rank)
    while True:
        after = np.zeros(n, np.int64)
        after[: max(0, n - step)] = rank[step:] + 1
        both = rank * (n + 2) + after
        order = np.argsort(both, kind="stable")
        new = np.empty(n, np.int64)
        new[order] = np.cumsum(np.append(0, both[order][1:] != both[order][:-1]))
        if new.max() == n - 1 or step > n:
            return stars[order]
        rank, step = new, 2 * step


def _induce(text, wanted, order, common_of, down: bool, memory: int):
    """Sorted suffixes of the ``wanted`` type by first byte, with common prefixes.

    ``order`` gives, for each byte, the seeds that follow the induced suffixes of that byte.
    With ``down`` the bytes go from large to small and all is in reverse.
    """
    queues, found = _Queues(memory), {}
    since = np.full(256, DEPTH, np.uint8)  # smallest common prefix since the last tuple of each byte
    pushed = np.zeros(256, bool)
    last = -1

    def spread(suffixes: np.ndarray, common: np.ndarray) -> None:
        before = suffixes - 1
        ok = np.flatnonzero((before >= 0) & wanted[np.maximum(before, 0)])
        if not len(ok):
            np.minimum(since, common.min(), out=since)
            return
        smallest = _Smallest(common)
        bytes_ = text[before[ok]]
        by = np.argsort(bytes_, kind="stable")
        src, to = ok[by], bytes_[by]
        first = np.append(True, to[1:] != to[:-1])
        start = np.where(first, 0, np.append(0, src[:-1] + 1))
        low = smallest.of(start, src + 1)
        low[first] = np.minimum(low[first], since[to[first]])
        low = np.where(first & ~pushed[to], 0, np.minimum(low, DEPTH - 1) + 1).astype(np.uint8)
        heads = np.flatnonzero(first)
        np.minimum(since, common.min(), out=since)
        for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(to)], strict=True):
            byte = int(to[a])
            queues.put(byte, before[src[a:b]], low[a:b])
            pushed[byte] = True
            tail = common[src[b - 1] + 1 :]
            since[byte] = tail.min() if len(tail) else DEPTH

    for byte in range(255, -1, -1) if down else range(256):
        made = []
        while (part := queues.take(byte)) is not None:
            made.append(part)
            part[1][0] = 0 if len(made) == 1 else part[1][0]
            spread(*part)
            last = part[0][-1]
        found[byte] = made
        seeds, common = order(byte)
        if len(seeds):
            common = common.copy()
            common[0] = common_of(last, seeds[0])
            spread(seeds, common)
            last = seeds[-1]
    return found


def suffix_array(strings: list[bytes], memory: int = 1 << 22) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(suffixes in order, common prefix with the one before, start of each string in the text).

    No string may be empty.
    """
    raw = b"\0".join(strings) + b"\0"
    starts = np.cumsum([0, *[len(s) + 1 for s in strings]])[:-1]
    text = np.frombuffer(raw, np.uint8) + np.uint8(1)
    text[np.append(starts[1:], len(text)) - 1] = 0
    n = len(text)
    # Type of each run of equal bytes by what follows it; the end counts as S.
    ends = np.append(np.flatnonzero(text[1:] != text[:-1]), n - 1)
    small = np.append(text[ends[:-1]] < text[ends[:-1] + 1], True)
    is_s = np.repeat(small, np.diff(np.append(-1, ends)))
    stars = np.flatnonzero(is_s & np.append(False, ~is_s[:-1]))

    # Two suffixes differ at the latest where the shorter one ends: no empty string, no two separators in a row.
    words = eights(np.append(text, np.zeros(DEPTH + 8, np.uint8)))

    def one(a: int, b: int) -> int:
        return int(_common(words, np.array([a]), np.array([b]))[0]) if a >= 0 else 0

    def by_byte(suffixes: np.ndarray, common: np.ndarray):
        heads = text[suffixes]
        cut = np.searchsorted(heads, np.arange(257))
        return lambda byte: (suffixes[cut[byte] : cut[byte + 1]], common[cut[byte] : cut[byte + 1]])

    seeds = _sorted_stars(text, stars)
    larger = _induce(text, ~is_s, by_byte(seeds, np.append(np.uint8(0), _common(words, seeds[:-1], seeds[1:]))), one, False, memory)

    def backwards(byte: int) -> tuple[np.ndarray, np.ndarray]:
        if not larger[byte]:
            return np.zeros(0, np.int64), np.zeros(0, np.uint8)
        suffixes, common = (np.concatenate(x) for x in zip(*larger[byte], strict=True))
        return suffixes[::-1], np.append(np.uint8(0), common[1:][::-1])

    smaller = _induce(text, is_s, backwards, one, True, memory)
    suffixes, common, last = [], [], n - 1
    for byte in range(256):
        for parts, back in ((larger[byte], False), (smaller[byte], True)):
            if byte == 0 and back:  # the end itself: induced by nothing, the smallest of all
                suffixes.insert(0, np.array([n - 1]))
                common.insert(0, np.zeros(1, np.uint8))
            if not parts:
                continue
            s, c = (np.concatenate(x) for x in zip(*parts, strict=True))
            if back:
                s, c = s[::-1], np.append(np.uint8(0), c[1:][::-1])
            c[0] = one(last, s[0])
            suffixes.append(s)
            common.append(c)
            last = int(s[-1])
    return np.concatenate(suffixes), np.concatenate(common), starts
