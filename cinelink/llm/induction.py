"""Suffix order and common prefixes of one shard by external induced sorting.

Suffixes are of type S if they are smaller than the one to their right, else of type L; an
S suffix right of an L suffix is an LMS suffix. From the order of the LMS suffixes two scans
induce the order of all others: the smallest suffix not yet scanned yields the suffix one
to its left, whose place is given by its first character and the rank of the one that
yielded it. The scans take suffix tuples from monotone priority queues, one bucket per
character (or range of characters), which move to disk when they exceed their memory. The
LMS suffixes are ordered the same way: their substrings are named, and the text of names is
sorted by recursion.

On the text itself tuples carry the prefix in common with their predecessor, up to `cap`:
what an induced suffix shares with the one before it in its bucket is one more than the
minimum over everything scanned between the suffixes that yielded them.
"""

import tempfile

import numpy as np

CAP = 511
QUEUE_BYTES = 64 << 20
RANGE_ITEMS = 1 << 15
FAR = np.int64(1 << 40)


class DiskQueues:
    """First-in first-out buckets of tuples, which go to a temporary file beyond `memory` bytes.

    Tuples arrive in the order of the suffixes that yielded them, so a bucket is sorted and
    the buckets together are a priority queue. The file vanishes with its handle.
    """

    def __init__(self, buckets, columns, memory=QUEUE_BYTES):
        self.chunks = [[] for _ in range(buckets)]
        self.columns, self.memory, self.held, self.file = columns, memory, 0, None

    def push(self, keys, *tuples):
        """Append tuples to the buckets `keys`, keeping their order."""
        order = np.argsort(keys, kind="stable")
        keys, rows = keys[order], np.stack([t[order] for t in tuples], axis=1)
        cuts = np.flatnonzero(np.diff(keys)) + 1
        for key, part in zip(keys[np.r_[0, cuts]] if len(keys) else (), np.split(rows, cuts)):
            self.chunks[key].append(part)
        self.held += rows.nbytes
        if self.held > self.memory:
            self._spill()

    def _spill(self):
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for bucket in self.chunks:
            for i, part in enumerate(bucket):
                if isinstance(part, np.ndarray):
                    bucket[i] = (self.file.tell(), len(part))
                    self.file.write(np.ascontiguousarray(part).tobytes())
        self.held = 0

    def pop(self, bucket):
        """All tuples of a bucket, in order; it is empty afterwards."""
        parts, self.chunks[bucket] = self.chunks[bucket], []
        out = []
        for part in parts:
            if isinstance(part, tuple):
                self.file.seek(part[0])
                part = np.frombuffer(self.file.read(part[1] * self.columns * 8), np.int64).reshape(-1, self.columns)
            else:
                self.held -= part.nbytes
            out.append(part)
        rows = np.concatenate(out) if out else np.empty((0, self.columns), np.int64)
        return [rows[:, i] for i in range(self.columns)]


def runs_of(text):
    """For each place, how often its character is repeated from there on."""
    n = len(text)
    ends = np.r_[np.flatnonzero(text[1:] != text[:-1]), n - 1]
    return ends[np.searchsorted(ends, np.arange(n))] - np.arange(n) + 1


def types_of(text, runs):
    """True for suffixes of type S. The last character must be unique and the smallest."""
    n = len(text)
    after = np.minimum(np.arange(n) + runs, n - 1)
    is_s = text < text[after]
    is_s[n - 1] = True
    return is_s


class Prefixes:
    """Hashes of substrings, from prefix sums of random character values."""

    BASE = 0x9E3779B97F4A7C15 | 1

    def __init__(self, text):
        values = np.random.default_rng(1).integers(1, 1 << 63, int(text.max()) + 1, dtype=np.uint64)
        n = len(text)
        with np.errstate(over="ignore"):
            self.back = self._powers(pow(self.BASE, -1, 1 << 64), n)
            self.sums = np.r_[np.uint64(0), np.cumsum(values[text] * self._powers(self.BASE, n), dtype=np.uint64)]

    @staticmethod
    def _powers(base, n):
        out = np.full(n, base, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    def of(self, start, length):
        with np.errstate(over="ignore"):
            return (self.sums[start + length] - self.sums[start]) * self.back[start]

    def common(self, a, b, cap=CAP):
        """Length of the common prefix of the suffixes a and b, `cap` (2^k - 1) at most."""
        n, length = len(self.back), np.zeros(len(a), np.int64)
        step = (cap + 1) // 2
        while step:
            longer = length + step
            fits = np.maximum(a, b) + longer <= n
            use = np.where(fits, longer, 0)
            length = np.where(fits & (self.of(a, use) == self.of(b, use)), longer, length)
            step //= 2
        return length


class _Scan:
    """What one scan has seen since each character was last induced."""

    def __init__(self, characters, cap=CAP):
        self.cap = cap
        self.since = np.full(characters, FAR)
        self.begun = np.zeros(characters, bool)

    def induced(self, shared, at, targets):
        """Common prefixes of the suffixes induced at the indices `at` of a batch into the buckets `targets`."""
        order = np.argsort(targets, kind="stable")
        i, ch = at[order], targets[order]
        first = np.r_[True, ch[1:] != ch[:-1]]
        padded = np.r_[shared, FAR]
        before = np.minimum.accumulate(padded)
        low = np.empty(len(i), np.int64)
        low[first] = np.minimum(self.since[ch[first]], before[i[first]])
        later = np.flatnonzero(~first)
        if len(later):
            pairs = np.empty(2 * len(later), np.int64)
            pairs[0::2], pairs[1::2] = i[later - 1] + 1, i[later] + 1
            low[later] = np.minimum.reduceat(padded, pairs)[0::2]
        out = np.empty(len(i), np.int64)
        out[order] = np.where(first & ~self.begun[ch], 0, np.minimum(low + 1, self.cap))
        after = np.minimum.accumulate(padded[::-1])[::-1]
        self.since = np.minimum(self.since, after[0])
        last = np.r_[ch[1:] != ch[:-1], True]
        self.since[ch[last]] = after[i[last] + 1]
        self.begun[ch[last]] = True
        return out

    def passed(self, shared):
        if len(shared):
            self.since = np.minimum(self.since, shared.min())


def induce(text, is_s, runs, lms, lms_shared=None, memory=QUEUE_BYTES, cap=CAP):
    """(order, shared) of all suffixes from the LMS suffixes in order; small alphabets.

    `shared` is None unless the common prefixes of neighbouring LMS suffixes are given.
    """
    characters = int(text.max()) + 1
    carry = lms_shared is not None
    queue, scan = DiskQueues(characters, 2, memory), _Scan(characters, cap)
    if carry:
        lms_shared = lms_shared.copy()

    def yield_left(batch, shared, left_of):
        if not len(batch):
            return
        prev = batch - 1
        at = np.flatnonzero(left_of(prev, batch))
        if not len(at):
            if carry:
                scan.passed(shared)
            return
        prev = prev[at]
        targets = text[prev]
        queue.push(targets, prev, scan.induced(shared, at, targets) if carry else np.zeros(len(at), np.int64))

    def drain(c, left_of):
        """The bucket c, with what its own suffixes add to it; runs of c take a turn each."""
        places, shares = [], []
        while True:
            batch, shared = queue.pop(c)
            if not len(batch):
                break
            places.append(batch)
            shares.append(shared)
            yield_left(batch, shared, left_of)
        none = np.empty(0, np.int64)
        return (np.concatenate(places), np.concatenate(shares)) if places else (none, none)

    def is_l_left(prev, batch):
        # prev is -1 for the suffix at 0: text[-1] is the smallest character, never of type L.
        return (prev >= 0) & ~is_s[prev] & (text[prev] >= text[batch])

    def is_s_left(prev, batch):
        return (prev >= 0) & is_s[prev] & (text[prev] <= text[batch])

    cuts = np.searchsorted(text[lms], np.arange(characters + 1))
    large = []
    for c in range(characters):
        places, shared = drain(c, is_l_left)
        large.append((places, shared))
        own = slice(cuts[c], cuts[c + 1])
        seeds = lms[own]
        if len(seeds):
            some = lms_shared[own] if carry else np.zeros(len(seeds), np.int64)
            if carry:
                some[0] = min(runs[places[-1]], runs[seeds[0]], cap) if len(places) else 0
            yield_left(seeds, some, is_l_left)

    scan = _Scan(characters, cap)
    pieces = [None] * characters
    for c in range(characters - 1, -1, -1):
        if c == text[-1]:
            places, shared = np.array([len(text) - 1]), np.array([0])
        else:
            places, shared = drain(c, is_s_left)
        low, low_shared = large[c]
        seam = min(runs[low[-1]], runs[places[-1]], cap) if len(low) and len(places) else 0
        if len(low):
            yield_left(low[::-1], np.r_[seam, low_shared[1:][::-1]], is_s_left)
        # Downwards each tuple carries what it shares with the larger one; upwards its neighbour has it.
        upwards = np.r_[seam, shared[1:][::-1]] if len(places) else places
        pieces[c] = (np.r_[low, places[::-1]], np.r_[low_shared, upwards])
    order = np.concatenate([p for p, _ in pieces])
    return order, np.concatenate([s for _, s in pieces]) if carry else None


def _sorted_range(text, left, mark, seeds, marks, roots, inside, seeds_first):
    """A range in order: the seeds, and all that they yield inside it.

    A suffix sorts by the marks (twice its character, plus its type) from it down to its seed,
    then by the rank of the seed, which comes before or after every mark. Places are
    compared by doubling, so long runs cost a logarithm of their length.
    """
    places, marks, above = [seeds], [marks], [np.full(len(seeds), -1)]
    begin = 0
    while len(places[-1]):
        prev = places[-1] - 1
        good = np.flatnonzero((prev >= 0) & left[prev] & inside(prev, places[-1]))
        places.append(prev[good])
        marks.append(2 * text[prev[good]] + mark)
        above.append(begin + good)
        begin += len(prev)
    places, marks, above = np.concatenate(places), np.concatenate(marks), np.concatenate(above)
    n = len(places)
    ends = roots - roots.min() if len(roots) else roots
    low, high = (ends, marks + len(seeds) + 1) if seeds_first else (ends + (marks.max(initial=0) + 1), marks)
    key = np.r_[high, low]
    above = np.r_[np.where(above < 0, n + np.arange(n), above), n + np.arange(len(seeds))]
    rank = np.empty(len(key), np.int64)
    while True:
        order = np.argsort(key, kind="stable")
        inner = key[order]
        rank[order] = np.r_[0, np.cumsum(inner[1:] != inner[:-1])] if len(key) else key
        order = order[order < n]
        own = rank[order]
        if not (own[1:] == own[:-1]).any():
            return places[order]
        key = rank * (len(key) + 1) + rank[above]
        above = above[above]


def induce_ranges(text, is_s, lms, memory=QUEUE_BYTES):
    """Order of all suffixes from the LMS suffixes in order; alphabets of any size.

    Buckets are ranges of characters. What a range yields inside itself is sorted with its
    seeds by the chain of characters down to the seed: a seed that came from outside ends
    its chain with a character beyond the range.
    """
    counts = np.bincount(text)
    bucket_of = (np.cumsum(counts) - counts) // RANGE_ITEMS
    bucket_of = np.unique(bucket_of, return_inverse=True)[1]
    ranges = int(bucket_of[-1]) + 1
    lows = np.searchsorted(bucket_of, np.arange(ranges + 1))
    is_l = ~is_s
    queue = DiskQueues(ranges, 1, memory)
    cuts = np.searchsorted(text[lms], lows)
    large = []
    for r in range(ranges):
        (came,), own = queue.pop(r), lms[cuts[r]:cuts[r + 1]]
        seeds = np.r_[came, own]
        marks = 2 * text[seeds] + np.r_[np.zeros(len(came), np.int64), np.ones(len(own), np.int64)]
        roots = np.r_[np.arange(len(came)), np.arange(len(own))]
        row = _sorted_range(
            text, is_l, 0, seeds, marks, roots, lambda p, q: (text[p] >= text[q]) & (text[p] < lows[r + 1]), seeds_first=True)
        large.append(row[is_l[row]])
        prev = row - 1
        prev = prev[(prev >= 0) & is_l[prev] & (text[prev] >= text[row]) & (text[prev] >= lows[r + 1])]
        queue.push(bucket_of[text[prev]], prev)
    pieces = [None] * ranges
    for r in range(ranges - 1, -1, -1):
        (came,), own = queue.pop(r), large[r]
        if r == 0:
            came = np.r_[came, len(text) - 1]
        seeds = np.r_[own, came]
        marks = 2 * text[seeds] + np.r_[np.zeros(len(own), np.int64), np.ones(len(came), np.int64)]
        roots = np.r_[np.arange(len(own)), -np.arange(len(came))]
        row = _sorted_range(
            text, is_s, 1, seeds, marks, roots, lambda p, q: (text[p] <= text[q]) & (text[p] >= lows[r]), seeds_first=False)
        pieces[r] = row
        prev = row[::-1] - 1
        after = row[::-1]
        prev = prev[(prev >= 0) & is_s[prev] & (text[prev] <= text[after]) & (text[prev] < lows[r])]
        queue.push(bucket_of[text[prev]], prev)
    return np.concatenate(pieces)


def _order_lms(text, is_s, sort_all, memory):
    """LMS suffixes in order: their substrings are sorted and named, the text of names by recursion."""
    lms = np.flatnonzero(is_s & ~np.r_[True, is_s[:-1]])
    if len(lms) == 1:
        return lms
    guess = lms[np.argsort(text[lms], kind="stable")]
    order = sort_all(guess)
    is_lms = np.zeros(len(text), bool)
    is_lms[lms] = True
    by_substring = order[is_lms[order]]
    number = np.empty(len(text), np.int64)
    number[lms] = np.arange(len(lms))
    ends = np.r_[lms[1:], lms[-1]] + 1
    length = ends[number[by_substring]] - by_substring
    value = Prefixes(text).of(by_substring, length)
    differs = np.r_[False, (value[1:] != value[:-1]) | (length[1:] != length[:-1])]
    names = np.cumsum(differs)
    if names[-1] + 1 == len(lms):
        return by_substring
    reduced = np.empty(len(lms), np.int64)
    reduced[number[by_substring]] = names
    return lms[sort_suffixes(reduced, memory)]


def sort_suffixes(text, memory=QUEUE_BYTES):
    """Order of the suffixes of a text of numbers whose last is unique and the smallest."""
    if len(text) == 1:
        return np.zeros(1, np.int64)
    is_s = types_of(text, runs_of(text))
    return induce_ranges(text, is_s, _order_lms(text, is_s, lambda seeds: induce_ranges(text, is_s, seeds, memory), memory), memory)


def suffixes_with_prefixes(text, memory=QUEUE_BYTES, cap=CAP):
    """(order, shared up to `cap`, 2^k - 1) of a text of small numbers whose last is unique and the smallest."""
    runs = runs_of(text)
    is_s = types_of(text, runs)
    lms = _order_lms(text, is_s, lambda seeds: induce(text, is_s, runs, seeds, memory=memory)[0], memory)
    shared = np.zeros(len(lms), np.int64)
    if len(lms) > 1:
        shared[1:] = Prefixes(text).common(lms[:-1], lms[1:], cap)
    return induce(text, is_s, runs, lms, shared, memory, cap)
