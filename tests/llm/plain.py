"""Plain versions of operators, written apart from them, for comparison."""

import math
import struct
from collections import Counter

END = b"\n"


def tokens(text):
    return [*(text or "").encode().lower().split(), END]


def discounts(of_counts):
    n = [0] + [of_counts.get(i, 0) for i in (1, 2, 3, 4)]
    if not all(n[1:]):
        return [0, 0.5, 0.75, 0.9]
    y = n[1] / (n[1] + 2 * n[2])
    raw = [i - (i + 1) * y * n[i + 1] / n[i] for i in (1, 2, 3)]
    return [0] + [min(max(d, 0.01), i + 0.99) for i, d in enumerate(raw)]


class KneserNey:
    """Interpolated modified Kneser-Ney of order three, with dictionaries."""

    def __init__(self, texts):
        three, self.raw = Counter(), Counter()
        for t in texts:
            w = tokens(t)
            self.raw.update(w)
            w = [END, END, *w]
            three.update(zip(w, w[1:], w[2:]))
        two = Counter((v, w) for _, v, w in three)
        one = Counter(w for _, w in two)
        self.total, self.vocabulary = sum(self.raw.values()), len(self.raw)
        self.levels = [self.level(c) for c in (one, two, three)]

    @staticmethod
    def level(counts):
        d = discounts(Counter(counts.values()))
        total, rest = Counter(), Counter()
        for gram, n in counts.items():
            context = gram[:-1] if isinstance(gram, tuple) else ()
            total[context] += n
            rest[context] += d[min(n, 3)]
        return counts, d, total, rest

    def p(self, u, v, w):
        out = 1 / (self.vocabulary + 1)
        for gram, (counts, d, total, rest) in zip((w, (v, w), (u, v, w)), self.levels):
            context = gram[:-1] if isinstance(gram, tuple) else ()
            if total.get(context):
                n = counts.get(gram, 0)
                out = (max(n - d[min(n, 3)], 0) + rest[context] * out) / total[context]
            elif context == ():
                out = 1.0 * out  # nothing was learnt
        return out

    def row(self, text):
        """(n_tokens, n_known, train_tokens, base_score, score)"""
        w = tokens(text)
        x = [END, END, *w]
        base = sum(math.log10((self.raw[t] + 1) / (self.total + self.vocabulary + 1)) for t in w)
        return len(w), sum(t in self.raw for t in w), self.total, base, sum(math.log10(self.p(*g)) for g in zip(x, x[1:], x[2:]))


def gif_frames(data):
    """(delay in ms, rows of palette indices) of the frames of a GIF without local palettes,
    read bit by bit."""
    assert data[:6] == b"GIF89a"
    flags = data[10]
    at = 13 + (3 * (2 << (flags & 7)) if flags & 0x80 else 0)
    delay, out = 0, []
    while data[at] != 0x3B:
        if data[at] == 0x21:
            if data[at + 1] == 0xF9:
                delay = 10 * struct.unpack_from("<H", data, at + 4)[0]
            at += 2
            while data[at]:
                at += 1 + data[at]
            at += 1
            continue
        wide, high = struct.unpack_from("<HH", data, at + 5)
        least = data[at + 10]
        at += 11
        stream = b""
        while data[at]:
            stream += data[at + 1 : at + 1 + data[at]]
            at += 1 + data[at]
        at += 1
        out.append((delay, wide, high, lzw(stream, least)))
    return out


def lzw(stream, least):
    bits = int.from_bytes(stream, "little")
    clear = 1 << least
    table, size, before, out = {}, least + 1, None, []
    while True:
        code = bits & ((1 << size) - 1)
        bits >>= size
        if code == clear:
            table = {i: bytes([i]) for i in range(clear)}
            free, size, before = clear + 2, least + 1, None
            continue
        if code == clear + 1:
            return b"".join(out)
        entry = table[code] if code in table else before + before[:1]
        if before is not None and free < 4096:
            table[free] = before + entry[:1]
            free += 1
            if free == 1 << size and size < 12:
                size += 1
        out.append(entry)
        before = entry


def second_pass(kinds, places, homes, headings):
    """The block rules' second pass, a search for each block."""
    kinds, n = list(kinds), len(kinds)
    for stage in ("near", "short"):
        out = list(kinds)
        for i in range(n):
            if kinds[i] != stage:
                continue
            sides = []
            for step in (-1, 1):
                j, found = i, None
                while found is None:
                    if homes[j] and not (0 <= j + step < n and homes[j + step] == homes[j]):
                        if homes[j] == homes[i]:
                            found = ("good", abs(places[j] + step - places[i]))
                            break
                    j += step
                    if not 0 <= j < n:
                        break
                    if kinds[j] in ("good", "bad"):
                        found = (kinds[j], abs(places[j] - places[i]))
                sides.append(found)
            left, right = sides
            if headings[i] and right and right[0] == "good":
                out[i] = "good"
            elif not left and not right:
                out[i] = "good" if stage == "near" else "bad"
            elif not left or not right:
                out[i] = (left or right)[0]
            else:
                out[i] = left[0] if left[1] <= right[1] else right[0]
        kinds = out
    return kinds


def rebalance(owner, sizes, n_shards):
    """Moves of single pieces from the fullest shard to the emptiest, found by search."""
    owner = dict(owner)
    while True:
        load = [0] * n_shards
        for piece, to in owner.items():
            load[to] += sizes.get(piece, 0)
        low, high = min(range(n_shards), key=lambda s: (load[s], s)), min(range(n_shards), key=lambda s: (-load[s], s))
        gap = load[high] - load[low]
        fits = [(abs(2 * sizes[p] - gap), sizes[p]) for p, to in owner.items() if to == high and 0 < sizes.get(p, 0) < gap]
        if not fits:
            return load
        best = min(fits)[1]
        owner[next(p for p, to in owner.items() if to == high and sizes.get(p, 0) == best)] = low
