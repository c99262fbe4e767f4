"""N-gram Jaccard join with signature trees.

1. A sketch of fixed size counts shingles over all documents.  Shingles far above its noise
   are common (boilerplate, passages); dropping them from two sets never adds to their
   difference.
2. Linked sets differ in at most d shingles (d follows from their sizes), so if each set is
   dealt by hash into d + 1 + e parts, at least 1 + e parts agree.  Documents become rows
   of part hashes, within windows of comparable sizes.  Parts hold uncommon shingles; a
   document with more than e empty parts also hashes parts of its whole set.  No linked
   pair is missed.
3. Documents that share a part hash form families (connected components).  A task links a
   document at once to one it has met with the same part hash and passes that hash on only
   once, so a hash that many documents share costs a few rows a task.  Unrelated documents
   share a part by chance, the more of them the larger the table, so an edge must also pass a
   test of parity sketches, which never fails for linked sets (``distance``); without it most
   documents of a large table become one family.  Only families meet in cells, each set travelling once.  A family beyond a cell's bound is split into cells
   that all hold the same few members; what the cells leave apart from the family's largest
   component is then joined with every member of another component.
4. In a cell, a signature tree holds OR-combined shingle bitmaps and size ranges.  A dual
   traversal drops node pairs whose largest possible overlap is too small, whose sizes do
   not fit, or which are already one component; at the leaves the exact overlap decides.

Equal sets are collapsed first, by a 64-bit fingerprint, so copies are never paired.

The screen that lets families' documents through has SCREEN_BITS for each of them within
fixed limits; if it fills, more sets are shuffled and the results stay the same.

Edge cases: a null or wordless text has no shingles and links with nothing, a text of fewer
words than a shingle is one shingle, repeated rows share a component, an empty table gives
an empty result, and extra columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tessera.llm import common
from tessera.llm.hashing import gram_hashes, mixed, word_hashes

#: log2 of the counters of the sketch, and the blocks it is merged in.
SKETCH_BITS = 22
SKETCH_BLOCKS = 64
#: Bits of the screen for each document of a family, and the limits of its log2.
SCREEN_BITS = 16
SCREEN_LEAST, SCREEN_MOST = 20, 27
#: log2 of the places in which a task remembers part hashes.
MET_BITS = 19
#: Rows that a task passes on for one part hash before it takes all others for its relatives, and
#: the largest group of rows of which every pair is tested (smaller, so such a hash is not).
PASSED, TESTED = 8, 7
#: A document whose sketch differs in no more than this share of the largest difference of linked
#: sets stands behind the one it met.
BEHIND = 4
#: log2 of the bits of a parity sketch.
SKETCHED = range(6, 15)
#: Part hashes are written and dealt in so many turns, each a share of them, and their files go
#: after each: they are several times the input together.
TURNS = 3
#: Documents and shingles of a cell, and of each side of a cell across chunks.
CELL_DOCS, CELL_SHINGLES = 250, 500_000
SIDE_DOCS, SIDE_SHINGLES = 1000, 1_000_000
FANOUT = 8


def shingle_sets(raws: list[bytes], k: int) -> list[np.ndarray]:
    """Distinct shingle hashes of each text in ascending order."""
    out = []
    for h in word_hashes(raws):
        if len(h) < k:
            out.append(mixed(gram_hashes(h, len(h)) + np.uint64(len(h))) if len(h) else h)
        else:
            s = np.sort(gram_hashes(h, k))
            out.append(s[np.r_[True, s[1:] != s[:-1]]])
    return out


def set_print(s: np.ndarray) -> int:
    """Fingerprint of a set as a signed 64-bit number."""
    both = np.array([mixed(s).sum(dtype=np.uint64) + np.uint64(len(s))], dtype=np.uint64)
    return int(mixed(both).astype(np.int64)[0])


def parity(s: np.ndarray) -> bytes:
    """Bit i is the parity of the members that hash to i; two to four bits a member."""
    bits = 1 << min(max((2 * len(s) - 1).bit_length(), SKETCHED[0]), SKETCHED[-1])
    at = (mixed(s ^ np.uint64(0xA0761D6478BD642F)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def distance(a: bytes, b: bytes) -> int:
    """Differing bits of two sketches, the longer one folded: at most the number of members that
    are in one set alone, and a metric among sketches of one length."""
    if len(a) > len(b):
        a, b = b, a
    x, bits = int.from_bytes(b, "little"), 8 * len(b)
    while bits > 8 * len(a):
        bits //= 2
        x = (x >> bits) ^ (x & ((1 << bits) - 1))
    return (x ^ int.from_bytes(a, "little")).bit_count()


def behind(percent: int, n: int, a: bytes, m: int, b: bytes) -> bool:
    """May a document stand behind one that it met?  Only if it is that near."""
    return len(a) == len(b) and percent * max(n, m) <= 100 * min(n, m) and BEHIND * (100 + percent) * distance(a, b) <= (100 - percent) * (n + m)


def related(percent: int, n: int, a: bytes, m: int, b: bytes) -> bool:
    """False only if neither the sets nor any that stand behind them are linked: sets behind are
    at most 100 / percent as large, linked ones differ in (100 - percent) / (100 + percent) of
    both sizes, and the way from a to b leads over two that stand behind."""
    # (n + m) * q * (r + (1 + r) / BEHIND), q = (100 - percent) / (100 + percent), r = 100 / percent
    return distance(a, b) * BEHIND * percent * (100 + percent) <= (n + m) * (100 - percent) * (100 * BEHIND + percent + 100)


class SizeWindows:
    """Bands of sizes such that linked sets lie in one band or in neighbours, and windows
    of ``span + 1`` bands that overlap in one, so a linked pair shares a window."""

    def __init__(self, percent: int):
        self.percent = percent
        self.span = 3 if percent >= 85 else 1
        self.starts = [1]

    def windows(self, n: int):
        """(window, parts, spare parts) of a set of n shingles."""
        while self.starts[-1] <= n * 3 or len(self.starts) < 2 * self.span + 4:
            b = self.starts[-1]
            self.starts.append(max(b + 1, b * 100 // self.percent + 1))
        import bisect

        band = bisect.bisect_right(self.starts, n) - 1
        for w in {band // self.span} | ({band // self.span - 1} if band % self.span == 0 and band else set()):
            while len(self.starts) <= (w + 1) * self.span + 1:
                b = self.starts[-1]
                self.starts.append(max(b + 1, b * 100 // self.percent + 1))
            largest = self.starts[(w + 1) * self.span + 1] - 1
            d = 2 * largest * (100 - self.percent) // (100 + self.percent)
            # Parts left empty by chance must stay within the spare ones: wide windows at low
            # thresholds leave more of them.
            spare = 2 + d // (16 if self.percent >= 85 else 5) if d >= 4 else 0
            yield w, d + 1 + spare, spare


def part_keys(s: np.ndarray, parts: int, salt: int) -> tuple[np.ndarray, int]:
    """Hashes of the non-empty parts of a set, and the number of empty parts."""
    if not len(s):
        return np.zeros(0, dtype=np.uint64), parts
    part = ((mixed(s ^ np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    order = np.argsort(part, kind="stable")
    part = part[order]
    first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    sums = np.add.reduceat(mixed(s[order]), first)
    return mixed(sums + part[first] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt)), parts - len(first)


def sketch_rows(k: int):
    """Each task's shingle counts, saturating at 255, in blocks."""

    def run(batches):
        counts = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
        for batch in batches:
            sets = shingle_sets(common.binary_texts(batch), k)
            if sets:
                slots = (np.concatenate(sets) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)
                counts += np.bincount(slots, minlength=len(counts)).astype(np.uint32)
        if counts.any():
            small = np.minimum(counts, 255).astype(np.uint8).reshape(SKETCH_BLOCKS, -1)
            yield pa.RecordBatch.from_arrays([pa.array(range(SKETCH_BLOCKS), pa.int32()), pa.array([b.tobytes() for b in small], pa.binary())], names=["block", "counts"])

    return common.released(run)


def merge_counts(kind):
    def run(key, table):
        total = np.zeros((1 << SKETCH_BITS) // SKETCH_BLOCKS, dtype=np.uint32)
        for chunk in table.column("counts").chunks:
            for raw in chunk:
                total += np.frombuffer(raw.as_buffer(), kind)
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})

    return run


def common_shingles(docs: DataFrame, k: int) -> bytes:
    """Bits of the sketch's counters that stand far above its noise."""
    spread = docs.select("text").mapInArrow(sketch_rows(k), "block int, counts binary")
    # Blocks are merged in two steps, so no task takes the counts of all others.
    parts = max(16, math.isqrt(docs.rdd.getNumPartitions()))
    merged = spread.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(parts))).groupBy("block", "part").applyInArrow(merge_counts(np.uint8), "block int, counts binary").groupBy("block").applyInArrow(merge_counts(np.uint32), "block int, counts binary")
    counts = np.zeros((SKETCH_BLOCKS, (1 << SKETCH_BITS) // SKETCH_BLOCKS), dtype=np.uint32)
    for r in merged.collect():  # SKETCH_BLOCKS rows
        counts[r.block] = np.frombuffer(r.counts, np.uint32)
    flat = counts.ravel()
    mean = float(flat.mean())
    return np.packbits(flat > 24 + 3 * mean, bitorder="little").tobytes()


class Met:
    """Part hashes that a task has met, each with the print of a set that has it.  A place
    holds the last hash that fell there; a forgotten hash is passed on once more."""

    def __init__(self, percent: int):
        self.percent = percent
        self.keys = np.zeros(1 << MET_BITS, np.uint64)
        self.prints = np.zeros(1 << MET_BITS, np.int64)
        self.passed = np.zeros(1 << MET_BITS, np.uint8)
        self.sketches: dict[int, tuple[int, bytes]] = {}

    def learn(self, prints: list, sizes: list[int], sketches: list) -> None:
        if len(self.sketches) > 100_000:
            self.sketches.clear()
        self.sketches.update((p, (n, x)) for p, n, x in zip(prints, sizes, sketches) if n)

    def behind(self, own: int, held: int) -> bool:
        a, b = self.sketches.get(own), self.sketches.get(held)
        return own == held or bool(a and b) and behind(self.percent, *a, *b)

    def sort_out(self, keys: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of a batch's hashes are passed on, for the others the print met before).
        Passed on are those not met before, and up to PASSED those of sets that are not near the
        one that was met."""
        _, first, back = np.unique(keys, return_index=True, return_inverse=True)
        held = prints[first]
        own = keys[first]
        at = (own >> np.uint64(64 - MET_BITS)).astype(np.int64)
        known = self.keys[at] == own
        held[known] = self.prints[at[known]]
        self.keys[at], self.prints[at] = own, held
        passed = np.where(known, self.passed[at], 1).astype(np.int64)
        new = np.zeros(len(keys), bool)
        new[first[~known]] = True
        met, of = np.unique(np.stack([prints, held[back]], axis=1), axis=0, return_inverse=True)
        far = np.array([not self.behind(int(x), int(y)) for x, y in met], bool)[of.ravel()] & ~new
        some = np.flatnonzero(far)
        some = some[np.argsort(back[some], kind="stable")]
        group = back[some]
        place = np.arange(len(some)) - np.searchsorted(group, group)
        more = some[passed[group] + place < PASSED]
        new[more] = True
        np.add.at(passed, back[more], 1)
        self.passed[at] = passed
        return new, held[back]


def listed(values: np.ndarray, owners: np.ndarray, n: int) -> pa.ListArray:
    """Lists of the values of owners 0 to n - 1; owners ascend."""
    starts = np.searchsorted(owners, np.arange(n + 1))
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values, pa.int64()))


def key_rows(k: int, percent: int, common_bits, id_name: str, turn: int = 0, turns: int = 1):
    """Documents as (id, n_shingles, print, sketch, keys, met): keys only where a task first
    meets the set and passes on the hash; met: prints of sets that share a hash met before.  Of
    the hashes, those that fall to ``turn``."""

    def run(batches):
        sizes, seen, met = SizeWindows(percent), set(), Met(percent)
        bits = np.frombuffer(common_bits.value, np.uint8)
        for batch in batches:
            n, prints, sketches, keys = [], [], [], []
            for s in shingle_sets(common.binary_texts(batch), k):
                n.append(len(s))
                prints.append(set_print(s) if len(s) else None)
                sketches.append(parity(s) if len(s) else None)
                found = []
                if len(s) and prints[-1] not in seen:
                    if len(seen) > 1_000_000:
                        seen.clear()
                    seen.add(prints[-1])
                    slot = (s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)
                    rare = s[(bits[slot >> 3] >> (slot & 7) & 1) == 0]
                    for w, parts, spare in sizes.windows(len(s)):
                        some, empty = part_keys(rare, parts, 2 * w)
                        found.append(some)
                        if empty > spare:
                            found.append(part_keys(s, parts, 2 * w + 1)[0])
                            if parts - len(found[-1]) > spare:
                                full_part = np.unique(((mixed(s ^ np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32))
                                none = np.setdiff1d(np.arange(parts, dtype=np.uint64), full_part)
                                found.append(mixed(mixed(none + np.uint64(1)) ^ np.uint64(2 * w + 1)))
                own = np.concatenate(found) if found else np.zeros(0, np.uint64)
                keys.append(own[own % np.uint64(turns) == turn].astype(np.int64))
            if not keys:
                continue
            owners = np.repeat(np.arange(len(keys)), [len(x) for x in keys])
            flat, own = np.concatenate(keys).view(np.uint64), np.array([p or 0 for p in prints], np.int64)[owners]
            met.learn(prints, n, sketches)
            new, held = met.sort_out(flat, own)
            links = np.unique(np.stack([owners, held], axis=1)[~new & (held != own)], axis=0)
            yield pa.RecordBatch.from_arrays(
                [*common.keep(batch, id_name), pa.array(n, pa.int64()), pa.array(prints, pa.int64()), pa.array(sketches, pa.binary()), listed(flat[new].view(np.int64), owners[new], len(keys)), listed(links[:, 1], links[:, 0], len(keys))],
                names=[id_name, "n_shingles", "print", "sketch", "keys", "met"],
            )

    return common.released(run)


def set_rows(k: int, screen, screen_bits: int):
    """(print, shingles) of the documents that the screen lets through."""

    def run(batches):
        bits, seen = np.frombuffer(screen.value, np.uint8), set()
        for batch in batches:
            prints, sets = [], []
            for s in shingle_sets(common.binary_texts(batch), k):
                if not len(s):
                    continue
                p = set_print(s)
                slot = (p >> (64 - screen_bits)) & ((1 << screen_bits) - 1)
                if p in seen or not bits[slot >> 3] >> (slot & 7) & 1:
                    continue
                if len(seen) > 1_000_000:
                    seen.clear()
                seen.add(p)
                prints.append(p)
                sets.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(prints, pa.int64()), pa.array(sets, pa.binary())], names=["print", "shingles"])

    return common.released(run)


class SignatureTree:
    """Sets under a tree of nodes; a node is (bits, least size, most size, most slack,
    children, leaf), slack being a set's size beyond its bitmap's ones."""

    def __init__(self, sets: list[np.ndarray], chosen: list[int], width: int):
        shift = np.uint64(64 - int(width).bit_length() + 1)
        order = sorted(chosen, key=lambda i: (int(sets[i][0]), len(sets[i])))
        level = []
        for i in order:
            row = np.zeros(width, dtype=np.uint8)
            row[(mixed(sets[i]) >> shift).astype(np.int64)] = 1
            bits = int.from_bytes(np.packbits(row).tobytes(), "big")
            n = len(sets[i])
            level.append((bits, n, n, n - bits.bit_count(), (), i))
        while len(level) > 1:
            level = [self._join(level[i : i + FANOUT]) for i in range(0, len(level), FANOUT)]
        self.root = level[0] if level else None

    @staticmethod
    def _join(children):
        bits = 0
        for c in children:
            bits |= c[0]
        return (bits, min(c[1] for c in children), max(c[2] for c in children), max(c[3] for c in children), tuple(children), -1)


class Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def tree_links(sets: list[np.ndarray], percent: int, union: Union, left: list[int], right: list[int] | None = None) -> list[tuple[int, int]]:
    """Join sets under signature trees; links between different components only, since a
    link within one adds nothing.  ``right`` None: a self join of ``left``."""
    if not left or right is not None and not right:
        return []
    largest = max(len(sets[i]) for i in (left + (right or [])))
    width = 1 << max(8, min(13, (2 * largest).bit_length()))
    tree = SignatureTree(sets, left, width)
    other = tree if right is None else SignatureTree(sets, right, width)
    one: dict[int, int] = {}

    def component(node) -> int:
        """The node's component if all its sets are in one, else -1."""
        if node[5] >= 0:
            return union.find(node[5])
        known = one.get(id(node))
        if known is not None:
            return union.find(known)
        first = component(node[4][0])
        if first < 0:
            return -1
        for c in node[4][1:]:
            if component(c) != first:
                return -1
        one[id(node)] = first
        return first

    links = []
    stack = [(tree.root, other.root)]
    while stack:
        x, y = stack.pop()
        if 100 * x[2] < percent * y[1] or 100 * y[2] < percent * x[1]:
            continue
        if x is not y:
            need = -(-percent * (x[1] + y[1]) // (100 + percent))
            if min(x[2], y[2], (x[0] & y[0]).bit_count() + min(x[3], y[3])) < need:
                continue
        c = component(x)
        if c >= 0 and c == component(y):
            continue
        if x is y:
            children = x[4]
            stack += [(a, b) for i, a in enumerate(children) for b in children[i + 1 :]]
            stack += [(a, a) for a in children]
        elif x[5] >= 0 and y[5] >= 0:
            a, b = sets[x[5]], sets[y[5]]
            if x[5] != y[5]:
                both = overlap(a, b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    union.join(x[5], y[5])
                    links.append((x[5], y[5]))
        elif y[5] >= 0 or x[5] < 0 and len(x[4]) >= len(y[4]):
            stack += [(a, y) for a in x[4]]
        else:
            stack += [(x, b) for b in y[4]]
    return links


def join_cell(percent: int):
    """Links of one cell.  Rows: print, label, side (0: both sides, 1: left, 2: right), shingles."""

    def run(table):
        prints = table.column("print").to_pylist()
        labels = table.column("label").to_pylist()
        sides = table.column("side").to_pylist()
        sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
        order = sorted(range(len(prints)), key=lambda i: (prints[i], sides[i]))
        union, first = Union(len(prints)), {}
        for i in order:
            union.join(first.setdefault(("label", labels[i]), i), i)
            union.join(first.setdefault(("print", prints[i]), i), i)
        if any(sides):
            links = tree_links(sets, percent, union, [i for i in order if sides[i] == 1], [i for i in order if sides[i] == 2])
        else:
            links = tree_links(sets, percent, union, order)
        return pa.table({"a": pa.array([prints[i] for i, _ in links], pa.int64()), "b": pa.array([prints[j] for _, j in links], pa.int64())})

    return run


def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 80, id_name: str = "doc_id") -> DataFrame:
    """Rows (id, n_shingles, component_id): documents link when
    100 * overlap >= percent * union of their sets of k-word shingles; the component's id is
    the smallest id in it."""
    spark = common.prepare(docs.sparkSession)
    sc = spark.sparkContext
    kind = docs.schema[id_name].dataType.simpleString()
    bits = sc.broadcast(common_shingles(docs, k))  # 2 ** SKETCH_BITS bits
    common.free_shuffles(spark)
    signed, shared = None, []
    for turn in range(TURNS):
        full = docs.select(id_name, "text").mapInArrow(key_rows(k, percent, bits, id_name, turn, TURNS), f"{id_name} {kind}, n_shingles long, print long, sketch binary, keys array<long>, met array<long>")
        full = full if signed is None else full.drop(id_name).filter("size(keys) + size(met) > 0")
        full = common.store(full.withColumn("_row", F.monotonically_increasing_id()), "keys")
        signed = signed or common.store(full.select(id_name, "n_shingles", "print"), "signed")
        shared.append(common.store(_shared(full, percent), "shared"))
        common.remove(full)
        common.free_shuffles(spark)
    family = common.store(common.components(reduce(DataFrame.union, shared), "families"), "family")
    for part in shared:
        common.remove(part)
    common.free_shuffles(spark)
    screen_bits = min(SCREEN_MOST, max(SCREEN_LEAST, (SCREEN_BITS * family.count()).bit_length()))
    slot = F.shiftrightunsigned("node", 64 - screen_bits)
    screen = sc.broadcast(common.bit_table(family.select(slot.alias("s")).distinct(), "s", screen_bits))  # 2 ** SCREEN_MOST bits at most
    sets = docs.select("text").mapInArrow(set_rows(k, screen, screen_bits), "print long, shingles binary")
    sets = sets.join(family.withColumnRenamed("node", "print"), "print").groupBy("print", "root").agg(F.first("shingles").alias("shingles"))
    sets = common.store(sets.withColumn("n", (F.octet_length("shingles") / 8).cast("long")), "sets")
    common.free_shuffles(spark)
    sizes = common.store(sets.groupBy("root").agg(_pieces(CELL_DOCS, CELL_SHINGLES).alias("chunks"), _pieces(SIDE_DOCS, SIDE_SHINGLES).alias("sides"), F.count("*").alias("members")), "family-sizes")
    cut = sets.join(sizes, "root")
    chunk = F.pmod(F.xxhash64("print", F.lit(7)), "chunks")
    # A family in chunks has some sixteen members that sit in every chunk and tie them together.
    tied = (F.col("chunks") > 1) & (F.pmod(F.xxhash64("print", F.lit(11)), F.ceil(F.col("members") / 16)) == 0)
    cells = cut.withColumn("cell", F.explode(F.when(tied, F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).otherwise(F.array(chunk))))
    cells = cells.select("root", "cell", "print", F.col("print").alias("label"), F.lit(0).alias("side"), "shingles")
    links = cells.groupBy("root", "cell").applyInArrow(join_cell(percent), "a long, b long")
    links = common.store(links, "links")
    common.free_shuffles(spark)
    labels = common.store(common.components(links, "linked"), "labels")
    if not sizes.filter("chunks > 1").isEmpty():
        links = links.union(_across_chunks(sets, sizes, labels, percent))
        labels = common.store(common.components(links, "linked"), "labels")
    common.remove(sets)
    common.free_shuffles(spark)
    return _with_component(signed, labels, id_name)


def related_rows(percent: int):
    """Pairs (a, b) that were not to be tested or whose sketches leave them related."""

    def run(batches):
        for batch in batches:
            sure, n, m, x, y = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("sure", "n", "m", "x", "y"))
            kept = [t or related(percent, *of) for t, *of in zip(sure, n, x, m, y)]
            yield pa.RecordBatch.from_arrays(common.keep(batch, "a", "b"), names=["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return common.released(run)


def _shared(full: DataFrame, percent: int) -> DataFrame:
    """Prints (a, b) of sets that share a part hash.  In the shuffle a document is its row
    number, whose high bytes repeat and compress away.  A hash of few rows gives all its pairs,
    of which related ones stay; one of many rows ties all to its first."""
    by_key = Window.partitionBy("key").orderBy("_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    keyed = full.select("_row", F.explode("keys").alias("key"))
    shared = keyed.withColumn("hub", F.first("_row").over(by_key)).filter("hub <> _row")
    groups = shared.groupBy("key").agg(F.first("hub").alias("hub"), F.array_sort(F.collect_set("_row")).alias("rows"))
    pair = lambda x, y, sure: F.struct(x.alias("_row"), y.alias("hub"), F.lit(sure).alias("sure"))
    every = F.concat(F.array("hub"), F.col("rows"))
    few = F.flatten(F.transform("rows", lambda x, i: F.transform(F.slice(every, F.lit(1), i + 1), lambda y: pair(x, y, False))))
    many = F.transform("rows", lambda x: pair(x, F.col("hub"), True))
    shared = groups.select(F.explode(F.when(F.size("rows") < TESTED, few).otherwise(many)).alias("p")).select("p.*").groupBy("_row", "hub").agg(F.max("sure").alias("sure"))
    of = full.select("_row", F.col("print").alias("a"), F.col("n_shingles").alias("n"), F.col("sketch").alias("x"))
    shared = shared.join(of, "_row").join(of.select(F.col("_row").alias("hub"), F.col("a").alias("b"), F.col("n").alias("m"), F.col("x").alias("y")), "hub").filter("a <> b").drop("_row", "hub")
    return shared.mapInArrow(related_rows(percent), "a long, b long").union(full.select(F.col("print").alias("a"), F.explode("met").alias("b")))


def _pieces(docs: int, shingles: int):
    """Pieces of a family with at most about so many documents and shingles."""
    return F.greatest(F.ceil(F.count("*") / docs), F.ceil(F.sum("n") / shingles)).cast("long")


def _across_chunks(sets: DataFrame, sizes: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Links that the chunks of large families may have missed: those between members
    outside the family's largest component and any member of another component."""
    large = sizes.filter("chunks > 1").select("root", F.col("sides").alias("chunks"))
    member = sets.select("root", "print", "n").join(large, "root").join(labels.select(F.col("node").alias("print"), F.col("root").alias("label")), "print", "left").withColumn("label", F.coalesce("label", "print"))
    main = member.groupBy("root", "label").count().groupBy("root").agg(F.max_by("label", F.struct("count", "label")).alias("main"))
    member = common.store(member.join(main, "root"), "members")
    minor = member.filter("label <> main")
    blocks = minor.groupBy("root").agg(_pieces(SIDE_DOCS, SIDE_SHINGLES).alias("blocks"))
    member = member.join(blocks, "root")
    block = F.pmod(F.xxhash64("print", F.lit(13)), "blocks")
    chunk = F.pmod(F.xxhash64("print", F.lit(7)), "chunks")
    to = lambda side, i, j: F.struct(F.lit(side).alias("side"), i.cast("long").alias("i"), j.cast("long").alias("j"))
    every = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    right = F.transform(every("blocks"), lambda j: to(2, chunk, j))
    left = F.transform(every("chunks"), lambda i: to(1, i, block))
    cells = member.withColumn("to", F.explode(F.when(F.col("label") == F.col("main"), right).otherwise(F.concat(left, right))))
    cells = cells.select("print", "root", "label", "to.*").join(sets.select("print", "shingles"), "print")
    return common.store(cells.groupBy("root", "i", "j").applyInArrow(join_cell(percent), "a long, b long"), "links")


def _with_component(signed: DataFrame, labels: DataFrame, id_name: str) -> DataFrame:
    """Every row with the smallest id of its component."""
    classes = signed.filter("print is not null").groupBy("print").agg(F.min(id_name).alias("_least")).join(labels.select(F.col("node").alias("print"), "root"), "print", "left").withColumn("root", F.coalesce("root", "print"))
    least = classes.groupBy("root").agg(F.min("_least").alias("component_id"))
    named = classes.select("print", "root").join(least, "root").select("print", "component_id")
    rows = signed.select(id_name, "n_shingles", "print").join(named, "print", "left")
    return rows.select(id_name, "n_shingles", F.coalesce("component_id", F.col(id_name)).alias("component_id"))


def op5_signature_tree(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(common.table(spark, sf_dir, "documents"), 3, 90)
