"""Interpolated modified Kneser-Ney trigram model.

Spark counts the corpus in three steps, each written before the next reads it.

1. Words.  Every task counts its tokens, and a grouped step adds them up into sorted word
   arrays.  How often each slot of words occurs says into how many parts a frequent word's
   trigrams are split.
2. Trigrams (u, v, w).  Every task turns its texts into blobs of distinct trigrams, dealt
   into shards by the middle word v (and by u too for split words).  A grouped step merges a
   shard's blobs.  All that a shard needs to know is in it: the counts of its trigrams, each
   context (u, v) with its total and how many followers occurred once, twice and more often,
   and each pair (v, w) with its number of distinct words before it.  It writes these as
   sorted hash arrays into the shared folder.  Pairs of split words go on to a merge of
   their own.
3. Each word's number of distinct predecessors, and the totals of split words, are added up.

Scoring workers map the arrays into memory and look up some hundred thousand tokens at a
time, shard by shard.  Below the trigrams stand the pairs, counted by distinct words before
them, then the words by distinct predecessors, and below that the uniform distribution over
the vocabulary and one unknown word; each level is reached by modified discounts (one for
counts of one, of two, of three and more).

A manifest says which files there are and how long they are; a file that is missing or cut
stops the job instead of changing scores.

Token hashes have 48 bits.  Within a shard an entry is known by 32 bits and its bucket of
about BUCKET entries, so an unseen trigram is taken for a seen one with a chance of about
four in a billion.

Edge cases: a null or empty text is the end token alone; an empty training fold leaves the
uniform distribution; empty tables give an empty result; repeated rows count as often as
they occur; a null id belongs to the fold of the empty text; extra columns are not read.
"""

from __future__ import annotations

import functools
import mmap
import os
import urllib.parse
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm import common
from tessera.llm.hashing import mixed, word_hashes

#: The end token; no word has this hash but by chance.
END = np.uint64(0xE2D)
#: Tokens that a task holds before it turns them into arrays, and before it looks them up.
BUFFER_TOKENS = 2_000_000
ROUND_TOKENS = 500_000
#: Passes over the texts in which trigrams are counted, each for its share of the shards, so
#: that so much less lies in the shuffle at a time.
PASSES = 3
#: Files that a worker keeps mapped.
OPEN_FILES = 600
#: The same where files cannot be mapped and must be read into memory.
OPEN_FETCHED = 4
#: UTF-8 bytes of text that make one more shard.
SHARD_BYTES = 12_000_000
#: log2 of the counters that find frequent words, and entries of a table for each of its
#: lookup buckets.
SLOT_BITS = 16
BUCKET = 16


def token_hashes(raws: list[bytes]) -> list[np.ndarray]:
    """48-bit hashes of each text's words, and the end token."""
    return [np.append(h >> np.uint64(16), END) for h in word_hashes(raws)]


def grams(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(u, v, w) of every token: the two tokens before a text are end tokens."""
    w = np.concatenate(texts)
    v = np.r_[END, w[:-1]]
    u = np.r_[END, END, w[:-2]][: len(w)]
    u[np.cumsum([0] + [len(t) for t in texts[:-1]])] = END
    return u, v, w


class Shards:
    """Where things are kept: trigrams by their middle word, and by their first word too if
    the middle word is split; pairs of split words by both words."""

    def __init__(self, n: int, parts: np.ndarray):
        self.n, self.parts = n, parts  # parts of each slot of words

    @staticmethod
    def slot(word: np.ndarray) -> np.ndarray:
        return (mixed(word) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)

    def split(self, word: np.ndarray) -> np.ndarray:
        return self.parts[self.slot(word)] > 1

    def of(self, middle: np.ndarray, other: np.ndarray) -> np.ndarray:
        return self.by_key(middle * np.uint64(0x9E3779B97F4A7C15) + mixed(other) % self.parts[self.slot(middle)].astype(np.uint64))

    def by_key(self, key: np.ndarray) -> np.ndarray:
        return (mixed(key + np.uint64(1)) % np.uint64(self.n)).astype(np.int64)


def identity(*words: np.ndarray) -> np.ndarray:
    """64 bits that stand for a sequence of words."""
    out = words[0]
    for word in words[1:]:
        out = mixed(out * np.uint64(0x94D049BB133111EB) + word)
    return mixed(out)


def six_bytes(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype("<u8")[:, None].view(np.uint8)[:, :6]).tobytes()


def from_six(raw) -> np.ndarray:
    part = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    full = np.zeros((len(part), 8), np.uint8)
    full[:, :6] = part
    return full.view("<u8")[:, 0]


def narrow(x: np.ndarray) -> bytes:
    """Numbers in as few bytes each as the largest needs (1, 2, 4 or 8, said first)."""
    most = int(x.max()) if len(x) else 0
    width = 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4 if most < 1 << 32 else 8
    return bytes([width]) + x.astype(f"<u{width}").tobytes()


def widened(raw) -> np.ndarray:
    return np.frombuffer(raw, f"<u{memoryview(raw)[0]}", offset=1).astype(np.int64)


def runs(x: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values."""
    return np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else np.zeros(0, np.int64)


def in_order(n: int, *columns: np.ndarray) -> np.ndarray:
    """Places that sort rows of numbers below n by the first column, then the second, ..."""
    bits = max(1, int(n).bit_length())
    if bits * len(columns) > 64:
        return np.lexsort(columns[::-1])
    key = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        key = key << np.uint64(bits) | c.astype(np.uint64)
    return np.argsort(key)


def new_row(*columns: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal rows."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    differs = np.zeros(len(columns[0]), bool)
    differs[0] = True
    for c in columns:
        differs[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(differs)


# ---- counting ----

NUMBERS = "kind int, shard int, keys binary, others binary, numbers binary"
SUMS3, SUMS2, PAIR, WORD, CONTEXT = range(5)


def rows(values: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    columns = list(zip(*values)) if values else [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(columns, kinds)], names=["kind", "shard", "keys", "others", "numbers"])


def blobs(table: pa.Table, name: str):
    return [x.as_buffer() for chunk in table.column(name).chunks for x in chunk]


def by_shard(kind: int, at: np.ndarray, keys: np.ndarray, others: np.ndarray | None, numbers: np.ndarray) -> list[tuple]:
    """Rows of each shard's keys and numbers."""
    order = np.argsort(at, kind="stable")
    at, keys, numbers = at[order], keys[order], numbers[order]
    begin = runs(at)
    return [
        (kind, int(at[a]), six_bytes(keys[a:b]), six_bytes(others[order[a:b]]) if others is not None else b"", narrow(numbers[a:b].ravel()))
        for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(at)])
    ]


def held(batches, most: int):
    """Lists of texts' tokens, with about ``most`` tokens each."""
    texts: list[np.ndarray] = []
    n = 0
    for batch in batches:
        some = token_hashes(common.binary_texts(batch))
        texts += some
        n += sum(map(len, some))
        if n >= most:
            yield texts
            texts, n = [], 0
    if texts:
        yield texts


def count_words(n: int):
    """A task's token counts."""
    place = Shards(n, np.ones(1, np.int64))

    def run(batches):
        for texts in held(batches, BUFFER_TOKENS):
            words, counts = np.unique(np.concatenate(texts), return_counts=True)
            yield rows(by_shard(WORD, place.by_key(words), words, None, counts))

    return run


def merge_words(uri: str):
    """Write a shard's words and counts; report how often each slot occurs."""

    def run(key, table):
        keys, numbers = added(table)
        size = Folder(uri).write(f"words-{key[0].as_py()}", count_table(identity(keys), numbers[:, 0]))
        slots, back = np.unique(Shards.slot(keys), return_inverse=True)
        n = np.bincount(back, weights=numbers[:, 0].astype(np.float64), minlength=len(slots)).astype(np.int64)
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "bytes": pa.array([size], pa.int64()), "words": pa.array([len(keys)], pa.int64()), "slots": pa.array([slots.tolist()], pa.list_(pa.int64())), "n": pa.array([n.tolist()], pa.list_(pa.int64()))})

    return run


def added(table: pa.Table, width: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """A shard's distinct keys in order with their added-up numbers."""
    parts = [from_six(x) for x in blobs(table, "keys")]
    keys = np.concatenate(parts)
    numbers = np.concatenate([widened(x) for x in blobs(table, "numbers")]).reshape(-1, width)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = runs(keys)
    return keys[first], np.add.reduceat(numbers[order], first, axis=0).astype("<u8")


def count_trigrams(shards: Shards, turn: int):
    """Texts as blobs of distinct trigrams of the shards that have this turn: shard, the
    blob's words, runs of middle words (place, length), places of first and last words,
    counts."""

    def flush(parts):
        at, u, v, w = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(at.astype(np.uint16) if shards.n <= 1 << 16 else at, kind="stable")
        at, u, v, w = at[order], u[order], v[order], w[order]
        begin = runs(at)
        out: list[list] = [[] for _ in range(7)]
        for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(at)]):
            words, place = np.unique(np.concatenate([u[a:b], v[a:b], w[a:b]]), return_inverse=True)
            first, middle, last = place.reshape(3, -1)
            order = in_order(len(words), middle, first, last)
            first, middle, last = first[order], middle[order], last[order]
            new = new_row(middle, first, last)
            count = np.diff(np.r_[new, len(order)])
            first, middle, last = first[new], middle[new], last[new]
            own = runs(middle)
            values = (int(at[a]), six_bytes(words), narrow(middle[own]), narrow(np.diff(np.r_[own, len(new)])), narrow(first), narrow(last), narrow(count))
            for column, value in zip(out, values):
                column.append(value)
        return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), *(pa.array(x, pa.binary()) for x in out[1:])], names=["shard", "words", "middles", "lengths", "firsts", "lasts", "counts"])

    def run(batches):
        parts, n = [], 0
        for texts in held(batches, BUFFER_TOKENS // 4):
            u, v, w = grams(texts)
            for a in range(0, len(w), BUFFER_TOKENS):
                x = [c[a : a + BUFFER_TOKENS] for c in (u, v, w)]
                at = shards.of(x[1], x[0])
                mine = np.flatnonzero(at % PASSES == turn)
                parts.append((at[mine], *(c[mine] for c in x)))
                n += len(mine)
                if n >= BUFFER_TOKENS:
                    yield flush(parts)
                    parts, n = [], 0
        if n:
            yield flush(parts)

    return run


TRIGRAM_BLOBS = "shard int, words binary, middles binary, lengths binary, firsts binary, lasts binary, counts binary"


def followers(context: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of rows in the order of their contexts: first row of each context, and its total and
    how many of its rows have count one, two, and more."""
    begin = runs(context)
    if not len(begin):
        return begin, np.zeros((0, 4), np.uint64)
    return begin, np.stack([np.add.reduceat(x.astype(np.uint64), begin) for x in (count, count == 1, count == 2, count >= 3)], axis=1)


def of_each(count: np.ndarray) -> np.ndarray:
    """How many counts are one, two, three, four."""
    return np.bincount(np.minimum(count, 5).astype(np.int64), minlength=6)[1:5]


def sums(kind: int, *numbers) -> tuple:
    return (kind, 0, b"", b"", np.array(numbers, "<u8").tobytes())


def merge_trigrams(uri: str, shards: Shards):
    """Merge and write a shard; pass on words, pairs of split words, and sums."""

    def run(key, table):
        shard = key[0].as_py()
        found = [from_six(x) for x in blobs(table, "words")]
        words, back = np.unique(np.concatenate(found), return_inverse=True)
        columns, upto = ([], [], [], []), 0
        for held, *raw in zip(found, *(blobs(table, n) for n in ("middles", "lengths", "firsts", "lasts", "counts"))):
            own, upto = back[upto : upto + len(held)].astype(np.int32), upto + len(held)
            for column, x in zip(columns, (np.repeat(own[widened(raw[0])], widened(raw[1])), own[widened(raw[2])], own[widened(raw[3])], widened(raw[4]))):
                column.append(x)
        v, u, w, count = (np.concatenate(x) for x in columns)
        order = in_order(len(words), v, u, w)
        v, u, w, count = v[order], u[order], w[order], count[order]
        first = new_row(v, u, w)
        count = np.add.reduceat(count, first)
        v, u, w = v[first], u[first], w[first]

        context = v.astype(np.int64) << 32 | u
        begin, numbers = followers(context, count)
        tables = [*count_table(identity(words[u], words[v], words[w]), count), *context_table(identity(words[u[begin]], words[v[begin]]), numbers)]
        out = [sums(SUMS3, *of_each(count))]

        order = in_order(len(words), v, w)
        v, w = v[order], w[order]
        first = new_row(v, w)
        before = np.diff(np.r_[first, len(v)])
        v, w = v[first], w[first]
        split = shards.split(words)[v]
        if split.any():
            out += by_shard(PAIR, shards.of(words[v[split]], words[w[split]]), words[v[split]], words[w[split]], before[split])
        v, w, before = v[~split], w[~split], before[~split]
        begin, numbers = followers(v, before)
        tables += [*count_table(identity(words[v], words[w]), before), *context_table(identity(words[v[begin]]), numbers)]
        out += pair_rows(words[w], before, shards)
        size = Folder(uri).write(f"trigrams-{shard}", tables)
        return pa.Table.from_batches([rows([*out, sums(SUMS3, 0, 0, 0, 0, shard, size)])])

    return run


def pair_rows(last: np.ndarray, before: np.ndarray, shards: Shards) -> list[tuple]:
    """What finished pairs pass on: sums, and their last words' numbers of predecessors."""
    w, times = np.unique(last, return_counts=True)
    return [sums(SUMS2, *of_each(before)), *by_shard(WORD, shards.by_key(w), w, None, times)]


def merge_pairs(uri: str, shards: Shards):
    """Merge and write a shard of split words' pairs; pass on words, contexts and sums."""

    def run(key, table):
        shard = key[0].as_py()
        v, w = (np.concatenate([from_six(x) for x in blobs(table, n)]) for n in ("keys", "others"))
        before = np.concatenate([widened(x) for x in blobs(table, "numbers")])
        order = np.lexsort((w, v))
        v, w, before = v[order], w[order], before[order]
        first = new_row(v, w)
        before = np.add.reduceat(before, first)
        v, w = v[first], w[first]
        begin, numbers = followers(v, before)
        out = [*pair_rows(w, before, shards), *by_shard(CONTEXT, shards.by_key(v[begin]), v[begin], None, numbers.astype(np.int64))]
        size = Folder(uri).write(f"pairs-{shard}", count_table(identity(v, w), before))
        return pa.Table.from_batches([rows([*out, sums(SUMS2, 0, 0, 0, 0, shard, size)])])

    return run


def merge_numbers(uri: str):
    """Add up and write words' predecessors or split words' totals; report sums."""

    def run(key, table):
        kind, shard = key[0].as_py(), key[1].as_py()
        keys, numbers = added(table, 1 if kind == WORD else 4)
        size = Folder(uri).write(f"before-{shard}", count_table(identity(keys), numbers[:, 0])) if kind == WORD else Folder(uri).write(f"contexts-{shard}", context_table(identity(keys), numbers))
        report = [*of_each(numbers[:, 0]).tolist(), len(keys), int(numbers[:, 0].sum())]
        return pa.table({"kind": pa.array([kind], pa.int32()), "shard": pa.array([shard], pa.int32()), "bytes": pa.array([size], pa.int64()), **{n: pa.array([int(x)], pa.int64()) for n, x in zip(("n1", "n2", "n3", "n4", "keys", "total"), report)}})

    return run


# ---- sorted hash arrays ----


def put(x: np.ndarray) -> list[np.ndarray]:
    """Numbers as bytes, and those above 254 apart."""
    many = np.flatnonzero(x > 254)
    return [np.minimum(x, 255).astype(np.uint8), many.astype("<u4"), x[many].astype("<u8")]


PUT = (np.uint8, "<u4", "<u8")


def get(small: np.ndarray, many: np.ndarray, large: np.ndarray, at: np.ndarray) -> np.ndarray:
    out = small[at].astype(np.float64)
    full = np.flatnonzero(out == 255)
    if len(full):
        out[full] = large[np.searchsorted(many, at[full])]
    return out


def sorted_keys(x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(order, [bucket ends, keys]): an identity is known by its bucket and 32 bits more."""
    bits = max(8, (len(x) // BUCKET).bit_length())
    keys = x >> np.uint64(32 - bits)
    order = np.argsort(keys)
    keys = keys[order]
    return order, [np.searchsorted(keys >> np.uint64(32), np.arange((1 << bits) + 1).astype(np.uint64)).astype("<u4"), keys.astype("<u4")]


def count_table(x: np.ndarray, count: np.ndarray) -> list[np.ndarray]:
    order, keys = sorted_keys(x)
    return [*keys, *put(count[order])]


def context_table(x: np.ndarray, numbers: np.ndarray) -> list[np.ndarray]:
    """Most contexts have but a few followers seen once or twice and none more often: one byte
    says so.  The numbers of all others are kept apart."""
    order, keys = sorted_keys(x)
    numbers = numbers[order]
    few = (numbers[:, 1] < 15) & (numbers[:, 2] < 15) & (numbers[:, 3] == 0)
    more = np.flatnonzero(~few)
    return [*keys, np.where(few, numbers[:, 1] * np.uint64(15) + numbers[:, 2], 255).astype(np.uint8), more.astype("<u4"), *(a for c in numbers[more].T for a in put(c))]


COUNTS = ("<u4", "<u4", *PUT)
CONTEXTS = ("<u4", "<u4", np.uint8, "<u4", *PUT * 4)


def find(offsets: np.ndarray, kept: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of the found, where they are kept)."""
    if not len(kept):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    bits = (len(offsets) - 1).bit_length() - 1
    bucket, want = (x >> np.uint64(64 - bits)).astype(np.int64), (x >> np.uint64(32 - bits)).astype(np.uint32)
    low, stop = offsets[bucket].astype(np.int64), offsets[bucket + 1].astype(np.int64)
    step = 1 << int((stop - low).max()).bit_length()
    while step := step >> 1:  # as far as keys are smaller
        probe = low + (step - 1)
        less = np.take(kept, probe, mode="clip") < want
        less &= probe < stop
        low += less * step
    hit = np.flatnonzero((low < stop) & (np.take(kept, low, mode="clip") == want))
    return hit, low[hit]


class Folder:
    """Arrays in files of the shared folder, on a mounted path or in any store that pyarrow
    opens.  A file is written under a task's own name and then moved, so a retried task
    leaves no half file."""

    def __init__(self, uri: str):
        parts = urllib.parse.urlparse(uri)
        self.uri, self.path = uri, parts.path if parts.scheme in ("", "file") else None
        self.opened: dict[str, tuple] = {}
        self.most = OPEN_FILES if self.path is not None else OPEN_FETCHED

    def write(self, name: str, arrays: list[np.ndarray]) -> int:
        """Returns the file's length."""
        body = [np.array([len(arrays), *(x.nbytes for x in arrays)], dtype="<u8").tobytes()]
        for x in arrays:
            body += [np.ascontiguousarray(x).tobytes(), bytes(-x.nbytes % 8)]
        if self.path is not None:
            os.makedirs(self.path, exist_ok=True)
            own = f"{self.path}/.{name}-{uuid.uuid4().hex}"
            with open(own, "wb") as out:
                out.writelines(body)
            os.replace(own, f"{self.path}/{name}")
        else:
            from pyarrow import fs

            store, path = fs.FileSystem.from_uri(self.uri)
            store.create_dir(path, recursive=True)
            with store.open_output_stream(f"{path}/{name}") as out:
                for part in body:
                    out.write(part)
        return sum(map(len, body))

    def arrays(self, name: str, size: int, kinds, first: int = 0) -> list[np.ndarray]:
        """Arrays number ``first`` and following of a file that the manifest gives ``size``
        bytes: mapped memory, or read into memory where the store has no path."""
        if not size:
            return [np.zeros(0, k) for k in kinds]
        raw, starts, stops = self.opened.get(name) or self._open(name, size)
        return [raw[starts[i] : stops[i]].view(k) for i, k in enumerate(kinds, first)]

    def _open(self, name: str, size: int):
        if self.path is not None:
            with open(f"{self.path}/{name}", "rb") as file:
                raw = np.frombuffer(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ), np.uint8)
        else:
            from pyarrow import fs

            store, path = fs.FileSystem.from_uri(self.uri)
            with store.open_input_stream(f"{path}/{name}") as found:
                raw = np.frombuffer(found.read(), np.uint8)
        if len(raw) != size:
            raise OSError(f"{self.uri}/{name} has {len(raw)} bytes; the manifest says {size}")
        n = int(raw[:8].view("<u8")[0])
        sizes = raw[8 : 8 + 8 * n].view("<u8").astype(np.int64)
        starts = 8 + 8 * n + np.cumsum(sizes + -sizes % 8) - (sizes + -sizes % 8)
        if len(self.opened) >= self.most:
            self.opened.pop(next(iter(self.opened)))
        self.opened[name] = raw, starts.tolist(), (starts + sizes).tolist()
        return self.opened[name]


# ---- the model ----


def discounts(n1: float, n2: float, n3: float, n4: float) -> list[float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more, from the numbers of
    n-grams with counts 1 to 4; fixed ones where a number is missing (tiny corpora)."""
    if min(n1, n2, n3, n4) <= 0:
        return [0.5, 0.75, 0.9]
    y = n1 / (n1 + 2 * n2)
    raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [min(max(d, 0.01), i + 0.99) for i, d in enumerate(raw)]


def train(texts: DataFrame) -> dict:
    """Count ``texts`` and write the model; returns its folder, manifest and constants."""
    spark = texts.sparkSession
    uri = common.fresh_path(spark, "kneser-ney")
    size = int(texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    n = max(8, size // SHARD_BYTES)
    files = {name: np.zeros(n, np.int64) for name in ("words", "trigrams", "pairs", "before", "contexts")}

    words = texts.mapInArrow(count_words(n), NUMBERS).groupBy("shard").applyInArrow(merge_words(uri), "shard int, bytes long, words long, slots array<long>, n array<long>")
    words = common.store(words, "words")
    slots, vocabulary = np.zeros(1 << SLOT_BITS, np.int64), 0
    for r in words.select("shard", "bytes", "words").collect():  # a row for each shard
        files["words"][r.shard] = r.bytes
        vocabulary += r.words
    for r in words.select(F.explode(F.arrays_zip("slots", "n")).alias("x")).select("x.slots", "x.n").groupBy("slots").agg(F.sum("n").alias("n")).collect():  # 2 ** SLOT_BITS rows
        slots[r.slots] = r.n
    common.remove(words)
    total = int(slots.sum())
    shards = Shards(n, np.maximum(1, -(-slots * n * 2 // max(1, total))) if n > 8 else np.ones_like(slots))

    parts = []
    for turn in range(PASSES):
        common.free_shuffles(spark)
        parts.append(common.store(texts.mapInArrow(count_trigrams(shards, turn), TRIGRAM_BLOBS).groupBy("shard").applyInArrow(merge_trigrams(uri, shards), NUMBERS), "counts"))
    common.free_shuffles(spark)
    trigrams = functools.reduce(DataFrame.unionByName, parts)
    split = common.store(trigrams.filter(F.col("kind") == PAIR).groupBy("shard").applyInArrow(merge_pairs(uri, shards), NUMBERS), "pairs")
    left = trigrams.filter(F.col("kind") != PAIR).unionByName(split)
    found = left.filter(F.col("kind").isin(WORD, CONTEXT)).groupBy("kind", "shard").applyInArrow(merge_numbers(uri), "kind int, shard int, bytes long, n1 long, n2 long, n3 long, n4 long, keys long, total long")
    before = [0] * 6
    for r in found.collect():  # two rows a shard
        files["before" if r.kind == WORD else "contexts"][r.shard] = r.bytes
        if r.kind == WORD:
            before = [a + b for a, b in zip(before, (r.n1, r.n2, r.n3, r.n4, r["keys"], r.total))]
    level = {SUMS3: np.zeros(4), SUMS2: np.zeros(4)}
    for r in left.filter(F.col("kind").isin(SUMS3, SUMS2)).select("kind", "numbers").collect():  # a few rows a shard
        x = np.frombuffer(r.numbers, "<u8").astype(np.int64)
        level[r.kind] += x[:4]
        if len(x) > 4:
            files["trigrams" if r.kind == SUMS3 else "pairs"][x[4]] = x[5]
    for part in (*parts, split):
        common.remove(part)
    common.free_shuffles(spark)

    model = {"uri": uri, "shards": n, "parts": shards.parts, "files": files, "tokens": total, "vocabulary": vocabulary, "pairs": 0, "rest": 1.0, "d1": [0.0] * 3, "d2": [0.0] * 3, "d3": [0.0] * 3}
    if total:
        n1, n2, n3, n4, keys, pairs = before
        d1 = discounts(n1, n2, n3, n4)
        kept = d1[0] * n1 + d1[1] * n2 + d1[2] * (keys - n1 - n2)
        model |= {"pairs": pairs, "rest": kept / pairs, "d1": d1, "d2": discounts(*level[SUMS2]), "d3": discounts(*level[SUMS3])}
    return model


class Lookup:
    """Reads the model's sorted hash arrays; queries go shard by shard."""

    def __init__(self, model: dict):
        self.folder, self.files, self.shards = Folder(model["uri"]), model["files"], Shards(model["shards"], model["parts"])

    def arrays(self, name: str, shard: int, kinds, first: int = 0):
        return self.folder.arrays(f"{name}-{shard}", int(self.files[name][shard]), kinds, first)

    @staticmethod
    def each(at: np.ndarray):
        order = np.argsort(at.astype(np.uint16) if len(at) and at.max() < 1 << 16 else at, kind="stable")
        begin = runs(at[order])
        for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(order)]):
            yield int(at[order[a]]), order[a:b]

    @staticmethod
    def _count(arrays, x: np.ndarray, out: np.ndarray, some: np.ndarray) -> None:
        hit, at = find(arrays[0], arrays[1], x)
        out[some[hit]] = get(*arrays[2:5], at)

    @staticmethod
    def _context(arrays, x: np.ndarray, out: np.ndarray, some: np.ndarray) -> None:
        hit, at = find(arrays[0], arrays[1], x)
        code = arrays[2][at].astype(np.int64)
        once, twice = np.divmod(code, 15)
        found = np.stack([once + 2 * twice, once, twice, np.zeros(len(at), np.int64)], axis=1).astype(np.float64)
        more = np.flatnonzero(code == 255)
        if len(more):
            own = np.searchsorted(arrays[3], at[more])
            for j in range(4):
                found[more, j] = get(*arrays[4 + 3 * j : 7 + 3 * j], own)
        out[some[hit]] = found

    def words(self, name: str, words: np.ndarray) -> np.ndarray:
        """Counts (``words``) or predecessors (``before``) of words."""
        out = np.zeros(len(words))
        for shard, some in self.each(self.shards.by_key(words)):
            self._count(self.arrays(name, shard, COUNTS), identity(words[some]), out, some)
        return out

    def trigrams(self, u, v, w) -> tuple[np.ndarray, np.ndarray]:
        """Counts, and totals and followers of their contexts."""
        count, context = np.zeros(len(w)), np.zeros((len(w), 4))
        for shard, some in self.each(self.shards.of(v, u)):
            arrays = self.arrays("trigrams", shard, COUNTS + CONTEXTS)
            self._context(arrays[5:], identity(u[some], v[some]), context, some)
            known = some[context[some, 0] > 0]
            if len(known):
                self._count(arrays, identity(u[known], v[known], w[known]), count, known)
        return count, context

    def pairs(self, v, w) -> tuple[np.ndarray, np.ndarray]:
        count, context = np.zeros(len(w)), np.zeros((len(w), 4))
        split = self.shards.split(v)
        whole, cut = np.flatnonzero(~split), np.flatnonzero(split)
        for shard, some in self.each(self.shards.of(v[whole], w[whole])):
            some = whole[some]
            arrays = self.arrays("trigrams", shard, COUNTS + CONTEXTS, len(COUNTS + CONTEXTS))
            self._count(arrays, identity(v[some], w[some]), count, some)
            self._context(arrays[5:], identity(v[some]), context, some)
        for shard, some in self.each(self.shards.of(v[cut], w[cut])):
            some = cut[some]
            self._count(self.arrays("pairs", shard, COUNTS), identity(v[some], w[some]), count, some)
        words, back = np.unique(v[cut], return_inverse=True)
        found = np.zeros((len(words), 4))
        for shard, some in self.each(self.shards.by_key(words)):
            self._context(self.arrays("contexts", shard, CONTEXTS), identity(words[some]), found, some)
        context[cut] = found[back]
        return count, context


def interpolated(count: np.ndarray, context: np.ndarray, lower: np.ndarray, discount: list[float]) -> np.ndarray:
    """Discounted share of the context's total, and the lower order's share of the rest."""
    d = np.array([0.0, *discount])
    kept = np.maximum(count - d[np.minimum(count, 3).astype(np.int64)], 0)
    rest = context[:, 1] * d[1] + context[:, 2] * d[2] + context[:, 3] * d[3]
    known = context[:, 0] > 0
    return np.where(known, (kept + rest * lower) / np.where(known, context[:, 0], 1), lower)


def token_scores(model: dict, look: Lookup, u, v, w) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every token: is it known, its base score and its log10 probability."""
    tokens, vocabulary = model["tokens"], model["vocabulary"]
    words, at = np.unique(w, return_inverse=True)
    c = look.words("words", words)
    base = np.log10((c + 1) / (tokens + 1.0 * (vocabulary + 1)))
    _, some, back = np.unique(identity(v, w), return_index=True, return_inverse=True)
    V, W = v[some], w[some]
    before = look.words("before", words)
    d1 = np.array([0.0, *model["d1"]])
    p1 = np.maximum(before - d1[np.minimum(before, 3).astype(np.int64)], 0) / max(1, model["pairs"]) + model["rest"] / (vocabulary + 1)
    p2 = interpolated(*look.pairs(V, W), p1[at[some]], model["d2"])
    p3 = interpolated(*look.trigrams(u, v, w), p2[back], model["d3"])
    return (c > 0)[at], base[at], np.log10(p3)


def score_rows(model: dict):
    """Texts with n_tokens, n_known, train_tokens, base_score and score."""

    def flush(look, kept, texts):
        sizes = np.array([len(t) for t in texts])
        starts = np.cumsum(sizes) - sizes
        u, v, w = grams(texts)
        parts = [token_scores(model, look, *(x[a : a + 2 * ROUND_TOKENS] for x in (u, v, w))) for a in range(0, len(w), 2 * ROUND_TOKENS)]
        known, base, score = (np.concatenate(x) for x in zip(*parts))
        values = [sizes, np.add.reduceat(known.astype(np.int64), starts), np.full(len(sizes), model["tokens"]), np.add.reduceat(base, starts), np.add.reduceat(score, starts)]
        return pa.RecordBatch.from_arrays([*(pa.concat_arrays(x) for x in zip(*kept)), *map(pa.array, values)], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    def run(batches):
        look, kept, texts, n = Lookup(model), [], [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            some = token_hashes(common.binary_texts(batch))
            texts += some
            n += sum(map(len, some))
            kept.append(common.keep(batch, "doc_id", "held_out"))
            if n >= ROUND_TOKENS:
                yield flush(look, kept, texts)
                kept, texts, n = [], [], 0
        if texts:
            yield flush(look, kept, texts)

    return run


def score(docs: DataFrame, model: dict) -> DataFrame:
    """log10 probability of every text; docs have doc_id, held_out and text."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "held_out", "text").mapInArrow(score_rows(model), f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op9_kneser_ney(spark, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").withColumn("held_out", common.fold("doc_id", 7) == 2)
    return score(docs, train(docs.filter("not held_out").select("text")))
