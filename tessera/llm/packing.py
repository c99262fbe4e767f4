"""Packing token sequences by Karmarkar-Karp multiway differencing.

A document's ids are cut at multiples of the window; full pieces are windows of their own.
The rest of each document is cut at multiples of a third of the window, which lets windows
fill to about 99 %.  Pieces are dealt into groups of bounded size, and
each group is partitioned into k windows by multiway differencing: every piece starts as a
partial partition (its size in one window, k - 1 empty ones); the two partial partitions
with the widest spread merge with opposing imbalances (fullest with emptiest), until one
is left.  k starts at the least number that could hold the group and rises whenever a
window exceeds its capacity.  Groups fill independently, so the plan scales out and a lost
executor costs one group.

Edge cases: a null or empty text is the end id alone; a very long text becomes full windows
and a rest; equal sizes are dealt in the order of their rows; repeated rows are packed once
per row; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import heapq
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm import common

WINDOW = 2048
#: Pieces in a group that is packed as one; bounds a task's memory and time.
GROUP_PIECES = 512
#: Words whose ids a worker remembers, in each of two generations.
REMEMBERED_WORDS = 400_000
#: White space of the tokenizer's patterns; str.split() also splits at 1C to 1F.
SPACES = "\t-\r \x85\xa0  -     　"


#: Chunks of these characters (printable ASCII, precomposed Latin letters) are split into
#: the tokenizer's pre-tokens here; it encodes all others whole.
SIMPLE = re.compile("[!-~\u00c0-\u012f\u0131-\u017e]+")
PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")


def byte_letters() -> list[str]:
    """The letter that byte-level BPE writes for each byte: itself where printable, else
    the next of the letters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class Remembered(dict):
    """A dictionary of two generations, so frequent keys survive when it is full."""

    def __init__(self, most: int):
        super().__init__()
        self.most, self.old = most, {}

    def turn(self) -> None:
        if len(self) > self.most:
            self.old = dict(self)
            self.clear()


class WordIds(Remembered):
    """Ids of white-space-free chunks as bytes of little-endian unsigned 32-bit numbers.
    The tokenizer never joins ids across white space, so chunks can be remembered; nor
    across its pre-tokens, so these are remembered too."""

    def __init__(self, tokenizer_file: str, most: int = REMEMBERED_WORDS):
        from tokenizers import Tokenizer

        super().__init__(most)
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.model = self.tokenizer.model
        self.pieces = Remembered(most)
        self.chunk = re.compile(f"[^{SPACES}]+")
        self.odd = re.compile("[\x1c-\x1f]")
        self.letters = dict(enumerate(byte_letters()))

    def split(self, text: str) -> list[str]:
        return self.chunk.findall(text) if self.odd.search(text) else text.split()

    def piece(self, text: str) -> bytes:
        ids = self.pieces.get(text)
        if ids is None:
            ids = self.pieces.old.get(text)
            if ids is None:
                written = text if text.isascii() else text.encode().decode("latin-1").translate(self.letters)
                ids = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(written)])
            self.pieces[text] = ids
        return ids

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            if SIMPLE.fullmatch(word) and "<|" not in word:
                ids = b"".join(map(self.piece, PIECE.findall(word.lower())))
            else:
                ids = b"".join([i.to_bytes(4, "little") for i in self.tokenizer.encode(word, add_special_tokens=False).ids])
        self[word] = ids
        return ids

    def encode_all(self, texts: list[str], end: bytes):
        """Yield each text's ids, with the end id, as bytes."""
        get = self.__getitem__
        for text in texts:
            self.turn()
            self.pieces.turn()
            yield b"".join(map(get, self.split(text))) + end


def token_pieces(tokenizer_file: str, window: int, end_id: int):
    small = max(1, window // 3)

    def run(batches):
        ids = WordIds(tokenizer_file)
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for i, raw in enumerate(ids.encode_all(common.strings(batch), end)):
                n = len(raw) // 4
                full = n - n % window
                cuts = [*range(0, full, window), *range(full, n, small), n]
                for start, stop in zip(cuts, cuts[1:]):
                    piece = raw[4 * start : 4 * stop]
                    for column, value in zip(out, (i, start, len(piece) // 4, zlib.crc32(piece), n)):
                        column.append(value)
            doc_id = common.keep(batch, "doc_id")[0].take(pa.array(out[0], pa.int64()))
            yield pa.RecordBatch.from_arrays([doc_id, *(pa.array(x, pa.int64()) for x in out[1:])], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return common.released(run)


def differencing(sizes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Karmarkar-Karp into k parts: (part of each piece, sums of the parts)."""
    n = len(sizes)
    sums: list = [None] * (2 * n - 1)
    made: list = [None] * (2 * n - 1)
    heap = []
    for i, s in enumerate(sizes.tolist()):
        v = np.zeros(k, dtype=np.int64)
        v[-1] = s
        sums[i] = v
        heap.append((-s if k > 1 else 0, i))
    heapq.heapify(heap)
    top = n - 1 if n == 1 else None
    for node in range(n, 2 * n - 1):
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        joined = sums[a] + sums[b][::-1]
        order = np.argsort(joined, kind="stable")
        sums[node] = joined[order]
        made[node] = (a, b, order)
        sums[a] = sums[b] = None
        heapq.heappush(heap, (-int(sums[node][-1] - sums[node][0]), node))
        top = node
    part = np.zeros(n, dtype=np.int64)
    todo = [(top, np.arange(k))]
    while todo:
        node, to = todo.pop()
        if node < n:
            part[node] = to[-1]
            continue
        a, b, order = made[node]
        back = np.empty(k, dtype=np.int64)
        back[order] = to
        todo += [(a, back), (b, back[::-1])]
    total = np.bincount(part, weights=sizes, minlength=k).astype(np.int64)
    return part, total


def pack_sizes(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """A window for each piece; no window exceeds the capacity."""
    k = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        part, total = differencing(sizes, k)
        over = int((total > capacity).sum())
        if not over:
            return part
        k += 1


def _pack_group(capacity: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rid", ignore_index=True)
        sizes = pdf["length"].to_numpy()
        part = np.zeros(len(pdf), dtype=np.int64)
        whole = sizes >= capacity
        part[whole] = np.arange(whole.sum())
        if (~whole).any():
            part[~whole] = whole.sum() + pack_sizes(sizes[~whole], capacity)
        _, part = np.unique(part, return_inverse=True)
        order = np.argsort(part, kind="stable")
        upto = np.cumsum(sizes[order])
        first = np.r_[True, np.diff(part[order]) > 0]
        base = (upto - sizes[order])[first]
        offset = np.empty(len(pdf), dtype=np.int64)
        offset[order] = upto - sizes[order] - np.repeat(base, np.diff(np.r_[np.flatnonzero(first), len(pdf)]))
        pdf["sequence_id"] = pdf["grp"].astype("int64") * (1 << 24) + part
        pdf["offset"] = offset
        return pdf[["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]]

    return run


def pack(docs: DataFrame, tokenizer_file: str, window: int = WINDOW, end_id: int = 1) -> DataFrame:
    """Pieces of all documents with their places: doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    pieces = docs.select("doc_id", "text").mapInArrow(token_pieces(tokenizer_file, window, end_id), f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long")
    pieces = common.store(pieces.withColumn("rid", F.monotonically_increasing_id()), "pieces")
    n = pieces.count()
    groups = max(1, -(-n // GROUP_PIECES))
    return (
        pieces.withColumn("grp", F.pmod(F.xxhash64("rid"), F.lit(groups)))
        .groupBy("grp")
        .applyInPandas(_pack_group(window), f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    )


def op7_karmarkar_karp(spark, sf_dir: str, tokenizer: str = "word_bpe_49k.json") -> DataFrame:
    import public_tokenizers

    return pack(common.table(spark, sf_dir, "documents"), public_tokenizers.path(tokenizer))
