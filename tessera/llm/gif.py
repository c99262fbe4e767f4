"""GIF media columns: an encoder and a decoder of GIF89a.

The decoder reads LZW code streams, applies global and local palettes, disposal methods,
transparency and interlacing, and yields the timed, composited frames.  The encoder writes
indexed frames losslessly.  `op1_gif` writes texts as media into the shared folder, reads
the stored media back, and returns each text's timed frames with colour histograms.

Edge cases: a null text is the empty text (one padded row of pixels); a null value, one
that is no GIF, or one whose header claims more than MOST_PIXELS decodes to no frames; a
damaged or cut one decodes to the frames and pixels before the damage, whatever its bytes;
very long payloads become many frames, so the pixel height stays below the format's limit;
repeated rows keep a row each with equal values; an empty table gives an empty result;
extra columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import struct
import zlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm import common

LARGEST = 4096
ROW_BYTES = 192
FRAME_ROWS = 512
FRAME_MS = 40
#: Pixels of a canvas or frame; a larger claim counts as damage, so memory stays bounded.
MOST_PIXELS = 1 << 26
#: Bytes of decoded frames that a worker holds before it hands them on.
HELD_BYTES = 1 << 24
BINS = 16


@dataclass
class Frame:
    """Indexed pixels (rows x columns) and how to show them."""

    pixels: np.ndarray
    left: int = 0
    top: int = 0
    delay_ms: int = 0
    disposal: int = 0
    transparent: int | None = None
    palette: np.ndarray | None = None
    interlaced: bool = False


@dataclass
class Shown:
    """A frame as shown: the whole canvas after drawing it, and its own rectangle."""

    canvas: np.ndarray
    visible: np.ndarray
    box: tuple[int, int, int, int]
    start_ms: int
    delay_ms: int
    extra: dict = field(default_factory=dict)


@functools.lru_cache(maxsize=16)
def _widths(min_size: int) -> np.ndarray:
    """Bits of the n-th code after a clear code: the reader's table is one entry behind."""
    first = (1 << min_size) + 2
    held = first + np.maximum(np.arange(LARGEST + 2) - 1, 0)
    return np.clip(np.floor(np.log2(held)).astype(np.int64) + 1, min_size + 1, 12)


def lzw_encode(data: bytes, min_size: int = 8) -> bytes:
    clear = 1 << min_size
    codes = [clear]
    starts = [1]
    put = codes.append
    if data:
        known: dict[int, int] = {}
        get = known.get
        free = clear + 2
        view = memoryview(data)
        prefix = view[0]
        for b in view[1:]:
            key = prefix << 8 | b
            code = get(key)
            if code is not None:
                prefix = code
                continue
            put(prefix)
            prefix = b
            if free < LARGEST:
                known[key] = free
                free += 1
            else:
                put(clear)
                starts.append(len(codes))
                known.clear()
                free = clear + 2
        put(prefix)
    put(clear + 1)
    codes = np.array(codes, dtype=np.uint32)
    place = np.arange(len(codes))
    since = np.zeros(len(codes), dtype=np.int64)
    since[np.array(starts)[np.array(starts) < len(codes)]] = 1
    since[0] = 1
    begin = np.maximum.accumulate(np.where(since > 0, place, 0))
    bits = _widths(min_size)[np.minimum(place - begin, LARGEST + 1)]
    at = np.cumsum(bits) - bits
    out = np.zeros(int(at[-1] + bits[-1]), dtype=np.uint8)
    for j in range(12):
        has = bits > j
        out[at[has] + j] = (codes[has] >> j) & 1
    return np.packbits(out, bitorder="little").tobytes()


def lzw_decode(data: bytes, min_size: int, n: int) -> bytes:
    """At most n pixels; a damaged stream gives what precedes the damage."""
    if not 1 <= min_size <= 8:
        return b""
    clear = 1 << min_size
    raw = np.frombuffer(data + b"\0\0\0", dtype=np.uint8).astype(np.uint32)
    n_bits = 8 * len(data)
    width = _widths(min_size)
    steps = np.cumsum(width) - width
    single = [bytes([i]) if i < clear else b"" for i in range(clear + 2)]
    out: list[bytes] = []
    table = list(single)
    previous, at, k, size = b"", 0, 0, 0
    while at < n_bits and size < n:
        first = steps[min(k, LARGEST)]
        if k <= LARGEST:
            offsets = at + steps[k : LARGEST + 1] - first
            bits = width[k : LARGEST + 1]
        else:
            offsets = at + 12 * np.arange(LARGEST)
            bits = np.full(LARGEST, 12)
        fits = offsets + bits <= n_bits
        offsets, bits = offsets[fits], bits[fits]
        if not len(offsets):
            break
        byte = offsets >> 3
        word = raw[byte] | raw[byte + 1] << 8 | raw[byte + 2] << 16
        codes = (word >> (offsets & 7)) & ((1 << bits) - 1)
        stops = np.flatnonzero((codes == clear) | (codes == clear + 1))
        end = int(stops[0]) if len(stops) else len(codes)
        for code in codes[:end].tolist():
            held = len(table)
            if not previous:
                if code >= clear:
                    return b"".join(out)[:n]
                entry = table[code]
            elif code < held:
                entry = table[code]
                if held < LARGEST:
                    table.append(previous + entry[:1])
            elif code == held and held < LARGEST:
                entry = previous + previous[:1]
                table.append(entry)
            else:
                return b"".join(out)[:n]
            out.append(entry)
            size += len(entry)
            previous = entry
        if not len(stops):
            k += end
            at = int(offsets[-1] + bits[-1])
            continue
        if codes[end] == clear + 1:
            break
        at = int(offsets[end] + bits[end])
        table, previous, k = list(single), b"", 0
    return b"".join(out)[:n]


def _blocks(data: bytes) -> bytes:
    return b"".join(bytes([len(data[i : i + 255])]) + data[i : i + 255] for i in range(0, len(data), 255)) + b"\0"


def _palette_bytes(palette: np.ndarray) -> tuple[bytes, int]:
    bits = max(1, int(len(palette) - 1).bit_length())
    full = np.zeros((1 << bits, 3), dtype=np.uint8)
    full[: len(palette)] = palette
    return full.tobytes(), bits - 1


def interlace_order(rows: int) -> np.ndarray:
    return np.concatenate([np.arange(0, rows, 8), np.arange(4, rows, 8), np.arange(2, rows, 4), np.arange(1, rows, 2)])


def encode_gif(frames: list[Frame], palette: np.ndarray, size: tuple[int, int] | None = None, background: int = 0, loops: int | None = None) -> bytes:
    """GIF89a bytes of indexed frames; size is (width, height) of the canvas."""
    width = size[0] if size else max(f.left + f.pixels.shape[1] for f in frames)
    height = size[1] if size else max(f.top + f.pixels.shape[0] for f in frames)
    table, bits = _palette_bytes(palette)
    out = [b"GIF89a", struct.pack("<HHBBB", width, height, 0x80 | 7 << 4 | bits, background, 0), table]
    if loops is not None:
        out.append(b"!\xff\x0bNETSCAPE2.0\x03\x01" + struct.pack("<H", loops) + b"\0")
    for f in frames:
        flags = f.disposal << 2 | (f.transparent is not None)
        out.append(struct.pack("<BBBBHBB", 0x21, 0xF9, 4, flags, f.delay_ms // 10, f.transparent or 0, 0))
        rows, columns = f.pixels.shape
        own, own_bits = _palette_bytes(f.palette) if f.palette is not None else (b"", 0)
        out.append(struct.pack("<BHHHHB", 0x2C, f.left, f.top, columns, rows, (0x80 | own_bits if own else 0) | 0x40 * f.interlaced) + own)
        pixels = f.pixels[interlace_order(rows)] if f.interlaced else f.pixels
        colours = len(f.palette if f.palette is not None else palette)
        min_size = max(2, int(colours - 1).bit_length())
        out.append(bytes([min_size]) + _blocks(lzw_encode(np.ascontiguousarray(pixels, dtype=np.uint8).tobytes(), min_size)))
    return b"".join(out) + b";"


def _read_blocks(data: bytes, at: int) -> tuple[bytes, int]:
    parts = []
    while at < len(data) and data[at]:
        parts.append(data[at + 1 : at + 1 + data[at]])
        at += 1 + data[at]
    return b"".join(parts), at + 1


def decode_gif(data: bytes | None):
    """Yield the composited frames (Shown) of a GIF; nothing if it is no GIF."""
    if not data or data[:6] not in (b"GIF87a", b"GIF89a") or len(data) < 13:
        return
    width, height, flags, background, _ = struct.unpack_from("<HHBBB", data, 6)
    if width * height > MOST_PIXELS:
        return
    at, common_palette = 13, None
    if flags & 0x80:
        n = 2 << (flags & 7)
        if len(data) < at + 3 * n:
            return
        common_palette = np.frombuffer(data, np.uint8, 3 * n, at).reshape(n, 3)
        at += 3 * n
    canvas = np.zeros((height, width, 3), dtype=np.uint8)
    visible = np.zeros((height, width), dtype=bool)
    delay = disposal = clock = 0
    transparent = None
    while at < len(data):
        mark = data[at]
        if mark == 0x21 and at + 1 < len(data):
            label = data[at + 1]
            body, at = _read_blocks(data, at + 2)
            if label == 0xF9 and len(body) >= 4:
                packed, ticks, index = struct.unpack_from("<BHB", body)
                delay, disposal = 10 * ticks, packed >> 2 & 7
                transparent = index if packed & 1 else None
            continue
        if mark != 0x2C or at + 10 >= len(data):
            break
        left, top, columns, rows, packed = struct.unpack_from("<HHHHB", data, at + 1)
        at += 10
        palette = common_palette
        if packed & 0x80:
            n = 2 << (packed & 7)
            if len(data) < at + 3 * n:
                break
            palette = np.frombuffer(data, np.uint8, 3 * n, at).reshape(n, 3)
            at += 3 * n
        if at >= len(data) or palette is None or columns * rows > MOST_PIXELS:
            break
        min_size = data[at]
        stream, at = _read_blocks(data, at + 1)
        pixels = lzw_decode(stream, min_size, columns * rows)
        known = len(pixels)
        index = np.frombuffer(pixels.ljust(columns * rows, b"\0"), np.uint8).reshape(rows, columns)
        drawn = (np.arange(columns * rows) < known).reshape(rows, columns)
        if packed & 0x40:
            back = np.argsort(interlace_order(rows))
            index, drawn = index[back], drawn[back]
        if transparent is not None:
            drawn = drawn & (index != transparent)
        full = np.zeros((256, 3), dtype=np.uint8)
        full[: len(palette)] = palette
        high, wide = max(0, min(rows, height - top)), max(0, min(columns, width - left))
        index, drawn = index[:high, :wide], drawn[:high, :wide]
        box = (slice(top, top + high), slice(left, left + wide))
        before = (canvas[box].copy(), visible[box].copy()) if disposal == 3 else None
        np.copyto(canvas[box], full[index], where=drawn[..., None])
        visible[box] |= drawn
        yield Shown(canvas, visible, (left, top, wide, high), clock, delay, {"disposal": disposal, "transparent": transparent})
        clock += delay
        if disposal == 2:
            canvas[box] = 0
            visible[box] = False
        elif before is not None:
            canvas[box], visible[box] = before
        delay = disposal = 0
        transparent = None


def histogram(pixels: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Counts of each channel's values in equal bins: 3 x bins."""
    flat = pixels.reshape(-1, 3)
    return np.stack([np.bincount(flat[:, c], minlength=256).reshape(bins, -1).sum(1) for c in range(3)])


HISTOGRAMS = ("hist_r", "hist_g", "hist_b")
FRAMES = "frame int, start_ms long, delay_ms long, width int, height int, left int, top int, n_visible long, rgb binary, hist_r array<long>, hist_g array<long>, hist_b array<long>"


def decode_frames(df: DataFrame, media_col: str, *keys: str) -> DataFrame:
    """A row for each timed frame of each GIF: the composited canvas as RGB bytes with a
    colour histogram for each channel.  ``keys`` are carried along.  A worker holds about
    HELD_BYTES of frames at a time."""
    names = [*keys, *(c.strip().split(" ")[0] for c in FRAMES.split(", "))]

    def run(batches):
        rows, held = [], 0
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                for i, s in enumerate(decode_gif(row[-1])):
                    h = histogram(s.canvas[s.visible])
                    rows.append((*row[: len(keys)], i, s.start_ms, s.delay_ms, s.canvas.shape[1], s.canvas.shape[0], s.box[0], s.box[1], int(s.visible.sum()), s.canvas.tobytes(), *(x.tolist() for x in h)))
                    held += s.canvas.nbytes
                    if held >= HELD_BYTES:
                        yield pd.DataFrame(rows, columns=names)
                        rows, held = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=names)

    types = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    return df.select(*keys, media_col).mapInPandas(run, f"{types}, {FRAMES}" if keys else FRAMES)


GREY = np.repeat(np.arange(256, dtype=np.uint8)[:, None], 3, axis=1)


def bytes_to_gif(payload: bytes) -> bytes:
    """Bytes as grey pixels, ROW_BYTES wide, in timed frames of at most FRAME_ROWS rows."""
    pixels = np.frombuffer(payload, np.uint8).reshape(-1, ROW_BYTES)
    frames = [Frame(pixels[i : i + FRAME_ROWS], delay_ms=FRAME_MS, disposal=1) for i in range(0, len(pixels), FRAME_ROWS)]
    return encode_gif(frames, GREY, (ROW_BYTES, min(len(pixels), FRAME_ROWS)))


def store_texts(batches):
    """Texts as GIF media: doc_id, n_bytes, media."""
    for batch in batches:
        texts = common.binary_texts(batch)
        media = [bytes_to_gif(t + b" " * (-len(t) % ROW_BYTES if t else ROW_BYTES)) for t in texts]
        yield pa.RecordBatch.from_arrays([*common.keep(batch, "doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])


FRAME_TYPE = pa.list_(pa.struct([("start_ms", pa.int64()), ("delay_ms", pa.int64()), ("width", pa.int32()), ("height", pa.int32()), ("n_visible", pa.int64()), *((h, pa.list_(pa.int64())) for h in HISTOGRAMS)]))
READ = {
    "payload_bytes": (pa.int64(), "long"), "payload_sha256": (pa.string(), "string"), "tail_crc32": (pa.int64(), "long"), "media_bytes": (pa.int64(), "long"), "media_sha256": (pa.string(), "string"), "feature": (pa.string(), "string"), "n_frames": (pa.int64(), "long"), "duration_ms": (pa.int64(), "long"),
    "frames": (FRAME_TYPE, "array<struct<start_ms:long,delay_ms:long,width:int,height:int,n_visible:long,hist_r:array<long>,hist_g:array<long>,hist_b:array<long>>>"),
}


def read_media(batches):
    """Decode stored media, recover the payload from the shown pixels, and describe its
    timed frames."""
    for batch in batches:
        out: list[list] = [[] for _ in READ]
        for media in common.keep(batch, "media")[0].to_pylist():
            parts, frames = [], []
            for s in decode_gif(media):
                left, top, wide, high = s.box
                shown = s.canvas[top : top + high, left : left + wide]
                parts.append(np.ascontiguousarray(shown[..., 0]).tobytes())
                frames.append({"start_ms": s.start_ms, "delay_ms": s.delay_ms, "width": wide, "height": high, "n_visible": int(s.visible.sum()), **dict(zip(HISTOGRAMS, histogram(shown).tolist()))})
            payload = b"".join(parts)
            grey = np.sum([f["hist_r"] for f in frames], axis=0) if frames else np.zeros(BINS, np.int64)
            share = (grey * 255 // max(1, grey.sum())).astype(np.uint8).tobytes().hex()
            values = (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(media), hashlib.sha256(media).hexdigest(), f"{share}-{len(frames)}", len(frames), sum(f["delay_ms"] for f in frames), frames)
            for column, value in zip(out, values):
                column.append(value)
        yield pa.RecordBatch.from_arrays([*common.keep(batch, "doc_id", "n_bytes"), *(pa.array(x, t) for x, (t, _) in zip(out, READ.values()))], names=["doc_id", "n_bytes", *READ])


def texts_as_media(docs: DataFrame) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(store_texts, f"doc_id {kind}, n_bytes long, media binary")


def op1_gif(spark, sf_dir: str) -> DataFrame:
    media = common.store(texts_as_media(common.table(spark, sf_dir, "documents")), "media")
    kind = media.schema["doc_id"].dataType.simpleString()
    return media.mapInArrow(read_media, f"doc_id {kind}, n_bytes long, " + ", ".join(f"{n} {t}" for n, (_, t) in READ.items()))
