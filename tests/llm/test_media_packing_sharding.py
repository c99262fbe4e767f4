import hashlib
import random
import zlib

import numpy as np
import pytest

from tessera.llm import gif, packing, sharding
from tests.llm.conftest import ODD


@pytest.mark.parametrize("data", [b"", b"a", b"abab" * 5000, bytes(range(256)) * 40, random.Random(1).randbytes(30000)])
def test_lzw_round_trip(data):
    assert gif.lzw_decode(gif.lzw_encode(data), 8, len(data)) == data


def test_lzw_small_codes():
    data = bytes(random.Random(2).choices(range(4), k=9000))
    assert gif.lzw_decode(gif.lzw_encode(data, 2), 2, len(data)) == data
    assert gif.lzw_decode(gif.lzw_encode(data, 2)[:40], 2, len(data)) == data[: len(gif.lzw_decode(gif.lzw_encode(data, 2)[:40], 2, len(data)))]


def test_frames_disposal_transparency_interlace():
    palette = np.array([[0, 0, 0], [255, 0, 0], [0, 255, 0], [0, 0, 255]], dtype=np.uint8)
    whole = np.ones((8, 8), dtype=np.uint8)
    patch = np.array([[2, 3], [3, 2]], dtype=np.uint8)
    frames = [
        gif.Frame(whole, delay_ms=100, disposal=1), gif.Frame(patch, 2, 2, 50, disposal=3, transparent=3), gif.Frame(patch, 4, 4, 20, disposal=2), gif.Frame(np.arange(16, dtype=np.uint8).reshape(8, 2) % 4, 0, 0, 10, interlaced=True),
        gif.Frame(np.zeros((1, 1), np.uint8), 7, 7, palette=np.array([[9, 8, 7], [1, 1, 1]], dtype=np.uint8)),
    ]
    shown = [(s.canvas.copy(), s.visible.copy(), s.start_ms) for s in gif.decode_gif(gif.encode_gif(frames, palette, (8, 8), loops=0))]
    assert [t for *_, t in shown] == [0, 100, 150, 170, 180]
    assert (shown[0][0] == palette[1]).all()
    assert (shown[1][0][2, 2] == palette[2]).all() and (shown[1][0][2, 3] == palette[1]).all()
    assert (shown[2][0][2, 2] == palette[1]).all() and (shown[2][0][4, 5] == palette[3]).all()
    assert not shown[3][1][5, 5] and (shown[3][0][:, :2] == palette[(np.arange(16) % 4).reshape(8, 2)]).all()
    assert (shown[4][0][7, 7] == [9, 8, 7]).all()


def test_broken_gifs():
    good = gif.bytes_to_gif(b"x" * 192 * 5)
    assert list(gif.decode_gif(None)) == [] and list(gif.decode_gif(b"PNG")) == []
    for cut in range(0, len(good), 37):
        list(gif.decode_gif(good[:cut]))


def test_media_of_odd_documents(make):
    docs = make(ODD)
    rows = gif.texts_as_media(docs).mapInArrow(gif.read_media, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_frames long, duration_ms long").collect()
    assert len(rows) == len(ODD)
    want = sorted((len(b), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:])) for b, p in ((b, b + b" " * (-len(b) % 192 if b else 192)) for b in ((t or "").encode() for _, t in ODD)))
    assert sorted((r.n_bytes, r.payload_sha256, r.tail_crc32) for r in rows) == want
    assert len({r.media_sha256 for r in rows if r.doc_id in (5, 6)}) == 1


def test_frame_rows(make):
    media = gif.texts_as_media(make(ODD))
    rows = gif.decode_frames(media, "media", "doc_id").collect()
    long = [r for r in rows if r.doc_id == 7]
    assert len(long) == -(-150144 // (192 * 512)) and all(sum(r.hist_r) == r.n_visible for r in rows)


def test_differencing_is_a_partition():
    sizes = np.random.default_rng(3).integers(1, 700, 300)
    part, total = packing.differencing(sizes, 37)
    assert np.bincount(part, sizes, 37).tolist() == total.tolist() and total.max() - total.min() < 60
    assert np.bincount(packing.pack_sizes(sizes, 2048), sizes).max() <= 2048
    assert packing.pack_sizes(np.array([5]), 8).tolist() == [0]
    assert len(set(packing.pack_sizes(np.array([6, 6, 6]), 8).tolist())) == 3


def test_ids_equal_the_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    plain, words, rng = Tokenizer.from_file(path), packing.WordIds(path, 500), random.Random(4)
    letters = "abcXYZ'’sStT09_.,!?<|> ÄÖßéÉñçŒŸÿİı  \t\n\x1c\x1f  ά漢字かБΣς😀-*%" + " " * 8
    for _ in range(3000):
        text = "".join(rng.choices(letters, k=rng.randint(0, 30))) + rng.choice(["", " don't it'S", " <|endoftext|>"])
        assert np.frombuffer(next(words.encode_all([text], b"")), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_packing_of_odd_documents(spark, make):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    rows = packing.pack(make(ODD), path).collect()
    assert sum(r.length for r in rows) == sum(len(Tokenizer.from_file(path).encode(t or "", add_special_tokens=False).ids) + 1 for _, t in ODD)
    held: dict = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in held.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack(make([]), path).count() == 0


def shards_of(spark, docs, n, path):
    sharding.new_map(spark, path, n)
    return sharding.shard(docs, n, path)


def test_sharding_of_odd_documents(spark, make, tmp_path):
    docs = make([x for x in ODD if x[0] != 7] * 3 + [(i, "w " * (i % 50)) for i in range(100, 900)] + [(77, "hot one")] * 400)
    got = shards_of(spark, docs, 4, f"{tmp_path}/map").collect()
    assert len(got) == docs.count()
    load: dict = {}
    for r in got:
        load.setdefault(r.shard, []).append(r)
    sizes = [sum(r.size for r in v) for v in load.values()]
    assert all(sorted(r.slot for r in v) == list(range(len(v))) for v in load.values())
    assert max(sizes) < 1.1 * min(sizes)
    stored = sharding.load_map(spark, f"{tmp_path}/map", 4)
    assert len(stored.versions) == 2 and max(stored.cuts().values()) > 1  # the repeated record is cut
    whole = {s: to for (s, cut), to in stored.current.items() if stored.cuts()[s] == 1}
    assert all(whole.get(r.vslot, r.shard) == r.shard for r in got)
    assert shards_of(spark, make([]), 4, f"{tmp_path}/empty").count() == 0


def test_growth_edits_the_stored_map(spark, make, tmp_path):
    rows = [(i, "w " * (i % 50)) for i in range(3000)]
    first = {r.doc_id: r.shard for r in shards_of(spark, make(rows), 4, f"{tmp_path}/map").collect()}
    more = sharding.shard(make(rows + [(i, "new") for i in range(3000, 3300)]), 5, f"{tmp_path}/map").collect()
    assert {r.version for r in more} == {2} and {r.shard for r in more} == set(range(5))
    moved = [r for r in more if r.doc_id in first and first[r.doc_id] != r.shard]
    assert len(moved) < 0.35 * len(rows) and sum(r.shard == 4 for r in moved) > 0.6 * len(moved)
    sizes = [sum(r.size for r in more if r.shard == s) for s in range(5)]
    assert max(sizes) - min(sizes) < 0.02 * max(sizes)


def test_slot_map_versions(spark, tmp_path):
    sizes = {(i, 0): 10 + i % 7 for i in range(400)}
    m = sharding.SlotMap.initial(list(sizes), 4)
    m.rebalance(sizes)
    before = dict(m.current)
    m.grow(5)
    moved = m.rebalance(sizes)
    load = [sum(sizes[p] for p, s in m.current.items() if s == k) for k in range(5)]
    assert max(load) - min(load) <= 16 and moved < 400 * 0.35
    assert sum(before[p] != s and s != 4 for p, s in m.current.items()) <= moved // 2
    for version in range(3):
        sharding.save_version(spark, m, f"{tmp_path}/map", version)
    assert sharding.load_map(spark, f"{tmp_path}/map", 5).versions == m.versions


def test_damaged_gifs_decode_to_what_precedes_the_damage():
    rng = random.Random(9)
    good = gif.bytes_to_gif(bytes(rng.choices(range(97, 123), k=192 * 40)))
    want = next(gif.decode_gif(good)).canvas.copy()
    for _ in range(300):
        bad = bytearray(good)
        for _ in range(rng.choice([1, 1, 3, 20])):
            bad[rng.randrange(6, len(bad))] = rng.randrange(256)
        for s in gif.decode_gif(bytes(bad)):
            assert s.canvas.shape[0] * s.canvas.shape[1] <= gif.MOST_PIXELS
    head = len(good) - len(good[good.index(b",\0\0\0\0") :])
    for size in (0, 9, 12, 255):
        bad = bytearray(good)
        bad[head + 10] = size
        assert all(not s.visible.any() for s in gif.decode_gif(bytes(bad)))
    huge = bytearray(good)
    huge[6:10] = b"\xff\xff\xff\xff"
    assert list(gif.decode_gif(bytes(huge))) == [] and want.shape == (40, 192, 3)
    assert [list(gif.decode_gif(rng.randbytes(60))) for _ in range(50)] == [[]] * 50
