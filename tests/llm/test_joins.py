import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from tessera.llm import common, decontamination as D, jaccard as J, kneser_ney as K
from tests.llm.conftest import ODD
from tests.llm.plain import KneserNey


def near_copies(seed, n=120):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = [rng.choice(words) for _ in range(40)]
    rows = []
    for i in range(n):
        base = [rng.choice(words) for _ in range(rng.choice([2, 5, 30, 80, 200]))]
        if i % 3 == 0:
            base += passage
        for _ in range(rng.choice([1, 1, 2, 6])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((len(rows), " ".join(copy)))
    return rows


def brute(rows, k, percent):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = frozenset([tuple(w)] if 0 < len(w) < k else [tuple(w[j : j + k]) for j in range(len(w) - k + 1)])
    up = {i: i for i in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                p, q = sorted((find(a), find(b)))
                up[q] = p
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80)])
def test_components_match_brute_force(make, k, percent):
    rows = near_copies(k)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.jaccard_components(make(rows), k, percent).collect()}
    assert got == brute(rows, k, percent)


def test_large_family_in_chunks(make, monkeypatch):
    monkeypatch.setattr(J, "CELL_DOCS", 12)
    monkeypatch.setattr(J, "SIDE_DOCS", 12)
    rows = near_copies(9, 12)
    rng = random.Random(5)
    base = [f"v{i}" for i in range(150)]
    for _ in range(90):
        copy = list(base)
        for _ in range(rng.choice([0, 1, 2, 3])):
            copy[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
        rows.append((len(rows), " ".join(copy)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.jaccard_components(make(rows), 3, 90).collect()}
    assert got == brute(rows, 3, 90)


def test_join_of_odd_documents(make):
    rows = J.jaccard_components(make(ODD), 3, 90).collect()
    assert len(rows) == len(ODD)
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append((r.n_shingles, r.component_id))
    assert by[1] == by[2][:0] + [(0, 1)] and by[2] == [(0, 2)] and by[6] == [(2, 5), (2, 5)] and by[5] == [(2, 5)]
    assert J.jaccard_components(make([]), 3, 90).count() == 0


def test_signature_tree_against_all_pairs():
    rng = np.random.default_rng(1)
    sets = []
    for _ in range(60):
        base = rng.integers(0, 2**63, 80).astype(np.uint64)
        for _ in range(2):
            s = base.copy()
            s[: rng.integers(0, 12)] = rng.integers(0, 2**63, 1)[0]
            sets.append(np.unique(s))
    union = J.Union(len(sets))
    J.tree_links(sets, 90, union, list(range(len(sets))))
    plain = J.Union(len(sets))
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 90 * (len(sets[i]) + len(sets[j]) - both):
                plain.join(i, j)
    assert [union.find(i) for i in range(len(sets))] == [plain.find(i) for i in range(len(sets))]


def test_size_windows_hold_every_linkable_pair():
    for percent in (80, 90):
        w = J.SizeWindows(percent)
        at = {n: {x[0]: x for x in w.windows(n)} for n in range(1, 400)}
        for a in range(1, 400):
            for b in range(a, 400):
                if 100 * a >= percent * b:
                    shared = set(at[a]) & set(at[b])
                    assert shared
                    need = -(-percent * (a + b) // (100 + percent))
                    for x in shared:
                        assert at[a][x] == at[b][x] and at[a][x][1] - at[a][x][2] > a + b - 2 * need


def test_graph_components(spark):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100 + rng.randrange(50), 100 + rng.randrange(50)) for _ in range(40)]
    up = {x: x for e in edges for x in e}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        p, q = sorted((find(a), find(b)))
        up[q] = p
    got = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in up if any(x in e and e[0] != e[1] for e in edges)}


def hits(rows, items):
    windows = defaultdict(set)
    for i, t in items:
        w = D.words_of((t or "").encode())
        n = min(10, len(w))
        for j in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[j : j + n])].add(i)
    out = []
    for d, t in rows:
        w = D.words_of((t or "").encode())
        hit, which = set(), set()
        for n in {len(x) for x in windows}:
            for j in range(len(w) - n + 1):
                if found := windows.get(tuple(w[j : j + n])):
                    hit |= set(range(j, j + n))
                    which |= found
        out.append((d, len(w), len(hit), ",".join(sorted(map(str, which)))))
    return sorted(out, key=str)


def test_winnowing_matches_brute_force(spark, make):
    rng = random.Random(2)
    words = [f"t{i}" for i in range(60)] + ["Éa", "x-y", "9"]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 3, 9, 10, 11, 40])))) for i in range(30)] + [(90, None), (91, "..."), (3, "dup item text")]
    rows = list(ODD)
    for i in range(100, 220):
        w = rng.choices(words, k=60)
        source = rng.choice(items)[1] or ""
        part = source.split()
        a = rng.randrange(max(1, len(part)))
        rows.append((i, " ".join(w[:30] + part[a : a + rng.choice([5, 9, 10, 25])] + w[30:]).upper()))
    found = D.contamination(make(rows), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(((r.doc_id, r.n_words, r.n_hit, ",".join(r["items"])) for r in found.collect()), key=str) == hits(rows, items)
    empty = D.contamination(make(rows), spark.createDataFrame([], "item_id long, text string"))
    assert empty.filter("n_hit > 0").isEmpty() and D.contamination(make([]), spark.createDataFrame(items, "item_id long, text string")).count() == 0


def test_winnow_guarantee():
    rng = np.random.default_rng(0)
    for _ in range(50):
        h = rng.integers(0, 8, 40).astype(np.uint64)
        kept = set(D.winnow(h, 4).tolist())
        assert all(kept & set(range(i, i + 4)) for i in range(37))


@pytest.mark.parametrize("shard_bytes", [K.SHARD_BYTES, 800])
def test_kneser_ney_sums_to_one_and_matches(make, monkeypatch, shard_bytes):
    monkeypatch.setattr(K, "SHARD_BYTES", shard_bytes)  # with many shards, frequent words are split
    rng = random.Random(6)
    words = [f"k{min(int(rng.expovariate(0.15)), 40)}" for _ in range(6000)]
    rows = [(i, " ".join(words[i * 40 : i * 40 + 40])) for i in range(150)] + [(None if i is None else i + 1000, t) for i, t in ODD if i != 6]
    docs = make(rows).selectExpr("*", "doc_id is null or doc_id % 7 = 2 as held_out")
    model = K.train(docs.filter("not held_out").select("text"))
    assert (model["parts"].max() > 1) == (shard_bytes == 800)
    want = KneserNey([t for i, t in rows if i is not None and i % 7 != 2])
    for u, v in ((b"k1", b"k2"), (b"never", b"k2"), (b"k0", b"never")):
        assert sum(want.p(u, v, w) for w in want.raw) + want.p(u, v, b"unseen") == pytest.approx(1)
    for r in K.score(docs, model).collect():
        got = (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)
        assert got == pytest.approx(want.row(next(t for i, t in rows if i == r.doc_id)))


def test_kneser_ney_of_empty_tables_and_lost_files(make):
    import os

    docs = make(ODD).selectExpr("*", "false as held_out")
    model = K.train(docs.select("text"))
    assert K.score(docs.limit(0), model).count() == 0
    name = next(f"trigrams-{i}" for i, n in enumerate(model["files"]["trigrams"]) if n)
    path = f"{K.Folder(model['uri']).path}/{name}"
    with open(path, "r+b") as file:
        file.truncate(os.path.getsize(path) - 8)
    with pytest.raises(Exception, match="manifest"):
        K.score(docs, model).collect()
    os.remove(path)
    with pytest.raises(Exception, match="No such file"):
        K.score(docs, model).collect()


def test_kneser_ney_without_training_rows(make):
    docs = make(ODD).selectExpr("*", "true as held_out")
    rows = K.score(docs, K.train(docs.filter("not held_out").select("text"))).collect()
    assert len(rows) == len(ODD) and all(r.score == 0 and r.n_known == 0 for r in rows)
    assert hashlib.sha256(b"").hexdigest()


def test_parity_sketches_never_part_linked_sets():
    rng = np.random.default_rng(5)
    draw = lambda n: np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
    for percent in (80, 90):
        for n in (1, 3, 9, 40, 130, 600, 5000, 20000):
            a = draw(n)
            b = np.unique(np.r_[a[: -(n * (100 - percent) // 100) or None], draw(n * (100 - percent) // 300)])
            linked = 100 * len(np.intersect1d(a, b)) >= percent * len(np.union1d(a, b))
            x, y = J.parity(a), J.parity(b)
            assert J.distance(x, y) == J.distance(y, x) <= len(np.setxor1d(a, b))
            assert not linked or J.related(percent, len(a), x, len(b), y)
            if n >= 130:
                other = draw(n)
                assert not J.related(percent, n, x, n, J.parity(other)) or n == 20000
                assert not J.behind(percent, n, x, n, J.parity(other))


def test_unrelated_documents_that_share_a_part_make_no_family(spark):
    rng = np.random.default_rng(6)
    sets = [rng.integers(0, 2**64, 300, dtype=np.uint64) for _ in range(4)]
    sets.append(np.r_[sets[0][:290], sets[1][:5]])  # a near copy of the first
    row = lambda i, s, keys: (i, 100 + i, len(s), bytearray(J.parity(s)), keys, [])
    rows = [row(i, s, [1] if i != 1 else [1, 2]) for i, s in enumerate(sets)]
    rows += [row(10 + i, rng.integers(0, 2**64, 300, dtype=np.uint64), [3]) for i in range(9)]  # too many to test
    full = spark.createDataFrame(rows, "_row long, print long, n_shingles long, sketch binary, keys array<long>, met array<long>")
    found = {tuple(sorted(r)) for r in J._shared(full, 80).collect()}
    assert found == {(100, 104)} | {(110, 110 + i) for i in range(1, 9)}


def test_a_task_passes_on_the_hashes_of_unlike_sets():
    rng = np.random.default_rng(7)
    sets = [rng.integers(0, 2**64, 300, dtype=np.uint64) for _ in range(20)]
    met = J.Met(80)
    prints = list(range(1, 21))
    met.learn(prints, [300] * 20, [J.parity(s) for s in sets])
    new = np.concatenate([met.sort_out(np.full(5, 9, np.uint64), np.array(prints[i : i + 5]))[0] for i in range(0, 20, 5)])
    assert new.sum() == J.PASSED > J.TESTED and new[: J.PASSED].all()
    again, held = met.sort_out(np.array([8, 8], np.uint64), np.array([1, 1]))
    assert again.tolist() == [True, False] and held.tolist() == [1, 1]
