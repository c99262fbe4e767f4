"""Sharding over fixed virtual slots.

Records hash into thousands of virtual slots.  Bytes are aggregated per slot, and a stored,
versioned slot-to-shard map says where each slot lives.  Version 0 deals slots round robin;
every later version is an edit of the stored one before: single slots move from the fullest
shard to the emptiest until moving one more would not help, so all others stay where they
are.  A slot that holds far more than its share (one record repeated without end) is cut
into pieces by row, which move on their own; the map knows into how many pieces a slot is
cut.  Rows are placed by the version that is read back from the store.

Edge cases: a null text has 0 bytes, a null id hashes like any value, repeated rows keep a
row each (they share a slot, or a slot's pieces), ties of size are broken by slot and shard
number, an empty table gives an empty result, and the other columns of the input are not
read, so they may bear any name.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window, functions as F

from tessera.llm import common

SLOTS = 8192
#: Pieces of a slot are about this share of a shard's mean size.
PIECE_SHARE = 1 / 64


@dataclass
class SlotMap:
    """All versions of the slot-to-shard map; a version is {piece: shard}."""

    n_shards: int
    versions: list[dict] = field(default_factory=list)

    @classmethod
    def initial(cls, pieces: list, n_shards: int) -> "SlotMap":
        return cls(n_shards, [{p: i % n_shards for i, p in enumerate(sorted(pieces))}])

    @property
    def current(self) -> dict:
        return self.versions[-1]

    def grow(self, n_shards: int) -> None:
        """More (empty) shards; the next rebalance moves slots into them."""
        self.n_shards = max(self.n_shards, n_shards)

    def rebalance(self, sizes: dict, cuts: dict[int, int] | None = None) -> int:
        """Append a version in which slots of ``cuts`` have at least so many pieces, and slots
        have moved from full shards to empty ones until no single move narrows the gap.
        Returns the number of moved pieces."""
        owner = self._with_pieces(cuts or {})
        held: list[list] = [[] for _ in range(self.n_shards)]
        load = [0] * self.n_shards
        for piece, shard in owner.items():
            size = sizes.get(piece, 0)
            load[shard] += size
            if size:
                held[shard].append((size, piece))
        for shard in held:
            shard.sort()
        moved = 0
        light = [(load[s], s) for s in range(self.n_shards)]
        heavy = [(-load[s], s) for s in range(self.n_shards)]
        heapq.heapify(light)
        heapq.heapify(heavy)
        while True:
            while light and light[0][0] != load[light[0][1]]:
                heapq.heappop(light)
            while heavy and -heavy[0][0] != load[heavy[0][1]]:
                heapq.heappop(heavy)
            if not light or not heavy:
                break
            low, high = light[0][1], heavy[0][1]
            gap = load[high] - load[low]
            at = self._best(held[high], gap)
            if at is None:
                break
            size, piece = held[high].pop(at)
            self._insert(held[low], (size, piece))
            owner[piece] = low
            load[high] -= size
            load[low] += size
            for s in (low, high):
                heapq.heappush(light, (load[s], s))
                heapq.heappush(heavy, (-load[s], s))
            moved += 1
        self.versions.append(owner)
        return moved

    @staticmethod
    def _insert(items: list, item: tuple) -> None:
        import bisect

        bisect.insort(items, item)

    @staticmethod
    def _best(items: list, gap: int):
        """The piece whose size is nearest to half the gap, if moving it helps."""
        import bisect

        i = bisect.bisect_right(items, (gap // 2, (float("inf"),)))
        found = [j for j in (i - 1, i) if 0 <= j < len(items) and 0 < items[j][0] < gap]
        return min(found, key=lambda j: abs(2 * items[j][0] - gap), default=None)

    def _with_pieces(self, cuts: dict[int, int]) -> dict:
        """The current version with at least so many pieces of each slot; a new piece starts
        in the shard that holds the fewest."""
        owner = dict(self.current)
        held = [0] * self.n_shards
        for to in owner.values():
            held[to] += 1
        free = [(n, to) for to, n in enumerate(held)]
        heapq.heapify(free)
        for slot in sorted(cuts):
            for cut in range(cuts[slot]):
                if (slot, cut) not in owner:
                    n, to = heapq.heappop(free)
                    owner[(slot, cut)] = to
                    heapq.heappush(free, (n + 1, to))
        return owner

    def cuts(self) -> dict[int, int]:
        """Pieces of each slot in the current version."""
        out: dict[int, int] = {}
        for slot, cut in self.current:
            out[slot] = max(out.get(slot, 0), cut + 1)
        return out


MAP_SCHEMA = "vslot int, cut int, shard int"


def save_version(spark, slot_map: SlotMap, path: str, version: int | None = None) -> None:
    """Write one version (the current one) beside those stored before."""
    version = len(slot_map.versions) - 1 if version is None else version
    rows = [(slot, cut, to) for (slot, cut), to in sorted(slot_map.versions[version].items())]
    spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/version={version}")


def load_map(spark, path: str, n_shards: int) -> SlotMap:
    """A version has a row for each slot and at most n_shards / PIECE_SHARE further pieces."""
    versions: dict[int, dict] = {}
    for r in spark.read.parquet(path).select("version", "vslot", "cut", "shard").collect():
        versions.setdefault(r.version, {})[(r.vslot, r.cut)] = r.shard
    return SlotMap(n_shards, [versions[v] for v in sorted(versions)])


def new_map(spark, path: str, n_shards: int, slots: int = SLOTS) -> None:
    """Store version 0: every slot, whole, dealt round robin."""
    save_version(spark, SlotMap.initial([(s, 0) for s in range(slots)], n_shards), path)


def shard(docs: DataFrame, n_shards: int, path: str, id_col: str = "doc_id", text_col: str = "text", overhead: int = 16, slots: int = SLOTS) -> DataFrame:
    """Place every row by the map stored at ``path``, after adding a version in which shard
    sizes (UTF-8 bytes plus ``overhead``) are nearly equal.  Rows: id, size, text_crc32,
    vslot, shard, slot (the row's place in its shard, gapless from 0), version."""
    spark = docs.sparkSession
    utf8 = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col), (F.octet_length(utf8) + F.lit(overhead)).cast("long").alias("size"), F.crc32(utf8).alias("text_crc32"))
    rows = rows.withColumn("vslot", F.pmod(F.xxhash64(F.col(id_col), F.col("text_crc32"), F.col("size")), F.lit(slots)).cast("int"))
    rows = common.store(rows.withColumn("_row", F.monotonically_increasing_id()), "slots")
    held = {r.vslot: r.bytes for r in rows.groupBy("vslot").agg(F.sum("size").alias("bytes")).collect()}  # a row a slot
    piece = max(1, int(sum(held.values()) / max(1, n_shards) * PIECE_SHARE))
    slot_map = load_map(spark, path, n_shards)
    known = slot_map.cuts()
    # A slot is cut only where it holds two pieces' bytes or more, and never joined again.
    cuts = {slot: max(known.get(slot, 1), size // piece) for slot, size in held.items()}
    many = [(slot, n) for slot, n in sorted((known | cuts).items()) if n > 1]
    if many:
        cut_rows = F.broadcast(spark.createDataFrame(many, "vslot int, _cuts int"))  # a row a slot at most
        rows = rows.join(cut_rows, "vslot", "left").withColumn("cut", F.coalesce(F.pmod(F.xxhash64("_row"), "_cuts"), F.lit(0)).cast("int")).drop("_cuts")
    else:
        rows = rows.withColumn("cut", F.lit(0))
    # At most `slots` rows plus n_shards / PIECE_SHARE rows reach the driver.
    cells = rows.groupBy("vslot", "cut").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()
    slot_map.rebalance({(c.vslot, c.cut): c.bytes for c in cells}, cuts)
    version = len(slot_map.versions) - 1
    save_version(spark, slot_map, path)
    stored = load_map(spark, path, n_shards).current
    base, upto = [], [0] * n_shards
    for c in sorted(cells, key=lambda c: (c.vslot, c.cut)):
        to = stored[(c.vslot, c.cut)]
        base.append((c.vslot, c.cut, to, upto[to]))
        upto[to] += c.n
    plan = spark.createDataFrame(base, "vslot int, cut int, shard int, _base long")
    placed = Window.partitionBy("vslot", "cut").orderBy(F.col(id_col).asc_nulls_first(), "text_crc32", "size", "_row")
    out = rows.withColumn("_n", F.row_number().over(placed)).join(F.broadcast(plan), ["vslot", "cut"])
    return out.select(id_col, "size", "text_crc32", "vslot", "shard", (F.col("_base") + F.col("_n") - 1).cast("long").alias("slot"), F.lit(version).alias("version"))


def op6_virtual_slots(spark, sf_dir: str) -> DataFrame:
    """All documents over shards 0 to 39 under the `bytes` law."""
    path = common.fresh_path(spark, "slot-map")
    new_map(spark, path, 40)
    rows = shard(common.table(spark, sf_dir, "documents"), 40, path)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "vslot", F.col("version").alias("map_version"))
