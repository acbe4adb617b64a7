"""Sharding over fixed virtual slots.

Every record is hashed into one of ``slots`` virtual slots; bytes and rows are summed per slot; a versioned table maps slots to shards.
Version 0 deals the slots round. Rebalancing makes the next version by moving or swapping slots between the fullest and the emptiest
shard until that helps no more; adding a shard moves slots into the new shard only. A slot that alone holds a good part of a shard is
split into ``subs`` sub-slots, so that even one record repeated in a third of all rows is spread.

The planner sees sums of at most ``slots * subs`` slots, never rows. The rows are shuffled once, as ids and sizes without their text.

Defined cases: NULL text has size 1 and the checksum of the empty text; NULL and repeated ids are allowed, each row is placed once;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskmart.session import staged

SLOTS, SUBS = 4096, 16


def dealt(slots: int, shards: int) -> list[int]:
    """Version 0 of the map: slots in turn."""
    return [s % shards for s in range(slots)]


def _improve(fat: list[tuple[int, int]], thin: list[tuple[int, int]], gap: int):
    """The move or swap (units of the fat shard, of the thin one or None) that brings the two nearest to each other."""
    best, what = gap, None
    light = sorted((w, u) for u, w in thin)
    values = [w for w, _ in light]
    from bisect import bisect_left

    for u, w in fat:
        if 0 < w and abs(gap - 2 * w) < best:
            best, what = abs(gap - 2 * w), (u, None)
        at = bisect_left(values, w - gap // 2)
        for k in (at - 1, at):
            if 0 <= k < len(light) and 0 < w - values[k] and abs(gap - 2 * (w - values[k])) < best:
                best, what = abs(gap - 2 * (w - values[k])), (u, light[k][1])
    return what


def rebalanced(owner: dict[int, int], weight: dict[int, int], shards: int, most: int = 20_000) -> dict[int, int]:
    """The next version of the map: edits of ``owner`` that even out the weights. Units without an owner go to the emptiest shard first."""
    owner = dict(owner)
    held: list[dict[int, int]] = [{} for _ in range(shards)]
    for u, s in owner.items():
        held[s][u] = weight.get(u, 0)
    load = [sum(h.values()) for h in held]

    def give(u: int, s: int, w: int) -> None:
        owner[u] = s
        held[s][u] = w
        load[s] += w

    for w, u in sorted(((w, u) for u, w in weight.items() if u not in owner), reverse=True):
        give(u, load.index(min(load)), w)
    for _ in range(most):
        a, b = load.index(max(load)), load.index(min(load))
        what = _improve(list(held[a].items()), list(held[b].items()), load[a] - load[b])
        if what is None:
            break
        u, v = what
        w = held[a].pop(u)
        load[a] -= w
        if v is not None:
            x = held[b].pop(v)
            load[b] -= x
            give(v, a, x)
        give(u, b, w)
    return owner


def grown(owner: Sequence[int], shards: int) -> list[int]:
    """The map with one more shard: an even share of every shard's slots goes to the new one, the rest stay."""
    out, seen = list(owner), [0] * shards
    for slot, s in enumerate(owner):
        seen[s] += 1
        if seen[s] % (shards + 1) == 0:
            out[slot] = shards
    return out


def _lookup(slot: Column, sub: Column, by_slot: list[int], by_unit: dict[int, int]) -> Column:
    plain = F.element_at(F.lit(by_slot), slot.cast("int") + 1)
    if not by_unit:
        return plain
    split = F.create_map(*[F.lit(v) for k in sorted(by_unit) for v in (k, by_unit[k])])
    return F.coalesce(F.try_element_at(split, (slot * SUBS + sub).cast("int")), plain)


def slotted(documents: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot and sub, staged so that the text is read once."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select("doc_id", (F.octet_length(text) + F.lit(1)).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return staged(rows.select(
        "*", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(slots)).cast("int").alias("virtual_slot"),
        F.pmod(F.monotonically_increasing_id(), F.lit(SUBS)).cast("int").alias("sub")), "slots")


def slot_map(rows: DataFrame, shards: int, slots: int = SLOTS) -> DataFrame:
    """The stored map: version, virtual_slot, sub, shard, bytes, rows and ``before`` (rows of the shard in earlier slots), versions 0 and 1."""
    sums = staged(rows.groupBy("virtual_slot", "sub").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")), "slot-sums")
    got = sums.collect()  # at most slots * SUBS rows, whatever the input
    total: dict[int, int] = {}
    for r in got:
        total[r["virtual_slot"]] = total.get(r["virtual_slot"], 0) + r["bytes"]
    hot = {s for s, b in total.items() if b * shards * 32 > max(sum(total.values()), 1) and len(got) > len(total)}
    first = dealt(slots, shards)
    # a whole slot is unit -1 - slot, a sub-slot of a hot slot is slot * SUBS + sub
    weight = {-1 - s: b for s, b in total.items() if s not in hot}
    weight |= {r["virtual_slot"] * SUBS + r["sub"]: r["bytes"] for r in got if r["virtual_slot"] in hot}
    after = rebalanced({-1 - s: first[s] for s in range(slots) if s not in hot}, weight, shards)
    second = [after.get(-1 - s, first[s]) for s in range(slots)]
    versions = [(0, first, {}), (1, second, {u: s for u, s in after.items() if u >= 0})]
    table = None
    for version, by_slot, by_unit in versions:
        part = sums.select(F.lit(version).alias("version"), "virtual_slot", "sub",
                           _lookup(F.col("virtual_slot"), F.col("sub"), by_slot, by_unit).alias("shard"), "bytes", "rows")
        table = part if table is None else table.unionByName(part)
    ahead = Window.partitionBy("version", "shard").orderBy("virtual_slot", "sub").rowsBetween(Window.unboundedPreceding, -1)
    return staged(table.withColumn("before", F.coalesce(F.sum("rows").over(ahead), F.lit(0))), "slot-map")


def place(rows: DataFrame, stored: DataFrame, version: int) -> DataFrame:
    """Rows with their shard under a version of the map and their place in it, 0, 1, 2 ... without gaps."""
    at = stored.where(F.col("version") == version).select("virtual_slot", "sub", "shard", "before")
    inside = F.row_number().over(Window.partitionBy("virtual_slot", "sub").orderBy("doc_id", "text_crc32", "size"))
    numbered = rows.withColumn("_at", inside.cast("long") - 1)
    # the map has at most slots * SUBS rows, so sending it to every task is bounded
    return numbered.join(F.broadcast(at), ["virtual_slot", "sub"]).withColumn("slot", F.col("_at") + F.col("before")).drop("_at", "before")


def shard_by_bytes(documents: DataFrame, shards: int = 16, slots: int = SLOTS) -> DataFrame:
    """Per document: doc_id, size, text_crc32, law, shard, slot (place in the shard), grown_shard (NULL under this law), virtual_slot."""
    rows = slotted(documents, slots)
    out = place(rows, slot_map(rows, shards, slots), 1)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")
