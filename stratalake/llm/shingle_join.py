"""Exact Jaccard join of shingle sets: subsets for small sets, inverted lists for large ones."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import lists, raw_bytes, slices, task, written
from stratalake.llm.components import components

SHINGLE_WORDS = 4
#: Least similarity in percent.
PERCENT = 85
#: Counters of the frequency sketch, whatever the amount of data, and the parts they are summed in.
COUNTERS, PARTS = 1 << 20, 256
#: Sets above this size are never worth their subsets.
LARGEST_SMALL = 256
WORDS_KEPT = 400_000
#: Entries that make a list long.
LONG_LIST = 8
#: Shuffled orders of a long list.
ORDERS = 3
#: Entries of a list that are compared with as many others at a time.
BLOCK = 2_000
#: Slots of the filter that picks the sets to verify: two to this power.
FILTER_BITS = 23
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_HIGH = np.uint64(64 - 20)


class _Digests(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = digest = xxhash.xxh3_64_intdigest(word)
        return digest


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(32))


def shingle_set(data: bytes, words: _Digests, width: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted 64-bit digests of the distinct shingles; a text of fewer words is one shingle."""
    if len(words) > WORDS_KEPT:
        words.clear()
    found = data.lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    x = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    used = min(width, len(x))
    sums = np.full(len(x) - used + 1, used, np.uint64)
    for j in range(used):
        sums = sums * _STEP + x[j : j + len(sums)]
    return np.unique(_mixed(sums))


def _set_id(hashes: bytes) -> int:
    return xxhash.xxh3_64_intdigest(hashes) - (1 << 63)


def prefix_length(n: int, shared: int, percent: int = PERCENT) -> int:
    """How many first shingles, in any one order, hold `shared` that two similar sets have in common."""
    return min(n, n - (percent * n + 99) // 100 + shared)


def sketch(docs: DataFrame, width: int) -> np.ndarray:
    """Counts of all shingles of all texts, in a fixed number of counters by their digest's first bits.

    Each task sums its texts; the counters then meet in parts, in two steps, so no task reads the
    counters of all. The result orders shingles from rare to frequent: the join is exact under any order.
    """
    step = COUNTERS // PARTS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, sums = _Digests(), np.zeros(COUNTERS, np.int64)
        for batch in (s for b in batches for s in slices(b)):
            sets = [shingle_set(x, words, width) for x in raw_bytes(batch.column("text"))]
            sums += np.bincount((np.concatenate(sets) >> _HIGH).astype(np.int64), minlength=COUNTERS)
        parts = [sums[i : i + step].astype("<i8").tobytes() for i in range(0, COUNTERS, step)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(PARTS, dtype=np.int32)), pa.array(np.full(PARTS, task() % PARTS, np.int32)), pa.array(parts, pa.binary())],
            ["part", "share", "counts"],
        )

    def total(table: pa.Table) -> pa.Table:
        sums = np.zeros(step, np.int64)
        for x in table["counts"]:
            sums += np.frombuffer(x.as_py(), "<i8")
        return pa.table({"part": table["part"][:1], "share": table["share"][:1], "counts": pa.array([sums.tobytes()], pa.binary())})

    shape = "part int, share int, counts binary"
    counted = docs.select("text").mapInArrow(count, shape).groupBy("part", "share").applyInArrow(total, shape)
    summed = counted.groupBy("part").applyInArrow(total, shape).collect()
    out = np.zeros(COUNTERS, np.int64)
    for r in summed:
        out[r.part * step : (r.part + 1) * step] = np.frombuffer(bytes(r.counts), "<i8")
    return out


def boundary(sizes: dict[int, int], percent: int) -> int:
    """The largest size of a small set, at least cost: subsets written against list entries written and read.

    Rare shingles come first, so a list is mostly as short as a subset's; it is read a second time.
    """

    def subsets(n: int) -> int:
        p = prefix_length(n, 2, percent)
        return p * (p - 1) // 2

    def cost(b: int) -> float:
        small = sum(k * subsets(n) for n, k in sizes.items() if n <= b)
        return small + sum(2 * k * prefix_length(n, 1, percent) for n, k in sizes.items() if 100 * n > percent * b)

    return min(range(LARGEST_SMALL + 1), key=lambda b: (cost(b), b))


def keys_of(hashes: np.ndarray, counts: np.ndarray, small: int, percent: int) -> np.ndarray:
    """Under which keys a set is listed: two-element subsets of its prefix, its prefix, or both near the boundary."""
    n = len(hashes)
    frequent = np.minimum(counts[(hashes >> _HIGH).astype(np.int64)], (1 << 30) - 1)
    rare = hashes[np.argsort(frequent, kind="stable")]  # ties by digest
    out = []
    if 100 * n > percent * small:
        out.append(rare[: prefix_length(n, 1, percent)])
    if 1 < n <= small:
        first = rare[: prefix_length(n, 2, percent)]
        i, j = np.triu_indices(len(first), 1)
        a, b = np.minimum(first[i], first[j]), np.maximum(first[i], first[j])
        out.append(_mixed(a * _STEP + b))
    return np.concatenate(out) if out else hashes[:0]


def profile(hashes: np.ndarray) -> bytes:
    """How many shingles fall into each of 256 classes; the least common counts bound an intersection from above."""
    counts = np.bincount((hashes & np.uint64(255)).astype(np.int64), minlength=256)
    return counts.astype("<u2" if counts.max() > 255 else "u1").tobytes()


def _profiles(column) -> np.ndarray:
    wide = [np.frombuffer(x, "u1" if len(x) == 256 else "<u2") for x in column.to_pylist()]
    return np.array(wide, np.uint16).reshape(-1, 256)


def _may_link(left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """Which rows of two profile matrices can belong to similar sets."""
    both = np.minimum(left, right).sum(1, dtype=np.int64)
    return 100 * both >= percent * (left.sum(1, dtype=np.int64) + right.sum(1, dtype=np.int64) - both)


def _sets(docs: DataFrame, counts: np.ndarray, small: int, width: int, percent: int) -> DataFrame:
    """Per row its set's digest and size; the first row of a set in a task also brings the set's keys."""
    source = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    kind = source.schema["doc_id"].dataType.simpleString()
    compact = counts.clip(0, (1 << 31) - 1).astype(np.int32)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen = _Digests(), set()
        for batch in (s for b in batches for s in slices(b)):
            ids, sizes, keys, profiles = [], [], [], []
            for data in raw_bytes(batch.column("text")):
                hashes = shingle_set(data, words, width)
                key = _set_id(hashes.tobytes()) if len(hashes) else None
                ids.append(key)
                sizes.append(len(hashes))
                fresh = key is not None and key not in seen
                seen.add(key)
                keys.append(keys_of(hashes, compact, small, percent).tobytes() if fresh else b"")
                profiles.append(profile(hashes) if fresh else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("text_key"), pa.array(ids, pa.int64()),
                    pa.array(sizes, pa.int64()), lists(keys, "<i8", pa.int64()), pa.array(profiles, pa.binary()),
                ],
                ["doc_id", "text_key", "set_id", "n_shingles", "keys", "profile"],
            )

    return source.mapInArrow(cut, f"doc_id {kind}, text_key long, set_id long, n_shingles long, keys array<long>, profile binary")


def _shared_lists(sets: DataFrame) -> DataFrame:
    """(key, set_id, n, last_id, last_n): the lists of two sets or more, each entry with the one before it by size.

    A list is read as a sorted stream and never held, however long it is.
    """
    entries = sets.select(F.explode("keys").alias("key"), "set_id", F.col("n_shingles").alias("n"))
    dealt = entries.repartition("key").sortWithinPartitions("key", "n", "set_id")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "set_id", "n", "last_id", "last_n"]
        last = np.zeros((3, 0), np.int64)  # the entry before this batch
        opened = True  # whether that entry has been given out, or there is none
        for batch in batches:
            now = np.stack([batch[c].to_numpy() for c in names[:3]])
            x = np.concatenate([last, now], 1)
            if not x.shape[1]:
                continue
            fresh = np.r_[True, (x[0, 1:] != x[0, :-1]) | (x[1, 1:] != x[1, :-1])]
            held = opened and last.shape[1] > 0
            x = x[:, fresh]
            same = np.r_[False, x[0, 1:] == x[0, :-1]]  # follows an entry of its list
            starts = np.r_[same[1:], False] & ~same  # first of a list of two or more
            give = same | starts
            if last.shape[1]:
                give[0] = starts[0] and not held
            before = np.where(same, np.r_[0, x[1, :-1]], 0), np.where(same, np.r_[0, x[2, :-1]], 0)
            rows = [x[0], x[1], x[2], *before]
            opened = bool(give[-1]) or bool(len(give) == 1 and held)
            last = x[:, -1:]
            columns = [pa.array(c[give]) for c in rows[:3]]
            columns += [pa.array(c[give], mask=~same[give]) for c in rows[3:]]
            yield pa.RecordBatch.from_arrays(columns, names)

    return dealt.mapInArrow(scan, "key long, set_id long, n long, last_id long, last_n long")


def _shuffled_neighbours(shared: DataFrame, percent: int) -> DataFrame:
    """Neighbours (last_id, set_id) in long lists, each list in an order of its own.

    By size a group of near copies stands in the same order in all of its lists; this way a set meets
    others of its group in every list, which joins the group to a component in the first round.
    """
    long = shared.groupBy("key").agg(F.count("*").alias("length")).filter(F.col("length") >= LONG_LIST).select("key")
    entries = shared.join(long, "key", "left_semi")
    out = []
    for seed in range(ORDERS):
        order = Window.partitionBy("key").orderBy(F.xxhash64("key", "set_id", F.lit(seed)), "set_id")
        near = entries.select("set_id", "n", F.lag("set_id").over(order).alias("last_id"), F.lag("n").over(order).alias("last_n"))
        fits = F.least("n", "last_n") * 100 >= F.greatest("n", "last_n") * percent
        out.append(near.filter(F.col("last_id").isNotNull() & fits).select("last_id", "set_id"))
    return reduce(DataFrame.unionByName, out)


def _possible(pairs: DataFrame, profiles: DataFrame, percent: int) -> DataFrame:
    """The pairs whose profiles allow the similarity."""
    one = profiles.select(F.col("set_id").alias("a"), F.col("profile").alias("left"))
    two = profiles.select(F.col("set_id").alias("b"), F.col("profile").alias("right"))

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mask = pa.array(_may_link(_profiles(batch["left"]), _profiles(batch["right"]), percent))
            yield pa.RecordBatch.from_arrays([batch["a"].filter(mask), batch["b"].filter(mask)], ["a", "b"])

    return pairs.join(one, "a").join(two, "b").select("a", "b", "left", "right").mapInArrow(test, "a long, b long")


def _across(entries: DataFrame, percent: int) -> DataFrame:
    """Pairs of a list whose sets have different labels and may be similar by size and profile.

    A list is dealt out in blocks of BLOCK entries; each pair of blocks is compared by one task, and
    only what the profiles allow leaves it. So no list is gathered, and no list's pairs are written.
    """
    blocks = F.ceil(F.col("length") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("set_id"), blocks).cast("int")
    dealt = entries.withColumn("blocks", blocks).withColumn("mine", mine)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(
        "key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "set_id", "n", "label", "profile"
    )
    dealt = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def pairs_of(rows: list[tuple], i: int, j: int) -> Iterator[tuple[int, int]]:
        if len(rows) < 2:
            return
        mine, ids, n, label = (np.array([r[c] for r in rows]) for c in range(4))
        wide = np.array([np.frombuffer(r[4], "u1" if len(r[4]) == 256 else "<u2") for r in rows], np.uint16)
        left = np.flatnonzero(mine == i)
        right = np.flatnonzero(mine == j)
        for x in left.tolist():
            near = right[(label[right] != label[x]) & (100 * np.minimum(n[right], n[x]) >= percent * np.maximum(n[right], n[x]))]
            near = near[ids[near] > ids[x]] if i == j else near[ids[near] != ids[x]]
            if len(near):
                for y in near[_may_link(wide[near], wide[x][None], percent)].tolist():
                    yield min(int(ids[x]), int(ids[y])), max(int(ids[x]), int(ids[y]))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows, seen = None, [], set()

        def close() -> list[tuple[int, int]]:
            if at is None:
                return []
            fresh = [p for p in pairs_of(rows, at[1], at[2]) if p not in seen]
            if len(seen) > WORDS_KEPT:
                seen.clear()
            seen.update(fresh)
            return fresh

        for batch in batches:
            out = []
            columns = [batch[c].to_pylist() for c in ("key", "i", "j", "mine", "set_id", "n", "label", "profile")]
            for key, i, j, *row in zip(*columns):
                if (key, i, j) != at:
                    out += close()
                    at, rows = (key, i, j), []
                rows.append(row)
            yield _pairs(out)
        yield _pairs(close())

    return dealt.mapInArrow(compare, "a long, b long")


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    columns = np.array(found, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(columns[:, 0]), pa.array(columns[:, 1])], ["a", "b"])


def _links(docs: DataFrame, sets: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar, by exact intersection."""
    ids = pairs.select(F.col("a").alias("set_id")).unionByName(pairs.select(F.col("b").alias("set_id")))
    members = _members(docs, sets, ids, width)
    one = members.select(F.col("set_id").alias("a"), F.col("hashes").alias("left"))
    two = members.select(F.col("set_id").alias("b"), F.col("hashes").alias("right"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b, "left")):
            ok = []
            for x, y in zip(batch["left"].to_pylist(), batch["right"].to_pylist()):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                both = len(x) + len(y) - len(np.union1d(x, y))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            mask = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch["a"].filter(mask), batch["b"].filter(mask)], ["a", "b"])

    return pairs.join(one, "a").join(two, "b").select("a", "b", "left", "right").mapInArrow(verify, "a long, b long")


def _bits(ids: DataFrame) -> np.ndarray:
    """Which of a fixed number of slots the ids fall into; the size is the same for any number of ids."""
    slot = F.shiftrightunsigned("set_id", 64 - FILTER_BITS)
    slots = ids.select(F.shiftright(slot, 15).cast("int").alias("part"), slot.bitwiseAND(32767).cast("int").alias("slot")).distinct()

    def pack(table: pa.Table) -> pa.Table:
        held = np.zeros(1 << 15, bool)
        held[table["slot"].to_numpy()] = True
        return pa.table({"part": table["part"][:1], "held": pa.array([np.packbits(held).tobytes()], pa.binary())})

    out = np.zeros((1 << FILTER_BITS - 15, 1 << 12), np.uint8)
    for r in slots.groupBy("part").applyInArrow(pack, "part int, held binary").collect():
        out[r.part] = np.frombuffer(bytes(r.held), np.uint8)
    return out.ravel()


def _members(docs: DataFrame, sets: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(set_id, hashes) of the asked sets, computed again where the texts lie: no text is shuffled.

    Of the texts with one set that of the least digest is taken. Which digests are asked is sent along in a fixed number of
    bits, so only those texts, and the few that share a bit with one, are cut into shingles again.
    """
    need = written(ids.distinct(), "needed")
    key = sets.join(need, "set_id", "left_semi").groupBy("set_id").agg(F.min("text_key").alias("text_key"))
    asked = written(key, "asked")
    packed = _bits(asked.select(F.col("text_key").alias("set_id")))

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests, seen, held = _Digests(), set(), np.unpackbits(packed).view(bool)
        for batch in batches:
            key = batch.column("text_key").to_numpy()
            near = np.flatnonzero(held[key.view(np.uint64) >> np.uint64(64 - FILTER_BITS)])
            for part in slices(batch.take(pa.array(near))):
                ids, keys, hashes = [], [], []
                for text_key, data in zip(part.column("text_key").to_pylist(), raw_bytes(part.column("text"))):
                    if text_key in seen:
                        continue
                    seen.add(text_key)
                    if found := shingle_set(data, digests, width).tobytes():
                        ids.append(_set_id(found))
                        keys.append(text_key)
                        hashes.append(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), pa.array(hashes, pa.binary())], ["set_id", "text_key", "hashes"]
                )

    rows = docs.select("text", F.xxhash64("text").alias("text_key"))
    found = rows.mapInArrow(full, "set_id long, text_key long, hashes binary").join(asked, ["set_id", "text_key"], "left_semi")
    return written(found.groupBy("set_id").agg(F.first("hashes").alias("hashes")), "members")


def _near(n: str, m: str, percent: int):
    """Whether sets of sizes n <= m can be similar at all."""
    return F.col(n) * 100 >= F.col(m) * percent


def similar_groups(docs: DataFrame, width: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, text_key, set_id, n_shingles, component_id) of every row; text_key is xxhash64 of the text.

    Rows link when their shingle sets have a Jaccard similarity of `percent` or more; component_id is
    the least doc_id that links reach. Sets that are equal are one set from the start. Sets
    up to a size chosen by cost are listed under the two-element subsets of their rarest shingles, larger
    ones under their rarest shingles. A first round verifies neighbours in each list, by size
    and in long lists also in shuffled orders, and joins them to components; the second verifies every other pair of a list whose sets lie in
    different components. So no link between components is lost, and groups of near copies
    are not expanded into all their pairs.

    Rows without words or text have no set and are their own component. Rows that repeat are in one component.
    A component without any doc_id has none. No rows give no rows; other columns are not read.
    """
    counts = sketch(docs, width)
    # Sizes are those of texts in words: an upper bound of the set's size is enough to weigh costs.
    words = F.size(F.split(F.trim("text"), r"\s+")) - (width - 1)
    spread = docs.groupBy(F.least(F.greatest(words, F.lit(1)), F.lit(2 * LARGEST_SMALL)).alias("n")).agg(F.count("*").alias("k"))
    sizes = {r.n: r.k for r in spread.collect() if r.n is not None}
    small = boundary(sizes, percent)

    sets = written(_sets(docs, counts, small, width, percent), "sets")
    shared = written(_shared_lists(sets), "lists")
    profiles = sets.filter("profile IS NOT NULL").select("set_id", "profile")
    profiles = profiles.join(shared.select("set_id").distinct(), "set_id", "left_semi").groupBy("set_id").agg(F.first("profile").alias("profile"))
    profiles = written(profiles, "profiles")
    first = shared.filter(F.col("last_id").isNotNull() & _near("last_n", "n", percent))
    first = first.select("last_id", "set_id").unionByName(_shuffled_neighbours(shared, percent))
    first = first.select(F.least("last_id", "set_id").alias("a"), F.greatest("last_id", "set_id").alias("b")).distinct()
    first = written(_possible(first, profiles, percent), "pairs")
    links = written(_links(docs, sets, first, width, percent), "links")
    label = components(links).select(F.col("a").alias("set_id"), F.col("b").alias("label"))

    held = shared.select("key", "set_id", "n").join(label, "set_id", "left").withColumn("label", F.coalesce("label", "set_id"))
    held = written(held, "lists-labelled")
    mixed = held.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("length")).filter("lo < hi")
    second = _across(held.join(mixed.select("key", "length"), "key").join(profiles, "set_id"), percent).distinct()
    second = written(second.join(first, ["a", "b"], "left_anti"), "pairs")
    links = links.unionByName(_links(docs, sets, second, width, percent)).distinct()
    label = components(written(links, "links")).select(F.col("a").alias("set_id"), F.col("b").alias("label"))

    least = sets.filter("set_id IS NOT NULL").groupBy("set_id").agg(F.min("doc_id").alias("least"))
    least = least.join(label, "set_id", "left").withColumn("label", F.coalesce("label", "set_id"))
    whole = least.groupBy("label").agg(F.min("least").alias("component"))
    of_set = least.select("set_id", "label").join(whole, "label").select("set_id", "component")
    return sets.drop("keys", "profile").join(of_set, "set_id", "left").select(
        "doc_id", "text_key", "set_id", "n_shingles",
        F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
    )


def drop_near_copies(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of similar ones: that of the least doc_id, then of the least text_key; null ids come last.

    Rows without words all stay. Rows are told apart by a number written with them, so of rows that are equal in
    everything one stays.
    """
    number = F.monotonically_increasing_id().alias("number")
    numbered = written(docs.select(F.struct("*").alias("row"), number), "numbered")
    rank = F.struct(
        F.col("row.doc_id").isNull().alias("absent"), "row.doc_id", F.xxhash64("row.text").alias("text_key"), "number"
    )
    groups = similar_groups(numbered.select(rank.alias("doc_id"), "row.text"), width, percent)
    dropped = written(groups.filter("doc_id.number <> component_id.number").select("doc_id.number"), "copies")
    return numbered.join(dropped, "number", "left_anti").select("row.*")
