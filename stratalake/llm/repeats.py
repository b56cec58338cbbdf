"""Removal of long repeated byte strings by depth-limited radix passes over sampled suffixes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import SLICE_BYTES, raw_bytes, slices, written

LENGTH = 400
#: Bytes at an anchor that the first pass tells apart, and offsets that share the second pass's digit.
FIRST, STEP = 96, 32
_GRAM = 16
_PLACE = np.uint64((1 << 28) - 1)
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_BLANK = np.uint64(0xFFFFFFFFFFFFFFFF)


def _anchors(data: bytes, length: int, first: int) -> np.ndarray:
    """For each start of a string of `length` bytes, where its anchor lies.

    The anchor is the place of the least digest of 16 bytes among those that leave room for
    `first` bytes in the string, the leftmost of equals. Equal strings thus have it at the same place.
    """
    n, width = len(data), length - first + 1
    raw = np.frombuffer(data, np.uint8)
    eight = np.ndarray((n - 7,), "<u8", raw, 0, (1,))
    key = eight[: n - _GRAM + 1] * _A ^ eight[8:] * _B
    key ^= key >> np.uint64(31)
    key *= _C
    key = (key & ~_PLACE) | np.arange(len(key), dtype=np.uint64)
    rows = -(-len(key) // width)
    grid = np.full(rows * width, _BLANK)
    grid[: len(key)] = key
    grid = grid.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, 1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
    starts = n - length + 1
    return (np.minimum(behind[:starts], ahead[width - 1 : width - 1 + starts]) & _PLACE).astype(np.int64)


def text_runs(data: bytes, length: int, first: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(start, number of starts, anchor, bytes) of the runs of strings that share an anchor.

    Very long texts are worked on in stretches that overlap by a string, so memory is bounded.
    """
    for at in range(0, max(1, len(data) - length + 1), SLICE_BYTES):
        part = data[at : at + SLICE_BYTES + length - 1]
        if len(part) < length:
            return
        anchors = _anchors(part, length, first)
        cuts = [0, *(np.flatnonzero(np.diff(anchors)) + 1).tolist(), len(anchors)]
        for a, b in zip(cuts, cuts[1:]):
            yield at + a, b - a, at + int(anchors[a]), part[a : b - 1 + length]


def _long(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _halves(data: bytes) -> tuple[int, int]:
    x = xxhash.xxh3_128_intdigest(data)
    return _long(x >> 64), _long(x & (1 << 64) - 1)


def _columns(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def _key(text: Column) -> Column:
    return F.md5(text)


def _runs(docs: DataFrame, length: int, first: int) -> DataFrame:
    """All runs of all rows: text digest (k1, k2), place (start, n, anchor), digests of the first digit and of all bytes."""
    names = ["k1", "k2", "start", "n", "anchor", "digit", "s1", "s2"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b)):
            rows = []
            for data in raw_bytes(batch.column("text")):
                if len(data) < length:
                    continue
                k = hashlib.md5(data).digest()
                key = (int.from_bytes(k[:8], "big", signed=True), int.from_bytes(k[8:], "big", signed=True))
                for start, n, anchor, part in text_runs(data, length, first):
                    digit = part[anchor - start : anchor - start + first]
                    rows.append((*key, start, n, anchor, _long(xxhash.xxh3_64_intdigest(digit)), *_halves(part)))
            yield _columns(rows, names)

    return docs.select("text").mapInArrow(cut, ", ".join(f"{c} long" for c in names))


def _keyed(docs: DataFrame, *columns: str) -> DataFrame:
    key = _key(F.col("text"))
    half = [F.conv(F.substring(key, a, 16), 16, -10).cast("long") for a in (1, 17)]
    return docs.select(*columns, "text", half[0].alias("k1"), half[1].alias("k2"))


def _repeated(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys that more than one row has; counted in each task before the shuffle."""
    return rows.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1").drop("_n")


def _apart(digests: DataFrame) -> DataFrame:
    """Digests found in more than one run; a run that copies of a text brought in twice counts once."""
    return digests.groupBy("h1", "h2").agg(F.min("run").alias("lo"), F.max("run").alias("hi")).filter("lo < hi").select("h1", "h2")


def repeated_places(docs: DataFrame, length: int = LENGTH, first: int = FIRST) -> DataFrame:
    """(k1, k2, places): per digest of a text the strings that start elsewhere too, as (start, number).

    Radix passes of growing depth over the strings' suffixes; what stands alone leaves after each:

    1. Of each run of strings with one anchor, the `first` bytes at the anchor.
    2. The bytes of the whole run. Equal runs are repeated as a whole and done.
    3. Of the runs that remain, one of each content, the bytes that 32 neighbouring strings share. Where all
       bytes of the 32 are found in another run, they are repeated and done, and one run goes on for all.
    4. Each whole string. The passes end here, `length` bytes deep; equal groups are the repeats.

    No group is gathered: every pass counts digests, in each task first, and joins the repeated ones back.
    """
    runs = written(_runs(docs, length, first), "runs")
    near = written(runs.join(_repeated(runs, "digit"), "digit", "left_semi"), "runs-near")
    place = F.struct("k1", "k2", "start", "n", "anchor")
    contents = near.groupBy("digit", "s1", "s2").agg(F.count("*").alias("n_rows"), F.min(place).alias("place"))
    contents = written(contents, "runs-contents")
    done = near.join(contents.filter("n_rows > 1").select("s1", "s2").distinct(), ["s1", "s2"], "left_semi")
    done = done.select("k1", "k2", "start", "n").distinct()

    open_groups = _repeated(contents, "digit")
    left = contents.join(open_groups, "digit", "left_semi").select("place.*", "n_rows")
    asked = left.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "n", "anchor", "n_rows")).alias("asked"))
    wanted = _keyed(docs).join(asked, ["k1", "k2"])

    def bytes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()  # copies of a text meet in a task, and one of them is enough
        for batch in (s for b in batches for s in slices(b)):
            rows = []
            texts = raw_bytes(batch.column("text"))
            for k1, k2, data, asked in zip(batch["k1"].to_pylist(), batch["k2"].to_pylist(), texts, batch["asked"].to_pylist()):
                if (k1, k2) in seen:
                    continue
                seen.add((k1, k2))
                for x in asked:
                    part = data[x["start"] : x["start"] + x["n"] - 1 + length]
                    run = _long(xxhash.xxh3_64_intdigest(b"%d %d %d" % (k1, k2, x["start"])))
                    rows.append((run, k1, k2, x["start"], x["n"], x["anchor"], part))
            columns = list(zip(*rows)) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in columns[:6]), pa.array(columns[6], pa.binary())],
                ["run", "k1", "k2", "start", "n", "anchor", "part"],
            )

    shape = "run long, k1 long, k2 long, start long, n long, anchor long"
    parts = written(wanted.mapInArrow(bytes_of, f"{shape}, part binary"), "runs-open")

    blocks_of = "run long, at long, first long, n long, h1 long, h2 long, u1 long, u2 long"

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in blocks_of.split(", ")]
        for batch in (s for b in batches for s in slices(b, "part")):
            rows = []
            columns = [batch[c].to_pylist() for c in ("run", "start", "n", "anchor", "part")]
            for run, start, n, anchor, part in zip(*columns):
                near, far = anchor - start - n + 1, anchor - start
                for step in range(near // STEP, far // STEP + 1):
                    a = far - step * STEP  # the string of the least offset begins here
                    lo, hi = max(a - STEP + 1, 0), min(a, n - 1)
                    common = _halves(b"%d:" % step + part[a : a - STEP + 1 + length])
                    whole = _halves(b"%d %d %d:" % (step, a - lo, a - hi) + part[lo : hi + length])
                    rows.append((run, step, lo, hi - lo + 1, *common, *whole))
            yield _columns(rows, names)

    blocks = written(parts.drop("k1", "k2").mapInArrow(second, blocks_of), "blocks")
    blocks = blocks.join(_apart(blocks), ["h1", "h2"], "left_semi")
    blocks = written(blocks.drop("h1", "h2"), "blocks-near")
    alike = blocks.groupBy("u1", "u2").agg(F.min("run").alias("lo"), F.max("run").alias("hi"))
    blocks = written(blocks.join(alike, ["u1", "u2"]).drop("u1", "u2"), "blocks-alike")
    steps = blocks.filter("run = lo").groupBy("run").agg(F.collect_set("at").alias("steps"))
    names = ["run", "at", "h1", "h2"]
    digests = "run long, at long, h1 long, h2 long"

    def third(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b, "part")):
            rows = []
            columns = [batch[c].to_pylist() for c in ("run", "start", "n", "anchor", "part", "steps")]
            for run, start, n, anchor, part, steps in zip(*columns):
                for step in steps:
                    for offset in range(step * STEP, (step + 1) * STEP):
                        a = anchor - offset - start
                        if 0 <= a < n:
                            rows.append((run, a, *_halves(part[a : a + length])))
            yield _columns(rows, names)

    strings = written(parts.drop("k1", "k2").join(steps, "run").mapInArrow(third, digests), "strings")
    one = F.lit(1).cast("long").alias("n")
    found = strings.join(_apart(strings), ["h1", "h2"], "left_semi").select("run", "at", one)
    found = found.unionByName(blocks.filter("lo < hi").select("run", F.col("first").alias("at"), "n"))
    found = found.groupBy("run").agg(F.collect_set(F.struct("at", "n")).alias("found"))
    single = parts.select("run", "k1", "k2", "start").join(found, "run").withColumn("x", F.explode("found"))
    single = single.select("k1", "k2", (F.col("start") + F.col("x.at")).alias("start"), "x.n")
    every = done.unionByName(single)
    return every.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "n")).alias("places"))


def removed_spans(places: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """The maximal runs of bytes that the strings at (start, number of starts) cover."""
    out: list[list[int]] = []
    for start, n in sorted(places):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], start + n - 1 + length)
        else:
            out.append([start, start + n - 1 + length])
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, length: int = LENGTH, first: int = FIRST) -> DataFrame:
    """Each row's text without the bytes of any `length`-byte string that also starts elsewhere in the rows.

    Columns: doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes). Strings are judged on
    the input, may overlap, and never cross rows; rows with equal text repeat each other, whatever their
    doc_id. A null text counts as empty; texts shorter than a string keep all bytes. Other
    columns of `docs` are not read. No rows give no rows.
    """
    places = written(repeated_places(docs, length, first), "repeats")
    kind = docs.schema["doc_id"].dataType.simpleString()
    joined = _keyed(docs, "doc_id").join(places, ["k1", "k2"], "left").select("doc_id", "text", "places")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b)):
            rows = []
            for data, found in zip(raw_bytes(batch.column("text")), batch.column("places").to_pylist()):
                spans = removed_spans([(x["start"], x["n"]) for x in found or ()], length)
                edges = [0, *(e for s in spans for e in s), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                rows.append((len(data), len(data) - len(kept), len(spans), kept))
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return joined.mapInArrow(cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
