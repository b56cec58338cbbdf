"""Periodic runs of words: Lyndon arrays by grouping suffixes, their roots extended into runs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import raw_bytes, slices
from stratalake.llm.windows import in_repeated_windows, numbered_words, stretches

LEAST, TIMES = 24, 3


def lyndon_lengths(ids: list[int]) -> list[int]:
    """For each place, the length of the longest Lyndon word that starts there.

    The first phase of suffix sorting by groups: suffixes are grouped by a common first part, and groups are
    taken from the greatest to the least. A member is the next part of the nearest suffix before it that lies in a
    lesser group; that suffix's part grows by it, and it leaves its group upwards, the further the more parts it
    got. In the end the part of each suffix is its longest Lyndon word, and no suffix needs to be sorted.
    """
    n = len(ids)
    order = sorted(range(n), key=ids.__getitem__)
    at, group, end = [0] * n, [0] * n, [0] * (n + 1)
    first = 0
    for place, i in enumerate(order):
        if ids[i] != ids[order[first]]:
            end[first], first = place, place
        at[i], group[i] = place, first
    end[first] = n
    length, before, done = [1] * n, [-1] * n, bytearray(n)
    top = n
    while top:
        low = group[order[top - 1]]
        members = sorted(order[low:top])
        top, part = low, length[members[0]]
        grown: dict[int, int] = {}
        for i in members:
            j = i - 1
            while j >= 0 and done[j]:
                j = before[j]
            before[i], done[i] = j, 1
            if j >= 0:
                grown[j] = grown.get(j, 0) + 1
        leaving: dict[tuple[int, int], list[int]] = {}
        for j, count in grown.items():
            length[j] += count * part
            leaving.setdefault((count, group[j]), []).append(j)
        for count, g in sorted(leaving, reverse=True):
            movers = leaving[count, g]
            start, stop = end[g] - len(movers), end[g]
            if start == g:  # all that are left in the group
                continue
            for place, j in zip(range(start, stop), movers):
                other, was = order[place], at[j]
                order[was], at[other] = other, was
                order[place], at[j] = j, place
                group[j] = start
            end[start], end[g] = stop, start
    return length


def _common(words: np.ndarray, i: int, shift: int) -> int:
    """How many words from i on equal those `shift` later; looks at stretches of doubling length."""
    known, size = 0, 16
    while (left := len(words) - i - shift - known) > 0:
        size = min(size, left)
        a = i + known
        unlike = words[a : a + size] != words[a + shift : a + shift + size]
        if unlike.any():
            return known + int(unlike.argmax())
        known, size = known + size, size * 2
    return known


def runs_of(ids: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of at least `least` words and `times` periods, by start and period.

    A run of three periods or more holds its Lyndon root, under one order of words or its reverse, at least twice in a row.
    Such pairs of equal neighbouring roots are extended to both sides, each run's once.
    """
    n, back = len(ids), ids[::-1]
    found: set[tuple[int, int, int]] = set()
    for ranks in (ids, int(ids.max()) - ids):
        root = np.array(lyndon_lengths(ranks.tolist()), np.int64)
        pairs = np.flatnonzero(np.arange(n) + root < n)
        pairs = pairs[root[pairs + root[pairs]] == root[pairs]]
        pairs = pairs[ids[pairs] == ids[pairs + root[pairs]]]
        reach: dict[int, int] = {}
        for i in pairs.tolist():
            p = int(root[i])
            if i + 2 * p <= reach.get(p, 0):
                continue
            ahead = _common(ids, i, p)
            if ahead < p:
                continue
            start, stop = i - _common(back, n - i - p, p), i + p + ahead
            reach[p] = stop
            if stop - start >= max(least, times * p):
                found.add((start, stop - start, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def text_runs(words: list[bytes], least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """The runs of a text's words.

    Each window of a run of that length and power, if no longer than (least + 5) / 3 words, stands a period further
    on or back as well. So only stretches of words in repeated windows of the text are searched; that leaves no run out.
    """
    if times < 3:
        raise ValueError("a run must hold three periods or more")
    if len(words) < least:
        return []
    ids = numbered_words(words)
    near = in_repeated_windows(ids, max(1, (least + 5) // 3))
    out = []
    for a, b in stretches(near).tolist():
        if b - a >= least:
            out += [(a + start, length, p) for start, length, p in runs_of(ids[a:b], least, times)]
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, joined by blanks, without those that a run holds after its first period."""
    if not runs:
        return b" ".join(words)
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, p in runs:
        edges[start + p] += 1
        edges[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()])


def find_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """Per row its periodic runs of words and the text without their repetitions.

    Columns: doc_id, n_words, runs (array of start, length, period; by start, then period), collapsed (the words
    that are left, joined by blanks). Words are divided by ASCII white space. A run is a stretch with smallest
    period p of at least `least` words and `times` * p words that cannot be extended with that period.

    Every row is judged alone, so repeated rows and ids give equal rows; nothing is shuffled. A null text, or one
    without words, has no runs and an empty collapsed text. No rows give no rows. Other columns
    of `docs` are not read. Memory is that of one text; time is in proportion to its words, but for sorting.
    """
    source = docs.select("doc_id", "text")
    kind = source.schema["doc_id"].dataType.simpleString()
    run = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b)):
            sizes, found, left = [], [], []
            for data in raw_bytes(batch.column("text")):
                words = data.split()  # of bytes: at ASCII white space alone
                runs = text_runs(words, least, times)
                sizes.append(len(words))
                found.append([dict(zip(("start", "length", "period"), r)) for r in runs])
                left.append(collapsed(words, runs).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(found, run), pa.array(left, pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    schema = f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return source.mapInArrow(search, schema)


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length / period of an array ordered by start and period, the first of equals."""
    kind = "struct<start: long, length: long, period: long>"

    def better(best: Column, run: Column) -> Column:
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | more, run).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast(kind), better)


def with_planted_repeats(text: Column, doc_id: Column) -> Column:
    """The text, made periodic from a word on where a checksum of doc_id ends in 0.

    With h the CRC-32 of the decimal id, g = h / 10 and n words: from word a = g % n on, the first
    1 + (n - a) / (3 + g % 8) words are repeated up to the end. A null id or text, or one without words, stays.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def periodic(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = g % n
        p = F.floor((n - a) / (3 + g % 8)) + 1
        place = F.sequence(F.lit(0).cast("long"), n - 1)
        source = F.transform(place, lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))
        moved = F.transform(source, lambda i: F.get(w, i))
        return F.when(n > 0, F.array_join(moved, " ")).otherwise(text)

    changed = F.get(F.transform(F.array(words), periodic), F.lit(0))  # the words are bound once a row
    return F.when((h % 10 == 0) & text.isNotNull(), changed).otherwise(text)
