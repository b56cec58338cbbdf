"""Benchmark passages in documents, also with other numbers, names or units."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import slices, strings, written

#: Words in a window, and how many of them must be words of the text and not placeholders.
WINDOW = 8
LITERALS = 4
#: Share of an item's windows that a document must hold, or so many of them in a row.
SHARE = 0.3
RUN = 23
#: Slots of an alignment that may break with the rest, and fewest words of an item for whose sake a document goes.
STRAY = 1
LEAST_WORDS = 4
#: Benchmarks of up to so many windows travel to the tasks as a filter of 8 bytes a window.
FILTER_WINDOWS = 2_000_000

# Units after a number, and numbers in words.
UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg gram grams kilogram kilograms lb lbs pound pounds "
    "oz ounce ounces ton tons ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hour hours "
    "day days week weeks month months year years percent dollar dollars euro euros cent cents meter meters metre metres "
    "kilometer kilometers kilometre kilometres degree degrees mph kmh kph watt watts volt volts".split()
)
NUMBERS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
)
NUMBER = re.compile(r"[$€£]?[+-]?\d[\d.,:/]*%?")
EDGES = "\"'“”‘’()[]{}<>.,;:!?…*_|#&~`^=\\/-–—"
LITERAL, NUM, NAME, UNIT = range(4)
MARKS = {NUM: "<number>", NAME: "<name>", UNIT: "<unit>"}
#: What the text of a window of plain words begins with; no word is made of signs alone.
PLAIN = "="
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _hash(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word.encode())


class _Places(dict):
    """Where the facts of a token stand; asked for an unknown token, has them learnt."""

    def __init__(self, learn):
        self.learn = learn

    def __missing__(self, token: str) -> int:
        self[token] = i = self.learn(token)
        return i


class Canon:
    """Types and digests of the words of a text; what it learns of a word it remembers."""

    def __init__(self, kept: int = 300_000):
        self.kept = kept
        self.forget()

    def forget(self) -> None:
        self.place = _Places(self.learn)
        self.words: list[str] = []
        self.grow(1 << 12)

    def grow(self, size: int) -> None:
        held = len(self.words)
        arrays = [np.zeros(size, t) for t in (np.int64, np.uint64, bool, bool)]
        for new, old in zip(arrays, (self.kind, self.digest, self.ends, self.unit) if held else ()):
            new[:held] = old[:held]
        self.kind, self.digest, self.ends, self.unit = arrays

    def learn(self, token: str) -> int:
        word = token.strip(EDGES)
        if word[:1].isalpha() and word.islower():
            kind = NUM if word in NUMBERS else LITERAL
        elif NUMBER.fullmatch(word) or word.lower() in NUMBERS:
            kind, word = NUM, word.lower()
        elif len(word) > 1 and word[0].isupper() and word[1:].islower():
            kind = NAME  # unless it begins a sentence
        else:
            kind, word = LITERAL, word.lower()
        i = len(self.words)
        if i == len(self.kind):
            self.grow(2 * i)
        self.words.append(word)
        self.kind[i], self.digest[i] = kind, _hash(word.lower()) if word else 0
        self.ends[i] = token.rstrip("\"'”’)]")[-1:] in (".", "!", "?", ":") if token else False
        self.unit[i] = kind == LITERAL and word in UNITS
        return i

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Kind, digest, digest of the word itself and place in `words` of each word; tokens of signs alone are left out."""
        if len(self.words) > self.kept:
            self.forget()
        found = text.split()
        at = np.fromiter(map(self.place.__getitem__, found), np.int64, len(found))
        if not len(at):
            return at, at.astype(np.uint64), at.astype(np.uint64), at
        kind, digest = self.kind[at], self.digest[at]
        begins = np.r_[True, self.ends[at[:-1]]]
        kind[begins & (kind == NAME)] = LITERAL
        unit = self.unit[at] & np.r_[False, kind[:-1] == NUM]
        kind[unit] = UNIT
        real = digest != 0
        typed = np.where(kind == LITERAL, digest, MARK_DIGESTS[kind])
        return kind[real], typed[real], digest[real], at[real]


MARK_DIGESTS = np.array([0, *(_hash(MARKS[k]) for k in (NUM, NAME, UNIT))], np.uint64)


def window_digests(kind: np.ndarray, digest: np.ndarray, width: int, literals: int) -> tuple[np.ndarray, np.ndarray]:
    """Digest of the window at each word, and which windows hold enough words of their own."""
    n = len(kind) - width + 1
    if n < 1:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    sums = np.zeros(n, np.uint64)
    for j in range(width):
        sums = sums * _STEP + digest[j : j + n]
    own = np.cumsum(np.r_[0, kind == LITERAL])
    return sums ^ (sums >> np.uint64(29)), own[width:] - own[:-width] >= literals


def _rows(canon: Canon, text: str, width: int, literals: int, short: list[int] | None, wanted) -> Iterator[tuple[int, int, str, list[str]]]:
    """(place, digest, template, slot values) of the windows of a text that are wanted.

    Windows of templates, and windows of plain words in lower case, whose template begins with PLAIN. `short` are the
    widths below `width` that are cut as well; without it a text shorter than a window is one window.
    """
    kind, typed, plain, at = canon.tokens(text)
    if short is None:
        widths = [min(width, len(kind))] if len(kind) else []
    else:
        widths = [w for w in (*short, width) if w <= len(kind)]
    for w in widths:
        sums, rich = window_digests(kind, typed, w, literals)
        for i in np.flatnonzero(rich & wanted(sums)).tolist():
            words = [(k, canon.words[a].lower()) for k, a in zip(kind[i : i + w].tolist(), at[i : i + w].tolist())]
            template = " ".join(x if k == LITERAL else MARKS[k] for k, x in words)
            yield i, int(sums[i].view(np.int64)), template, [x for k, x in words if k != LITERAL]
        sums = window_digests(kind, plain, w, 0)[0] ^ _STEP
        held = np.flatnonzero(wanted(sums))
        if w < width and len(held):
            held = np.sort(held[np.unique(sums[held], return_index=True)[1]])  # once is enough
        for i in held.tolist():
            yield i, int(sums[i].view(np.int64)), " ".join([PLAIN, *(canon.words[a].lower() for a in at[i : i + w].tolist())]), []


def windows(
    rows: DataFrame, key: str, width: int, literals: int, only: np.ndarray | None = None, short: list[int] | None = None
) -> DataFrame:
    """(key, text_key, pos, window, template, slots) of each text's windows; with `only`, of those digests; `short` as in `_rows`."""
    source = rows.select(F.col(key), "text")
    kind = source.schema[key].dataType.simpleString()
    if only is None:
        def wanted(sums: np.ndarray) -> np.ndarray:
            return np.ones(len(sums), bool)
    else:
        held = np.sort(only)
        first = np.zeros(1 << 20, bool)
        first[held >> np.uint64(44)] = True

        def wanted(sums: np.ndarray) -> np.ndarray:
            out = first[sums >> np.uint64(44)]
            maybe = np.flatnonzero(out)
            near = np.minimum(np.searchsorted(held, sums[maybe]), len(held) - 1)
            out[maybe] = held[near] == sums[maybe]
            return out

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        canon = Canon()
        for batch in (s for b in batches for s in slices(b)):
            out = [(i, t, r) for i, t in enumerate(strings(batch.column("text"))) for r in _rows(canon, t, width, literals, short, wanted)]
            digests = {i: hashlib.md5(t.encode()).digest() for i, t, _ in out}
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(key).take(pa.array([i for i, _, _ in out], pa.int64())),
                    pa.array([digests[i] for i, _, _ in out], pa.binary()),
                    pa.array([r[0] for *_, r in out], pa.int32()), pa.array([r[1] for *_, r in out], pa.int64()),
                    pa.array([r[2] for *_, r in out], pa.string()), pa.array([r[3] for *_, r in out], pa.list_(pa.string())),
                ],
                [key, "text_key", "pos", "window", "template", "slots"],
            )

    return source.mapInArrow(cut, f"{key} {kind}, text_key binary, pos int, window long, template string, slots array<string>")


def leaks(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, literals: int = LITERALS, share: float = SHARE, run: int = RUN) -> DataFrame:
    """Documents that hold a benchmark item, as it is or with other values in its slots.

    Columns: doc_id, text_key (MD5 of the text), item_id, n_words, n_windows (of the item), n_found, same_values. Texts become
    templates in which numbers, names and units are typed placeholders; windows of templates are
    joined on their digest and compared as text; windows of fewer than `literals` own words have no
    template. Beside them windows of plain words are joined, in lower case and of any words, and an item shorter than a
    window is one window of its whole length. A row needs `share` of the item's windows of templates, or of its windows
    of either kind, or `run` of these in a row.

    A window of a template counts where the slots are consistent. Values are judged per slot: within an alignment of a
    document with an item, a slot agrees if it holds the value that stands most often for that value of the item (at equal
    numbers the item's own, then the last). So a value that the item has once may become any other, also one that stands for
    something else, but a repeated one must become the same throughout. Windows with a slot that does not agree count only where
    no more than STRAY slots of the alignment do not, or where they are there word by word. n_found
    counts the windows whose slots all agree; same_values tells whether each window is there with the item's own values.

    An item of one word is in every document with that word; n_words tells such items from those that mean something. Texts without words match nothing. Items that repeat are items
    of their own, as are rows that share an item_id with another text; repeated documents of one doc_id and text
    give one row an item. An empty table on either side gives no rows; other columns are not read.
    """
    items = written(windows(benchmark, "item_id", width, literals), "benchmark-windows")
    typed = ~F.col("template").startswith(PLAIN)
    sizes = items.groupBy("item_id", "text_key").agg(
        F.countDistinct("pos").alias("n_windows"), F.countDistinct(F.when(typed, F.col("pos"))).alias("n_typed"),
        F.max(F.when(~typed, F.col("pos") + F.size(F.split("template", " ")) - 1)).alias("n_words"),
    )
    plain = F.when(~typed, F.size(F.split("template", " ")) - 1).alias("width")
    short = sorted(r.width for r in items.select(plain).filter(F.col("width") < width).distinct().collect())
    distinct = items.select("window").distinct()
    found = [r.window for r in distinct.limit(FILTER_WINDOWS + 1).collect()]
    only = np.array(found, np.int64).view(np.uint64) if len(found) <= FILTER_WINDOWS else None
    if not found:
        only = np.zeros(1, np.uint64)
    held = windows(docs, "doc_id", width, literals, only, short)
    item = items.select(
        "item_id", F.col("text_key").alias("item_key"), F.col("pos").alias("item_pos"), "window", "template",
        F.col("slots").alias("item_slots"),
    )
    marked = F.transform(F.split("template", " "), lambda w, i: F.when(w.isin(*MARKS.values()), F.col("item_pos") + i))
    places = F.filter(marked, lambda i: i.isNotNull())
    pairs = F.arrays_zip(places.alias("place"), F.col("item_slots").alias("a"), F.col("slots").alias("b"))
    alignment = F.struct("doc_id", "text_key", "item_id", "item_key", (F.col("pos") - F.col("item_pos")).alias("shift"))
    hits = held.join(item, ["window", "template"]).select(
        alignment.alias("alignment"), "item_pos", pairs.alias("pairs"), typed.alias("typed")
    )
    hits = written(hits, "template-hits")
    slots = hits.select("alignment", F.explode("pairs").alias("pair")).select("alignment", "pair.*").distinct()
    usual = (
        slots.groupBy("alignment", "a", "b").agg(F.count("*").alias("n"), F.max("place").alias("last"))
        .groupBy("alignment", "a")
        .agg(F.max_by("b", F.struct("n", F.col("a") == F.col("b"), "last")).alias("b"), (F.sum("n") - F.max("n")).alias("stray"))
        .groupBy("alignment")
        .agg(F.map_from_entries(F.collect_list(F.struct("a", "b"))).alias("usual"), F.sum("stray").alias("stray"))
    )
    agrees = F.forall("pairs", lambda p: p["b"] == F.coalesce(F.col("usual")[p["a"]], p["b"]))
    same = F.forall("pairs", lambda p: p["a"] == p["b"])
    typed_hit = F.col("typed")
    places = F.sort_array("places")
    in_row = F.exists(
        F.transform(places, lambda p, i: F.get(places, i + run - 1) - p), lambda d: F.coalesce(d == run - 1, F.lit(False))
    )
    whole = ["doc_id", "text_key", "item_id", "item_key"]
    return (
        hits.join(usual, "alignment", "left")
        .filter(~typed_hit | agrees | same | (F.col("stray") <= STRAY))
        .groupBy("alignment", "item_pos")
        .agg(F.max(agrees).alias("agrees"), F.max(same).alias("same"), F.max("typed").alias("typed"))
        .groupBy("alignment").agg(F.collect_list("item_pos").alias("places"), F.collect_list(F.struct("item_pos", "agrees", "same", "typed")).alias("held"))
        .select("alignment.*", in_row.alias("in_row"), F.explode("held").alias("held"))
        .groupBy(*whole, "held.item_pos")
        .agg(*(F.max(c).alias(c.split(".")[-1]) for c in ("held.agrees", "held.same", "held.typed", "in_row")))
        .groupBy(*whole)
        .agg(
            F.count("*").alias("n_held"), F.count_if("typed").alias("n_held_typed"), F.count_if("agrees").alias("n_found"),
            F.every("same").alias("same_values"), F.max("in_row").alias("in_row"),
        )
        .join(sizes.withColumnRenamed("text_key", "item_key"), ["item_id", "item_key"])
        .filter(
            (F.col("n_held") >= share * F.col("n_windows")) | F.col("in_row")
            | ((F.col("n_held_typed") > 0) & (F.col("n_held_typed") >= share * F.col("n_typed")))
        )
        .select("doc_id", "text_key", "item_id", "n_words", "n_windows", "n_found", "same_values")
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows whose text holds no item. The verdict is on the text, so copies share it whatever their doc_id.

    Items of fewer than LEAST_WORDS words are in too many texts to speak for a leak, and remove none.
    """
    bad = written(leaks(docs, benchmark).filter(F.col("n_words") >= LEAST_WORDS).select("text_key").distinct(), "leaks")
    rows = docs.select(F.struct("*").alias("row"), F.unhex(F.md5("text")).alias("text_key"))
    return rows.join(bad, "text_key", "left_anti").select("row.*")
