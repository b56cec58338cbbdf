"""Toxicity by the nearest labelled examples under exact cosine of TF-IDF, over the words that tell of the label."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import slices, strings, written
from stratalake.llm.sample import labelled_texts, usable_labels
from stratalake.llm.words import letter_words

#: Examples of each class that the index may hold.
EXAMPLES = 3000
NEAREST = 25
#: Examples in a block of the index.
BLOCK = 32
#: Weight of the base rate against the votes in either tier, in examples with the same direction; words of the second may be there by chance.
BASE_WEIGHTS = (0.5, 4.0)
THRESHOLD = 0.3
#: Words of least digest in which near copies agree.
SKETCH = 8


#: Chi-square that chance alone gives a word in one case of twenty.
CHANCE = 3.84


def least_chi_square(n_words: int) -> float:
    """What chi-square chance alone gives to one of so many words (one degree of freedom)."""
    return NormalDist().inv_cdf(1 - 0.5 / max(n_words, 2)) ** 2


def chi_square(toxic: Column, clean: Column, n_toxic: int, n_clean: int) -> Column:
    """How clearly a word's rates in the two classes differ, given how many examples of each hold it; corrected for small counts."""
    n = n_toxic + n_clean
    rest = (toxic + clean) * (n - toxic - clean) * F.lit(float(n_toxic) * n_clean)
    apart = F.greatest(F.abs(toxic * (n_clean - clean) - clean * (n_toxic - toxic)) - n / 2, F.lit(0.0))
    return F.when(rest > 0, n * apart * apart / rest).otherwise(F.lit(0.0))


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size, one run after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(sizes.sum())


class BlockMaxIndex:
    """Posting lists of unit vectors in blocks, each block with the largest weight of every term.

    `nearest` gives exactly the k examples of largest cosine, ties to the one placed first:
    blocks are visited by falling upper bound, a few at a time, until none can hold a better example.
    """

    def __init__(self, vectors: Iterable[dict[int, float]], n_terms: int):
        parts = [(np.fromiter(v, np.int64, len(v)), np.fromiter(v.values(), float, len(v))) for v in vectors]
        self.n, self.blocks = len(parts), -(-len(parts) // BLOCK)
        sizes = [len(t) for t, _ in parts]
        terms = np.concatenate([np.zeros(0, np.int64), *(t for t, _ in parts)])
        weights = np.concatenate([np.zeros(0), *(w for _, w in parts)])
        del parts
        rows = np.repeat(np.arange(self.n), sizes)
        order = np.lexsort((rows, terms))
        terms, self.rows, self.weights = terms[order], rows[order].astype(np.int32), weights[order]
        # A cell is what a term's list holds in one block.
        cell = terms * max(self.blocks, 1) + self.rows // BLOCK
        first = np.flatnonzero(np.diff(cell, prepend=-1))
        self.block = (self.rows // BLOCK)[first]
        self.most = np.maximum.reduceat(self.weights, first) if len(first) else self.weights
        self.cells = np.r_[first, len(cell)]
        self.lists = np.searchsorted(terms[first], np.arange(n_terms + 1))

    def nearest(self, vector: dict[int, float], k: int) -> list[tuple[float, int]]:
        if not vector or not self.n:
            return []
        terms = np.fromiter(vector, np.int64, len(vector))
        sizes = self.lists[terms + 1] - self.lists[terms]
        cells = _ranges(self.lists[terms], sizes)
        weights = np.repeat(np.fromiter(vector.values(), float, len(vector)), sizes)
        block = self.block[cells]
        bounds = np.bincount(block, weights * self.most[cells], minlength=self.blocks)
        visit = np.argsort(-bounds, kind="stable")[: np.count_nonzero(bounds > 0)]
        ids, sums = np.zeros(0, np.int64), np.zeros(0)
        at, step = 0, 8
        while at < len(visit) and not (len(ids) == k and bounds[visit[at]] < sums[-1] - 1e-12):
            chosen = np.zeros(self.blocks, bool)
            chosen[visit[at : at + step]] = True
            held = np.flatnonzero(chosen[block])
            starts = self.cells[cells[held]]
            sizes = self.cells[cells[held] + 1] - starts
            entries = _ranges(starts, sizes)
            found = np.bincount(self.rows[entries], self.weights[entries] * np.repeat(weights[held], sizes), minlength=self.n)
            more = np.flatnonzero(found > 0)
            ids, sums = np.r_[ids, more], np.r_[sums, found[more]]
            best = np.lexsort((ids, -sums))[:k]
            ids, sums = ids[best], sums[best]
            at, step = at + step, 2 * step
        return list(zip(sums.tolist(), ids.tolist()))


def class_weights(sizes: dict[int, int], held: dict[int, int]) -> list[float]:
    """How many labelled rows an example of either class stands for."""
    return [sizes.get(c, 0) / held[c] if held.get(c) else 0.0 for c in (0, 1)]


class Tier:
    """A vocabulary with its weights, and the index of the examples that hold any of it."""

    def __init__(self, examples: list[tuple[int, dict[bytes, int], int]], terms: list[bytes], weights: np.ndarray):
        self.term = {w: i for i, w in enumerate(terms)}
        self.weights = weights.tolist()
        placed = [(v, doc, y) for doc, words, y in examples if (v := self.vector(words))]
        placed.sort(key=lambda r: (max(r[0], key=lambda t: (r[0][t], -t)), len(r[0]), r[1]))  # alike examples share a block
        self.docs, self.labels = [doc for _, doc, _ in placed], [y for _, _, y in placed]
        self.index = BlockMaxIndex((v for v, _, _ in placed), len(terms))

    def vector(self, words: dict[bytes, int]) -> dict[int, float]:
        raw = {i: (1 + math.log(words[w])) * self.weights[i] for w in words if (i := self.term.get(w)) is not None}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        return {i: x / norm for i, x in sorted(raw.items())} if norm else {}


class Model:
    """Examples in tiers of vocabulary, and the base rate; small enough to go with each task.

    A text is compared over the first tier that holds any of its words.
    """

    def __init__(self, examples: list[tuple[int, dict[bytes, int], int]], sizes: dict[int, int], tiers: list[tuple[list[bytes], np.ndarray]]):
        self.weight = class_weights(sizes, Counter(y for _, _, y in examples))
        total = sum(sizes.values())
        self.base = sizes.get(1, 0) / total if total else 0.0
        self.tiers = [Tier(examples, terms, weights) for terms, weights in tiers]

    @property
    def docs(self) -> set[int]:
        """The examples that any tier holds."""
        return {doc for tier in self.tiers for doc in tier.docs}

    def score(self, text: str) -> tuple[float, list[int]]:
        words, near = Counter(letter_words(text)), []
        for tier, base_weight in zip(self.tiers, BASE_WEIGHTS):
            if vector := tier.vector(words):
                near = tier.index.nearest(vector, NEAREST)
                break
        votes = [0.0, 0.0]
        for cosine, i in near:
            votes[tier.labels[i]] += cosine * cosine * self.weight[tier.labels[i]]
        scale = base_weight * (self.weight[1] if self.weight[1] else 1.0)
        score = (votes[1] + scale * self.base) / (votes[0] + votes[1] + scale)
        return min(1.0, max(0.0, score)), [tier.docs[i] for _, i in near[:5]]


def _example_words(sample: DataFrame) -> DataFrame:
    """doc_id, label and the counted words of each text."""
    kind = sample.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b)):
            counted = [Counter(letter_words(text)) for text in strings(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("label"),
                    pa.array([list(c) for c in counted], pa.list_(pa.binary())), pa.array([list(c.values()) for c in counted], pa.list_(pa.int64())),
                ],
                ["doc_id", "label", "words", "counts"],
            )

    return sample.mapInArrow(count, f"doc_id {kind}, label int, words array<binary>, counts array<long>")


def copy_key(words: Iterable[bytes]) -> int:
    """A digest of the SKETCH words of least digest: near copies mostly agree in it, different texts hardly ever."""
    digests = np.fromiter(map(zlib.crc32, words), np.uint32)
    least = np.sort(np.partition(digests, SKETCH - 1)[:SKETCH] if len(digests) > SKETCH else digests)
    return xxhash.xxh3_64_intdigest(least.astype("<u4").tobytes()) - (1 << 63)


def _terms_held(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """doc_id, key of near copies, and which of the terms each document holds."""
    place = {w: i for i, w in enumerate(terms)}
    kind = docs.schema["doc_id"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b)):
            keys, held = [], []
            for text in strings(batch.column("text")):
                words = set(letter_words(text))
                keys.append(copy_key(words))
                held.append(sorted(place[w] for w in place.keys() & words))
            columns = [batch.column("doc_id"), pa.array(keys, pa.int64()), pa.array(held, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "copies", "terms"])

    return docs.select("doc_id", "text").mapInArrow(find, f"doc_id {kind}, copies long, terms array<int>")


def _judged_terms(docs: DataFrame, known: DataFrame, terms: list[bytes], least: float) -> dict[bytes, tuple[bool, float]]:
    """Of the terms, those that all labelled rows confirm: whether they are of the first tier, and their weight.

    Near copies in a class count once, so that the words of a text do not tell of the label because the text is repeated.
    """
    held = written(_terms_held(docs, terms), "toxicity-held")
    kinds = held.join(known, "doc_id").groupBy("label", "copies").agg(F.min(F.struct("doc_id", "terms")).alias("row"))
    kinds = written(kinds.select("label", "row.terms"), "toxicity-kinds")
    n = {r.label: r.n for r in kinds.groupBy("label").agg(F.count("*").alias("n")).collect()}
    of = kinds.select("label", F.explode("terms").alias("term")).groupBy("term")
    of = of.agg(F.sum("label").cast("double").alias("toxic"), F.sum(1 - F.col("label")).cast("double").alias("clean"))
    square = chi_square(F.col("toxic"), F.col("clean"), n.get(1, 0), n.get(0, 0))
    found = of.select("term", square.alias("square"), (F.col("toxic") > F.col("clean")).alias("leans")).collect()
    found = {r.term: r.square > least for r in found if r.square > least or r.square > CHANCE and r.leans}
    total = held.count()
    holding = {r.term: r.n for r in held.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n")).collect()}
    return {terms[i]: (first, math.log((1 + total) / (1 + holding[i])) + 1) for i, first in found.items()}


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", each: int = EXAMPLES) -> Model:
    """Takes up to `each` labelled examples a class; the words that tell of the label are the vocabulary.

    Words weigh by TF-IDF, counted over all documents. Labels choose words and weigh votes, and have no part in a
    vector. The first tier holds the words whose rates in the classes differ by more than chance brings about for any of
    the examples' words; the second, for rare words, those that differ by more than chance allows a single word and have most of
    their documents in the labelled class. A word that the examples tell of has to pass the same test over all labelled rows, where
    near copies count once: among so many words chance picks hundreds in a sample, and a clean text that holds one of them has
    hardly any neighbours but toxic ones. There is no bound on their number. Words are counted on Spark. The driver gets the vocabulary, and of each example which of its words
    it holds: numbers bounded by `each`, no texts.
    """
    sample, sizes = labelled_texts(docs, labels, label, each)
    examples = written(_example_words(sample), "toxicity-examples")
    held = {r.label: r.n for r in examples.groupBy("label").agg(F.count("*").alias("n")).collect()}
    weight = class_weights(sizes, held)
    each_word = examples.select("label", F.explode("words").alias("word")).groupBy("word")
    rates = each_word.agg(F.sum("label").cast("double").alias("toxic"), F.sum(1 - F.col("label")).cast("double").alias("clean"))
    square = chi_square(F.col("toxic"), F.col("clean"), held.get(1, 0), held.get(0, 0)).alias("square")
    tested = written(rates.select("word", square, (F.col("toxic") * weight[1] > F.col("clean") * weight[0]).alias("leans")), "toxicity-words")
    least = least_chi_square(tested.count())
    asked = tested.filter((F.col("square") > least) | (F.col("square") > CHANCE) & F.col("leans")).select("word")
    told = _judged_terms(docs, usable_labels(labels, label), sorted(bytes(r.word) for r in asked.collect()), least)
    tiers = []
    for first in (True, False):
        terms = sorted(w for w in told if told[w][0] == first)
        tiers.append((terms, np.array([told[w][1] for w in terms])))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [
                [(w, n) for w, n in zip(words, counts) if w in told]
                for words, counts in zip(batch.column("words").to_pylist(), batch.column("counts").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("label"),
                    pa.array([[w for w, _ in k] for k in kept], pa.list_(pa.binary())), pa.array([[n for _, n in k] for k in kept], pa.list_(pa.int64())),
                ],
                batch.schema.names,
            )

    found = [(r.doc_id, dict(zip(map(bytes, r.words), r.counts)), r.label) for r in examples.mapInArrow(keep, examples.schema).collect()]
    return Model(found, sizes, tiers)


def score_toxicity(docs: DataFrame, model: Model, below: float | None = None) -> DataFrame:
    """Adds score and evidence (doc_ids of the nearest examples) beside a struct `row` of the given columns.

    A text without any word of the vocabulary, so also an empty or null one, has no neighbour and
    scores the base rate of the labels; without labelled rows that is 0. Each row is scored by its own
    whole text, repeated ones alike. No rows give no rows. With `below`, rows that score so much or more are left out.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.struct("*").alias("row"))
    row = rows.schema["row"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("row").field("text")  # the row's own text: it is not sent twice
            for part in slices(pa.RecordBatch.from_arrays([batch.column("row"), texts], ["row", "text"])):
                found = [model.score(text) for text in strings(part.column("text"))]
                scores, kept = pa.array([s for s, _ in found], pa.float64()), part.column("row")
                evidence = pa.array([e for _, e in found], pa.list_(part.schema.field("row").type.field("doc_id").type))
                out = pa.RecordBatch.from_arrays([kept, scores, evidence], ["row", "score", "evidence"])
                yield out if below is None else out.filter(pc.less(scores, below))

    return rows.mapInArrow(score, f"row {row}, score double, evidence array<{kind}>")


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose score is below the threshold."""
    return score_toxicity(docs, model, below=threshold).select("row.*")
