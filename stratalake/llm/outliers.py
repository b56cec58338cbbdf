"""Quality rules by robust multivariate outliers: minimum covariance determinant per language and source."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import raw_bytes, slices, strings, written
from stratalake.llm.windows import in_repeated_windows, numbered_words

#: Fixed rules: fewest words, and the most words of a hundred that may lie in repeated windows of WINDOW words.
LEAST_WORDS, MOST_REPEATED, WINDOW = 20, 30, 8
#: Share of a cell's rows whose covariance has the least determinant, and fewest rows of a cell.
HALF, LEAST_ROWS = 0.75, 50
#: Squared distance, on the scale of a normal cell, beyond which a row is rejected.
CUT = 120.0
#: Least standard deviation of each feature, so that one that hardly varies in a cell rejects nothing by itself.
FLOORS = np.array([0.25, 0.05, 0.05, 0.15, 0.15, 0.03, 0.25])
_K = len(FLOORS)
#: Median of the sum of squares of as many independent normal values (Wilson and Hilferty).
_TYPICAL = _K * (1 - 2 / (9 * _K)) ** 3
_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct"]
_SYMBOLS = b"#*$%&|<>"
_SPACES = (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")
_PACK, _OPEN = 2048, 1 << 16
_STEPS_OF_ALL, _STEPS = 2, 20
#: Steps of a quantile's grid: of features per unit, of squared distances per doubling.
_GRID, _FINE = 256, 64
_CROSS = np.triu_indices(_K)


def text_counts(data: bytes, points: int) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines and n_distinct of a text of so many code points."""
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    ids = numbered_words(words)
    return (
        len(words), points - sum(map(data.count, _SPACES)), len(data) - len(data.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)), int(in_repeated_windows(ids, WINDOW).sum()), len(lines),
        int(ids.max()) + 1 if len(ids) else 0,
    )


def vectors(counts: np.ndarray) -> np.ndarray:
    """The transformed statistics of rows of counts: logarithms of sizes, angles of shares, Herdan's index."""
    n, chars, symbols, dup, repeat, lines, distinct = np.maximum(counts, 0).astype(float).T
    some, rows = np.maximum(n, 1), np.maximum(lines, 1)
    return np.column_stack([
        np.log1p(n),
        np.log1p(chars / some),
        np.sqrt(symbols / np.maximum(chars, 1)),
        np.arcsin(np.sqrt(dup / rows)),
        np.arcsin(np.sqrt(repeat / some)),
        np.log1p(distinct) / np.log1p(some),
        np.log1p(some / rows),
    ])


def count_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of each row's whole text."""
    source = docs.select("doc_id", "lang", "source", "text")
    keep = source.schema[:3]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b)):
            points = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_pylist()
            rows = [text_counts(x, n) for x, n in zip(raw_bytes(batch.column("text")), points)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in keep), *(pa.array(c, pa.int64()) for c in zip(*rows))],
                [*(f.name for f in keep), *_COUNTS],
            )

    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in keep] + [f"{c} long" for c in _COUNTS])
    return source.mapInArrow(count, schema)


def base_failed() -> Column:
    few, repeated = F.col("n_words") < LEAST_WORDS, 100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    return few | repeated


def _tag(name: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit("")).alias(f"{name}_tag")


def _cells(tagged: DataFrame) -> DataFrame:
    """lang_tag, source_tag, cell: small sources of a language share a cell, and small ones of those across languages."""
    sizes = tagged.filter("not base_failed").groupBy("lang_tag", "source_tag").agg(F.count("*").alias("n"))
    small = F.col("n") < LEAST_ROWS
    rest = F.sum(F.when(small, F.col("n"))).over(Window.partitionBy("lang_tag"))
    key = F.when(~small, F.array("lang_tag", "source_tag")).when(rest >= LEAST_ROWS, F.array("lang_tag")).otherwise(F.array())
    return sizes.select("lang_tag", "source_tag", F.to_json(key).alias("cell"))


def _matrix(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    return np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in names])


def _packs(rows: DataFrame) -> DataFrame:
    """cell, rows: vectors of up to _PACK rows of a cell as one binary value; nothing is shuffled."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[np.ndarray]] = defaultdict(list)
        sizes: dict[str, int] = defaultdict(int)

        def out(cells: list[str]) -> pa.RecordBatch:
            joined = [np.concatenate(waiting.pop(c)) for c in cells]
            for c in cells:
                del sizes[c]
            cut = [(c, x[a : a + _PACK].tobytes()) for c, x in zip(cells, joined) for a in range(0, len(x), _PACK)]
            return pa.RecordBatch.from_arrays([pa.array([c for c, _ in cut], pa.string()), pa.array([x for _, x in cut], pa.binary())], ["cell", "rows"])

        for batch in batches:
            x = vectors(_matrix(batch, _COUNTS))
            cells, of = np.unique(strings(batch.column("cell")), return_inverse=True)
            for k, cell in enumerate(cells.tolist()):
                mine = x[of == k]
                waiting[cell].append(mine)
                sizes[cell] += len(mine)
            if full := [c for c, n in sizes.items() if n >= _PACK]:
                yield out(full)
            if sum(sizes.values()) > _OPEN:
                yield out(list(sizes))
        if sizes:
            yield out(list(sizes))

    return rows.mapInArrow(pack, "cell string, rows binary")


def _vectors_of(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    for i, raw in enumerate(batch.column("rows").to_pylist()):
        yield i, np.frombuffer(raw).reshape(-1, _K)


def _doubles(batch: pa.RecordBatch, name: str, row: int) -> np.ndarray:
    return np.array(batch.column(name)[row].as_py(), float)


def _histograms(packs: DataFrame, buckets: Callable[[pa.RecordBatch, int, np.ndarray], np.ndarray]) -> DataFrame:
    """cell, kind, bucket, n: how many rows of a pack fall into each bucket, for each column that `buckets` gives."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for i, x in _vectors_of(batch):
                for kind, column in enumerate(buckets(batch, i, x).T):
                    value, n = np.unique(column, return_counts=True)
                    parts.append((batch.column("cell")[i].as_py(), kind, value, n))
            lengths = [len(v) for _, _, v, _ in parts]
            cells = np.repeat(np.array([c for c, *_ in parts], object), lengths)
            kinds = np.repeat(np.array([k for _, k, *_ in parts], np.int32), lengths)
            both = [np.concatenate([p[c] for p in parts]).astype(np.int64) if parts else np.empty(0, np.int64) for c in (2, 3)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cells, pa.string()), pa.array(kinds), *(pa.array(b) for b in both)], ["cell", "kind", "bucket", "n"]
            )

    return packs.mapInArrow(count, "cell string, kind int, bucket long, n long")


def _quantiles(histograms: DataFrame, kinds: int, **shares: float) -> DataFrame:
    """cell and, for each share, the buckets in which it is reached, one of each kind.

    Buckets are counted in each task, and there are few of them, so this is one exchange of small rows.
    """
    lists = [
        F.array(*(F.ceil(F.percentile(F.when(F.col("kind") == k, F.col("bucket")), share, F.col("n"))) for k in range(kinds))).alias(name)
        for name, share in shares.items()
    ]
    return histograms.groupBy("cell").agg(*lists)


def _log_buckets(batch: pa.RecordBatch, i: int, x: np.ndarray) -> np.ndarray:
    d = _distances(x, _doubles(batch, "centres", i), _doubles(batch, "whitens", i))
    return np.floor(np.log2(np.maximum(d, 2.0**-20)) * _FINE)


def _distances(x: np.ndarray, centres: np.ndarray, whitens: np.ndarray) -> np.ndarray:
    """Squared distances of rows from each of the centres laid end to end."""
    turned = [(x - c) @ w.T for c, w in zip(centres.reshape(-1, _K), whitens.reshape(-1, _K, _K))]
    return np.column_stack([(t * t).sum(1) for t in turned])


_WIDTH = 1 + _K + len(_CROSS[0])


def _sums(packs: DataFrame, kinds: int, choose: Callable[[pa.RecordBatch, int, np.ndarray], list[np.ndarray]], *keep: str) -> DataFrame:
    """cell, s0, s1, ...: for each kind the number, sums and sums of products of the rows that `choose` gives.

    `keep` are columns that are equal in all packs of a cell.
    """
    names = [f"s{i}" for i in range(kinds * _WIDTH)]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[v for y in choose(batch, i, x) for v in (len(y), *y.sum(0), *(y.T @ y)[_CROSS])] for i, x in _vectors_of(batch)]
            columns = np.array(rows, float).reshape(-1, len(names)).T
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("cell", *keep)), *(pa.array(c) for c in columns)], ["cell", *keep, *names]
            )

    kept = "".join(f", {c} {packs.schema[c].dataType.simpleString()}" for c in keep)
    added = packs.mapInArrow(add, f"cell string{kept}, {', '.join(f'{c} double' for c in names)}")
    return added.groupBy("cell").agg(*(F.first(c).alias(c) for c in keep), *(F.sum(c).alias(c) for c in names))


def _moments(row: np.ndarray, centred: bool) -> tuple[np.ndarray, np.ndarray]:
    n = max(row[0], 1.0)
    mean = row[1 : 1 + _K] / n
    cov = np.zeros((_K, _K))
    cov[_CROSS] = row[1 + _K :] / n
    cov = cov + np.triu(cov, 1).T
    return mean, cov - np.outer(mean, mean) if centred else cov


def _model(centre: np.ndarray, cov: np.ndarray) -> tuple[list[float], list[float], float]:
    """Centre, whitening matrix and log determinant; rounded, so that the order of sums does not matter."""
    cov = cov + np.diag(FLOORS**2)
    whiten = np.linalg.inv(np.linalg.cholesky(cov))
    short = lambda a: [float(f"{v:.10g}") for v in np.ravel(a)]
    return short(centre), short(whiten), float(f"{-2 * np.log(np.diag(whiten)).sum():.10g}")


_MODELS = "cell string, centres array<double>, whitens array<double>, spreads array<double>, fall double"


def _model_rows(batch: pa.RecordBatch, fitted: list[list[tuple]], falls: list[float]) -> pa.RecordBatch:
    """One row a cell: its models' centres, whitening matrices and log determinants end to end."""
    lists = pa.list_(pa.float64())
    columns = [pa.array([[v for m in cell for v in (m[k] if k < 2 else [m[2]])] for cell in fitted], lists) for k in range(3)]
    return pa.RecordBatch.from_arrays([batch.column("cell"), *columns, pa.array(falls, pa.float64())], ["cell", "centres", "whitens", "spreads", "fall"])


def _starts(packs: DataFrame) -> DataFrame:
    """Three robust starts of each cell: spread of each feature alone, correlation of squashed values, of directions."""

    def grid(batch: pa.RecordBatch, i: int, x: np.ndarray) -> np.ndarray:
        return np.floor(x * _GRID)

    places = _quantiles(_histograms(packs, grid), _K, low=0.25, middle=0.5, high=0.75)

    def scaled(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray]:
        middle = (_doubles(batch, "middle", i) + 0.5) / _GRID
        return middle, np.maximum((_doubles(batch, "high", i) - _doubles(batch, "low", i)) / _GRID / 1.349, FLOORS)

    def squashed(batch: pa.RecordBatch, i: int, x: np.ndarray) -> list[np.ndarray]:
        middle, scale = scaled(batch, i)
        z = (x - middle) / scale
        size = np.sqrt((z * z).sum(1, keepdims=True))
        return [np.tanh(z), z / np.maximum(size, 1e-9)]

    sums = _sums(packs.join(written(places, "outlier-places"), "cell"), 2, squashed, "low", "middle", "high")
    names = [c for c in sums.columns if c[0] == "s"]

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fitted = []
            for i, row in enumerate(_matrix(batch, names)):
                middle, scale = scaled(batch, i)
                shapes = [np.eye(_K)]
                for part in row.reshape(2, _WIDTH):
                    cov = _moments(part, centred=False)[1] + 1e-6 * np.eye(_K)
                    side = np.sqrt(np.diag(cov))
                    shapes.append(cov / np.outer(side, side))
                fitted.append([_model(middle, shape * np.outer(scale, scale)) for shape in shapes])
            yield _model_rows(batch, fitted, [0.0] * len(fitted))

    return sums.mapInArrow(begin, _MODELS)


def _concentrated(packs: DataFrame, models: DataFrame, kinds: int, choose_one: bool = False) -> DataFrame:
    """One step: models of the rows nearest by the present ones, HALF of each cell, and how far the determinants fell.

    With `choose_one` only the model of least determinant goes on.
    """
    known = packs.join(models, "cell")
    bounds = written(_quantiles(_histograms(known, _log_buckets), kinds, bound=HALF), "outlier-bounds")

    def inner(batch: pa.RecordBatch, i: int, x: np.ndarray) -> list[np.ndarray]:
        inside = _log_buckets(batch, i, x) <= _doubles(batch, "bound", i)
        return [x[c] for c in inside.T]

    sums = _sums(known.join(bounds, "cell"), kinds, inner, "spreads")
    names = [c for c in sums.columns if c[0] == "s" and c != "spreads"]

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fitted, falls = [], []
            for i, row in enumerate(_matrix(batch, names)):
                found = [_model(*_moments(part, centred=True)) for part in row.reshape(kinds, _WIDTH)]
                falls.append(max(abs(m[2] - before) for m, before in zip(found, _doubles(batch, "spreads", i))))
                fitted.append([min(found, key=lambda m: m[2])] if choose_one else found)
            yield _model_rows(batch, fitted, falls)

    return written(sums.mapInArrow(fit, _MODELS), "outlier-models")


def fit(packs: DataFrame) -> DataFrame:
    """cell, centre, whiten: the minimum covariance determinant estimate of each cell, scaled to a normal cell.

    From three robust starts concentration steps over all rows are taken; after two, the start of least
    determinant goes on until no cell's determinant falls any more. Cells differ in size without limit, but what is
    counted and summed of them is of fixed size, made in each task first.
    """
    models = written(_starts(packs), "outlier-models")
    for step in range(_STEPS_OF_ALL):
        models = _concentrated(packs, models, 3, choose_one=step == _STEPS_OF_ALL - 1)
    for _ in range(_STEPS):
        models = _concentrated(packs, models, 1)
        if (models.agg(F.max("fall")).first()[0] or 0.0) < 1e-6:
            break
    middle = _quantiles(_histograms(packs.join(models, "cell"), _log_buckets), 1, middle=0.5)
    typical = F.pow(F.lit(2.0), (F.col("middle")[0] + 0.5) / _FINE)
    return models.join(middle, "cell").select(
        "cell", F.col("centres").alias("centre"), F.transform("whitens", lambda w: w * F.sqrt(_TYPICAL / typical)).alias("whiten")
    )


def judge(docs: DataFrame, cut: float = CUT) -> DataFrame:
    """Per row its counts, base_failed, distance (squared, null without a verdict) and kept.

    Rows that fail a fixed rule go. Of the others the estimate of their language and source is made, and those
    farther from it than `cut` go. Sources with fewer than LEAST_ROWS such rows share a cell with the
    language's other small ones, languages with too few of those share one; if that is still too small, its rows
    are kept. All rows of a cell count, repeated ones as often as they are there. Every row is judged by its own
    values, whatever its doc_id, null or repeated. A null language or source is a value of its own. A null
    or empty text has no words and fails. No rows give no rows. Other columns of `docs` are not read.
    """
    counted = written(count_statistics(docs), "outlier-counts").withColumn("base_failed", base_failed())
    tagged = counted.withColumns({"lang_tag": _tag("lang"), "source_tag": _tag("source")})
    cells = written(_cells(tagged), "outlier-cells")
    rows = tagged.join(cells, ["lang_tag", "source_tag"], "left")
    packs = written(_packs(rows.filter("not base_failed").select("cell", *_COUNTS)), "outlier-vectors")
    sizes = packs.groupBy("cell").agg(F.sum(F.octet_length("rows") / (8 * _K)).alias("n"))
    models = written(fit(packs.join(sizes.filter(F.col("n") >= LEAST_ROWS), "cell", "left_semi")), "outlier-model")
    kept = [c for c in rows.columns if c not in ("cell", "lang_tag", "source_tag")]
    known = rows.join(models, "cell", "left").select(*kept, F.when(~F.col("base_failed"), F.col("centre")).alias("centre"), "whiten")
    shape = [f for f in known.schema if f.name not in ("centre", "whiten")]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            has = np.flatnonzero(batch.column("centre").is_valid().to_numpy(zero_copy_only=False))
            distance = np.full(batch.num_rows, np.nan)
            if len(has):
                some = batch.take(pa.array(has))
                centre = some.column("centre").flatten().to_numpy().reshape(-1, _K)
                whiten = some.column("whiten").flatten().to_numpy().reshape(-1, _K, _K)
                turned = np.einsum("nij,nj->ni", whiten, vectors(_matrix(some, _COUNTS)) - centre)
                distance[has] = (turned * turned).sum(1)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in shape), pa.array(distance, from_pandas=True)], [*(f.name for f in shape), "distance"]
            )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in shape)
    measured = known.mapInArrow(measure, f"{schema}, distance double")
    near = F.coalesce(F.col("distance") <= cut, F.lit(True))
    return measured.withColumn("kept", ~F.col("base_failed") & near)
