"""Periodic runs, covariance outliers and the Merkle manifest against brute force, and on odd rows."""

import random
import time
import zlib
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratalake.llm import merkle, outliers, periodic_runs, queries, windows
from tests.compare import difference, duck

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, pos int, part int, cell string, tree string, n long"


def frame(spark, rows):
    """(doc_id, text, lang, source) with columns that clash with the operators' own."""
    full = [(i, t, g, s, None if t is None else len(t), "r", 1, 2, "c", "t", 3) for i, t, g, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def brute_runs(words, least, times):
    out = []
    for p in range(1, len(words) // times + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            length = j + p - i
            shorter = any(p % q == 0 and words[i : i + length - q] == words[i + q : i + length] for q in range(1, p))
            if length >= max(least, times * p) and not shorter:
                out.append((i, length, p))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def made_words(pick):
    words = []
    for _ in range(pick.randrange(1, 4)):
        block = [pick.randrange(pick.choice([2, 3, 9])) for _ in range(pick.randrange(1, 12))]
        words += (block * pick.randrange(1, 9))[: pick.randrange(1, 90)]
        words += [pick.randrange(30) for _ in range(pick.randrange(5))]
    return words


def test_lyndon_lengths_by_definition():
    pick = random.Random(1)
    for _ in range(600):
        s = [pick.randrange(pick.choice([1, 2, 3, 8])) for _ in range(pick.randrange(1, 50))]
        want = [next((j for j in range(i + 1, len(s)) if s[j:] < s[i:]), len(s)) - i for i in range(len(s))]
        assert periodic_runs.lyndon_lengths(s) == want


def test_runs_by_brute_force():
    pick = random.Random(2)
    for _ in range(500):
        s = made_words(pick)
        words = [b"w%d" % x for x in s]
        for least, times in ((24, 3), (6, 3), (3, 4)):
            assert periodic_runs.text_runs(words, least, times) == brute_runs(s, least, times)
    with pytest.raises(ValueError):
        periodic_runs.text_runs([b"a"] * 30, 24, 2)


def test_runs_of_very_long_texts_are_found_in_time():
    pick = random.Random(3)
    block = [b"w%d" % pick.randrange(5000) for _ in range(1000)]
    start = time.time()
    assert periodic_runs.text_runs(block * 200) == [(0, 200_000, 1000)]
    assert periodic_runs.text_runs([b"a"] * 200_000) == [(0, 200_000, 1)]
    a, b = b"a", b"ab"
    while len(b) < 100_000:
        a, b = b, b + a
    assert all(length < 4 * p for _, length, p in periodic_runs.text_runs([bytes([c]) for c in b]))
    assert time.time() - start < 20


def test_repeated_windows_by_brute_force():
    pick = random.Random(4)
    for _ in range(300):
        s = made_words(pick)
        for width in (1, 2, 5, 8, 9):
            seen = [tuple(s[i : i + width]) for i in range(len(s) - width + 1)]
            want = [any(seen.count(seen[i]) > 1 for i in range(max(0, k - width + 1), min(k + 1, len(seen)))) for k in range(len(s))]
            assert windows.in_repeated_windows(np.array(s), width).tolist() == want


def expected_runs(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words, 24, 3)
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None, None, None)
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        sha256("".join(f"{s},{length},{p}\n" for s, length, p in runs).encode()).hexdigest(),
        sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest(),
    )


def test_op11_on_odd_rows_and_planted_repeats(spark, scratch):
    pick = random.Random(5)
    texts = [None, "", " \t\n", "one", "a " * 23, "a " * 24, "x y z " * 9, "naïve 日本 \x1c café\n" * 12]
    texts += [" ".join(f"w{x}" for x in made_words(pick)) for _ in range(150)]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    rows += [(None, "b c " * 30, None, None), (7, texts[20], "en", "s"), (7, texts[20], "en", "s"), (99999, "q " * 2000, "en", "s")]
    frame(spark, rows).write.parquet(f"{scratch}/documents.parquet")
    got = [tuple(r) for r in queries.QUERIES["op11_periodic_runs"](spark, scratch).collect()]
    order = lambda r: (r[0] is None, r[0] or 0, r[-1])
    assert sorted(got, key=order) == sorted((expected_runs(i, t) for i, t, *_ in rows), key=order)
    assert any(zlib.crc32(str(r[0]).encode()) % 10 == 0 and r[1] for r in got)


def test_op11_on_the_smallest_table(spark, folder):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r) for r in queries.QUERIES["op11_periodic_runs"](spark, folder).collect()}
    short = [i for i, t in docs.items() if len(t or "") < 4000]
    assert len(got) == len(docs) and all(got[i] == expected_runs(i, docs[i]) for i in short)


@pytest.mark.parametrize("name", ["op11_periodic_runs", "op12_covariance_outliers", "op13_merkle_manifest"])
def test_empty_tables(spark, scratch, name):
    frame(spark, []).write.parquet(f"{scratch}/documents.parquet")
    assert queries.QUERIES[name](spark, scratch).collect() == []


def expected_counts(text):
    words, text = (text or "").encode().split(), text or ""
    lines = [x for x in text.split("\n") if x.encode().split()]
    seen = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = {w for w in seen if seen.count(w) > 1} if len(seen) < 600 else None
    repeat = None if often is None else len({k for i, w in enumerate(seen) if w in often for k in range(i, i + 8)})
    dup = sum(x in lines[:i] for i, x in enumerate(lines)) if len(lines) < 500 else None
    return len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text), dup, repeat


def test_op12_base_counts(spark, folder):
    rows = queries.QUERIES["op12_covariance_outliers"](spark, folder).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    for r in rows:
        want = expected_counts(docs[r.doc_id])
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert all(w is None or w == g for w, g in zip(want, got))
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)


def plain_estimate(x, share=outliers.HALF):
    """Concentration steps from many random starts in memory, with the same floors."""
    rng, best = np.random.default_rng(6), None
    for _ in range(60):
        chosen = rng.choice(len(x), 10, replace=False)
        for _ in range(40):
            cov = np.cov(x[chosen].T, bias=True) + np.diag(outliers.FLOORS**2)
            y = x - x[chosen].mean(0)
            d = (y * np.linalg.solve(cov, y.T).T).sum(1)
            chosen = np.argsort(d, kind="stable")[: int(np.ceil(share * len(x)))]
        cov = np.cov(x[chosen].T, bias=True) + np.diag(outliers.FLOORS**2)
        size = np.linalg.slogdet(cov)[1]
        if best is None or size < best[0]:
            best = size, x[chosen].mean(0), cov
    return best


def made_table(pick):
    """Prose of two sources and a small one; junk with many signs and long words among it."""
    rows = []
    for i in range(700):
        words = [f"{'abcdefgh'[pick.randrange(8)] * pick.randrange(2, 8)}{pick.randrange(40)}" for _ in range(pick.randrange(60, 300))]
        if i % 7 == 0:
            words = [w + "#$" * 6 if k % 2 else w for k, w in enumerate(words)]
        lines = [" ".join(words[k : k + 12]) for k in range(0, len(words), 12)]
        rows.append((i, "\n".join(lines), "en" if i % 3 else None, "big" if i % 2 else f"small{i % 40}"))
    return rows


def test_op12_estimate_is_that_of_random_starts(spark):
    rows = made_table(random.Random(7))
    got = {r.doc_id: r for r in outliers.judge(frame(spark, rows)).collect()}
    for lang in ("en", None):
        cell = [r for r in rows if r[2] == lang and r[3] == "big"]
        counts = np.array([outliers.text_counts(r[1].encode(), len(r[1])) for r in cell])
        x = outliers.vectors(counts)
        _, centre, cov = plain_estimate(x)
        y = x - centre
        want = (y * np.linalg.solve(cov, y.T).T).sum(1)
        want *= outliers._TYPICAL / np.median(want)
        mine = np.array([got[r[0]].distance for r in cell])
        assert np.median(np.abs(mine / want - 1)) < 0.05
        assert ((mine > outliers.CUT) == (want > outliers.CUT)).mean() > 0.99
    assert all(got[i].kept == bool(i % 7) for i, *_ in rows)


def test_op12_odd_rows(spark):
    rows = made_table(random.Random(8))[:120]
    odd = [(None, None, None, None), (1000, "", "en", "big"), (1001, "#" * 100_000, "en", "big"), (1002, "word " * 19, "xx", "one")]
    odd += [(1003, "few words of a source that nobody else has but with more than twenty of them so that it must be judged by all", "xx", "one")] * 2
    got = outliers.judge(frame(spark, [*rows, *odd])).collect()
    assert len(got) == len(rows) + len(odd)
    by_id = {r.doc_id: r for r in got}
    assert by_id[None].base_failed and by_id[1000].base_failed and by_id[1001].base_failed and by_id[1002].base_failed
    lone = outliers.judge(frame(spark, odd)).collect()  # no cell is large enough for an estimate
    assert [r.kept for r in lone if r.doc_id == 1003] == [True, True]
    same = outliers.judge(frame(spark, [(5, rows[1][1], "en", "s")] * 300)).collect()  # no spread at all
    assert len(same) == 300 and all(r.kept and r.distance < 10 for r in same)


def test_op12_keeps_clean_documents(spark):
    folder = "/root/testdata/sf0.1"
    rows = queries.QUERIES["op12_covariance_outliers"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    judged = [r for r in rows if not r.base_failed]
    assert np.mean([r.kept for r in judged if r.quality == 1]) > 0.99
    assert np.mean([r.kept for r in judged if r.quality == 0]) < 0.05


def text_of(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def hexed(*texts):
    return sha256("".join(texts).encode()).hexdigest()


def brute_tree(nodes):
    """Root, and per leaf its siblings as (is left, digest) or None, level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(at):
            other = p ^ 1
            paths[i].append((other < p, nodes[other]) if other < len(nodes) else None)
        nodes = [hexed(*nodes[k : k + 2]) for k in range(0, len(nodes), 2)]
        at = [p // 2 for p in at]
    return nodes[0], paths


def brute_manifest(rows):
    trees = {}
    for r in rows:
        parts = [text_of(v) for v in (r.doc_id, r.source, r.lang, r.n_chars, r.text)]
        changed = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0 and r.n_chars is not None
        claimed = [*parts[:3], text_of(r.n_chars + 1 if changed else r.n_chars), parts[4]]
        trees.setdefault(r.lang, []).append(((r.doc_id is not None, r.doc_id or 0, hexed(*parts)), hexed(*claimed)))
    langs = sorted(trees, key=lambda g: (g is not None, (g or "").encode()))
    built = {g: brute_tree([leaf for (_, _, leaf), _ in sorted(trees[g])]) for g in langs}
    root, far = brute_tree([built[g][0] for g in langs])
    out = []
    for k, g in enumerate(langs):
        for ((has, doc_id, leaf), claimed), path in zip(sorted(trees[g]), built[g][1]):
            folded, proof = claimed, []
            for step in [*path, *far[k]]:
                folded = hexed(folded) if step is None else hexed(step[1], folded) if step[0] else hexed(folded, step[1])
                proof += [step[1]] if step else []
            out.append((doc_id if has else None, leaf, built[g][0], root, hexed(*proof), folded, folded == root))
    return out


@pytest.mark.parametrize("bits, sizes", [(1, [1]), (1, [5, 8, 1]), (2, [37, 4, 16, 2]), (2, [64, 65, 63]), (10, [37, 4, 1])])
def test_manifest_by_brute_force(spark, bits, sizes):
    names = [None, "z", "é", "aa", ""]
    rows = [(1000 * k + i, f"text {i % 7}", names[k], None if i % 5 == 0 else f"s{i % 3}") for k, n in enumerate(sizes) for i in range(n)]
    rows += [(None, None, names[0], "x")] + [(3, "same", names[0], "s")] * 6  # repeated rows and no id
    docs = frame(spark, rows).repartition(5)
    got = merkle.verify(merkle.tampered(docs), bits=bits, proofs=True).collect()
    columns = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    want = brute_manifest(docs.collect())
    key = lambda r: tuple(str(v) for v in r)
    assert sorted((tuple(r[c] for c in columns) for r in got), key=key) == sorted(want, key=key)
    assert all(hexed(*r.proof) == r.proof_sha256 for r in got)
    assert any(not r.verified for r in got) or sum(sizes) < 3


def test_manifest_matches_sql(spark, folder):
    name = "op13_merkle_manifest"
    assert difference(queries.QUERIES[name](spark, folder), duck(folder), queries.SQL[name]) is None


def test_claims_of_other_columns_fail(spark):
    docs = frame(spark, [(i, "t", "en", "s") for i in range(20)])
    leaves = merkle.leaves(docs, F.when(F.col("doc_id") == 7, F.lit(99)))
    assert [r.doc_id for r in merkle.verify(leaves).collect() if not r.verified] == [7]
