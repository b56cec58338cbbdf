"""Merkle manifest of a table: a tree per language, subtrees exchanged by cogrouped superblocks."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import strings, task, written

#: A superblock holds two to this power of leaves, or of nodes further up.
BITS = 10
_NODES = "tree string, n long, pos long, digest string"


def digest(*columns: Column) -> Column:
    """Hex SHA-256 of the values, each as its length in bytes, a colon and its text, or as - where it is null."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t), F.lit(":"), t), F.lit("-")) for t in texts)), 256)


def _row(n_chars: Column) -> Column:
    return digest(F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))


def leaves(docs: DataFrame, claimed_n_chars: Column | None = None) -> DataFrame:
    """doc_id, lang, leaf and claimed: the digest of each row, and that with another n_chars where one is claimed.

    claimed is null where `claimed_n_chars` is.
    """
    claim = F.lit(None).cast("string") if claimed_n_chars is None else F.when(claimed_n_chars.isNotNull(), _row(claimed_n_chars))
    return docs.select("doc_id", "lang", _row(F.col("n_chars")).alias("leaf"), claim.alias("claimed"))


def tampered(docs: DataFrame) -> DataFrame:
    """The leaves, with one more n_chars claimed where 7 divides the CRC-32 of the decimal doc_id."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return leaves(docs, F.when(chosen, F.col("n_chars") + 1))


def _placed(rows: DataFrame, *order: str) -> DataFrame:
    """Adds pos, the place within the row's tree, and n, the tree's size.

    Rows are dealt by range, so a tree of any size is spread; only the sizes of the parts are summed up. Rows
    equal in `order` are told apart by a number written with them.
    """
    rows = written(rows.withColumn("_number", F.monotonically_increasing_id()), "merkle-leaves")
    kept = [f for f in rows.schema if f.name != "_number"]
    keys = ["tree", *order, "_number"]
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_number")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            trees, first, of = np.unique(np.array(strings(batch.column("tree")), object), return_index=True, return_inverse=True)
            within = np.arange(batch.num_rows) - first[of] + np.array([seen[t] for t in trees.tolist()], np.int64)[of]
            seen.update(dict(zip(trees.tolist(), np.bincount(of).tolist())))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept), pa.array(np.full(batch.num_rows, task(), np.int32)), pa.array(within, pa.int64())],
                [*(f.name for f in kept), "part", "within"],
            )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    parts = written(ordered.mapInArrow(count, f"{schema}, part int, within long"), "merkle-placed")
    tree = Window.partitionBy("tree")
    sizes = parts.groupBy("tree", "part").agg(F.count("*").alias("size"))
    before = F.sum("size").over(tree.orderBy("part")) - F.col("size")
    sizes = sizes.select("tree", "part", before.alias("before"), F.sum("size").over(tree).alias("n"))
    placed = parts.join(sizes, ["tree", "part"])
    return placed.withColumn("pos", F.col("before") + F.col("within")).drop("part", "within", "before")


def _hex(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def _levels(nodes: list[str], n: int, bits: int) -> list[list[str]]:
    """The nodes of a superblock and those above them, as far as the superblock or its tree of n nodes reaches."""
    out = [nodes]
    for _ in range(min(bits, (n - 1).bit_length())):
        nodes = [_hex("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)]
        out.append(nodes)
    return out


def _path(levels: list[list[str]], at: int) -> list[str]:
    """What each step up joins: L or R and the sibling on that side, or nothing."""
    out = []
    for nodes in levels[:-1]:
        other = at ^ 1
        out.append(f"{'L' if at & 1 else 'R'}{nodes[other]}" if other < len(nodes) else "")
        at >>= 1
    return out


def _folded(leaf: str, path: list[str]) -> str:
    for step in path:
        leaf = _hex(step[1:] + leaf if step[:1] == "L" else leaf + step[1:])
    return leaf


def _block(bits: int) -> Column:
    return F.shiftright("pos", bits).alias("block")


def _tops(nodes: DataFrame, bits: int) -> DataFrame:
    """The node on top of each superblock, as nodes of a tree of superblocks."""

    def reduce(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        n = int(rows["n"].iloc[0])
        levels = _levels(rows["digest"].tolist(), n, bits)
        top = [(rows["tree"].iloc[0], -(-n >> (len(levels) - 1)) if n > 1 else 1, int(rows["pos"].iloc[0]) >> bits, levels[-1][0])]
        return pd.DataFrame(top, columns=["tree", "n", "pos", "digest"])

    return nodes.select("tree", "n", "pos", "digest").groupBy("tree", _block(bits)).applyInPandas(reduce, _NODES)


def _outer(nodes: DataFrame, above: DataFrame, bits: int) -> DataFrame:
    """tree, block, path, root of the nodes' superblock from those of the superblocks above it."""

    def join(rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        levels = _levels(rows["digest"].tolist(), int(rows["n"].iloc[0]), bits)
        path, root = list(outer["path"].iloc[0]), outer["root"].iloc[0]
        found = [(t, p, _path(levels, i) + path, root) for i, (t, p) in enumerate(zip(rows["tree"], rows["pos"]))]
        return pd.DataFrame(found, columns=["tree", "block", "path", "root"])

    left = nodes.select("tree", "n", "pos", "digest").groupBy("tree", _block(bits))
    return left.cogroup(above.groupBy("tree", "block")).applyInPandas(join, "tree string, block long, path array<string>, root string")


def _paths_above(nodes: DataFrame, bits: int) -> DataFrame:
    """tree, block, path, root: the outer nodes that each superblock of `nodes` needs on the way to its tree's root.

    Tops of superblocks are reduced by superblocks again until every tree has one node, then paths come down
    the same way. Each level has one row of 2 ** bits of the one below.
    """
    tops = written(_tops(nodes, bits), "merkle-tops")
    chain = [tops]
    while (chain[-1].agg(F.max("n")).first()[0] or 0) > 1:
        chain.append(written(_tops(chain[-1], bits), "merkle-tops"))
    path = chain[-1].select("tree", F.col("pos").alias("block"), F.array().cast("array<string>").alias("path"), F.col("digest").alias("root"))
    for level in reversed(chain[:-1]):
        path = written(_outer(level, path, bits), "merkle-paths")
    return path


def verify(leaf_rows: DataFrame, bits: int = BITS, proofs: bool = False) -> DataFrame:
    """doc_id, lang, leaf, subroot, root, proof_sha256, folded_root, verified for rows of `leaves`.

    Per lang, leaves ascend by doc_id, nulls first, then by digest; two neighbours give a node, a last one alone gives one
    by itself, until one node is left. The subroots, null lang first, then by UTF-8 bytes, form a tree in the same
    way. proof_sha256 is of the siblings on the way to the root, one after the other; with `proofs` the column
    proof holds them. folded_root starts from the claimed leaf, or from the leaf where none is claimed.

    A leaf's superblock is cogrouped with the outer nodes it needs, so a task holds 2 ** bits leaves at a time
    whatever the languages' sizes. Rows equal in everything are leaves of their own. A null lang is a language of its own.
    No rows give no rows.
    """
    kind, lang_kind = (leaf_rows.schema[c].dataType for c in ("doc_id", "lang"))
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit(""))
    rows = leaf_rows.select("doc_id", tree.alias("tree"), F.col("leaf").alias("digest"), "claimed")
    placed = written(_placed(rows, "doc_id", "digest"), "merkle-leaves")
    inner = _paths_above(placed, bits)

    roots = inner.groupBy("tree").agg(F.first("root").alias("digest"))
    langs = written(_placed(roots.select(F.lit("").alias("tree"), "digest", F.col("tree").alias("lang_tree")), "lang_tree"), "merkle-langs")
    whole = _outer(langs, _paths_above(langs, bits), bits)
    whole = langs.join(whole.select(F.col("block").alias("pos"), "path", "root"), "pos")
    whole = whole.select(F.col("lang_tree").alias("tree"), F.col("path").alias("rest"), F.col("root").alias("whole_root"))
    outer = written(inner.join(whole, "tree"), "merkle-outer")

    fields = ["key", "tree", "leaf", "subroot", "root", "proof_sha256", "folded_root", "proof"][: 8 if proofs else 7]

    def finish(rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        rows, up = rows.sort_values("pos"), outer.iloc[0]
        levels = _levels(rows["digest"].tolist(), int(rows["n"].iloc[0]), bits)
        far = [*up["path"], *up["rest"]]
        found = []
        for i, (key, tree, leaf, claimed) in enumerate(zip(rows["key"], rows["tree"], rows["digest"], rows["claimed"])):
            path = _path(levels, i) + far
            siblings = [step[1:] for step in path if step]
            folded = _folded(leaf if claimed is None else claimed, path)
            found.append((key, tree, leaf, up["root"], up["whole_root"], _hex("".join(siblings)), folded, siblings)[: len(fields)])
        return pd.DataFrame(found, columns=fields)

    schema = ", ".join(f"{c} string" for c in fields[:7]) + (", proof array<string>" if proofs else "")
    keyed = placed.select(F.col("doc_id").cast("string").alias("key"), "tree", "n", "pos", "digest", "claimed")  # pandas has no whole numbers with nulls
    done = keyed.groupBy("tree", _block(bits)).cogroup(outer.groupBy("tree", "block")).applyInPandas(finish, schema)
    lang = F.when(F.col("tree") != "", F.substring("tree", 2, 1 << 30)).cast(lang_kind)
    return done.select(
        F.col("key").cast(kind).alias("doc_id"), lang.alias("lang"), *fields[2:], (F.col("folded_root") == F.col("root")).alias("verified")
    )


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::varchar))::varchar || ':' || {value}::varchar, '-')"


def _leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', n_chars, 'text')))})"


def _tree(name: str, nodes: str) -> str:
    """Recursive SQL that gives all levels of the trees over `nodes` (tree, pos, digest)."""
    return f"""
{name}(tree, level, pos, digest) AS (
  SELECT tree, 0, pos, digest FROM {nodes}
  UNION ALL
  SELECT tree, level + 1, pos // 2, sha256(digest || coalesce(following, ''))
  FROM (SELECT *, lead(digest) OVER (PARTITION BY tree ORDER BY pos) AS following, count(*) OVER (PARTITION BY tree) AS n FROM {name})
  WHERE n > 1 AND pos % 2 = 0
),
{name}_root AS (SELECT tree, max(level) AS height, arg_max(digest, level) AS root FROM {name} GROUP BY tree)"""


def _climb(name: str, tree: str, rows: str) -> str:
    """Recursive SQL that joins the siblings of `rows` (id, tree, pos, proof, folded) up to the root of their tree."""
    return f"""
{name}(id, tree, pos, level, proof, folded) AS (
  SELECT id, tree, pos, 0, proof, folded FROM {rows}
  UNION ALL
  SELECT c.id, c.tree, c.pos // 2, c.level + 1, c.proof || coalesce(s.digest, ''),
    sha256(CASE WHEN c.pos % 2 = 1 THEN s.digest || c.folded ELSE c.folded || coalesce(s.digest, '') END)
  FROM {name} c JOIN {tree}_root r ON r.tree = c.tree AND c.level < r.height
  LEFT JOIN {tree} s ON s.tree = c.tree AND s.level = c.level AND s.pos = xor(c.pos, 1)
)"""


SQL = f"""
WITH RECURSIVE
bits(v, c, k) AS (
  SELECT range, range, 0 FROM range(256)
  UNION ALL SELECT v, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
),
sums(doc_id, c, k) AS (
  SELECT DISTINCT doc_id, 4294967295::bigint, 0 FROM documents
  UNION ALL
  SELECT s.doc_id, xor(s.c >> 8, b.c), s.k + 1
  FROM sums s JOIN bits b ON b.k = 8 AND s.k < length(s.doc_id::varchar) AND b.v = xor(s.c & 255, ascii(substr(s.doc_id::varchar, s.k + 1, 1)))
),
chosen AS (SELECT doc_id FROM sums WHERE k = length(doc_id::varchar) AND xor(c, 4294967295) % 7 = 0),
leaf AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf('n_chars')} AS digest,
    CASE WHEN n_chars IS NOT NULL AND doc_id IN (FROM chosen) THEN {_leaf('(n_chars + 1)')} END AS claimed
  FROM documents
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos, row_number() OVER () AS id FROM leaf
),
{_tree('node', 'placed')},
lang_placed AS (SELECT '' AS tree, tree AS lang_tree, row_number() OVER (ORDER BY tree) - 1 AS pos, root AS digest FROM node_root),
{_tree('top', 'lang_placed')},
start AS (SELECT id, tree, pos, '' AS proof, coalesce(claimed, digest) AS folded FROM placed),
{_climb('climb', 'node', 'start')},
arrived AS (
  SELECT c.id, '' AS tree, l.pos, c.proof, c.folded FROM climb c
  JOIN node_root r ON r.tree = c.tree AND r.height = c.level JOIN lang_placed l ON l.lang_tree = c.tree
),
{_climb('climb_top', 'top', 'arrived')}
SELECT p.doc_id, p.digest AS leaf, n.root AS subroot, t.root, sha256(c.proof) AS proof_sha256, c.folded AS folded_root, c.folded = t.root AS verified
FROM placed p JOIN node_root n ON n.tree = p.tree CROSS JOIN top_root t
JOIN climb_top c ON c.id = p.id AND c.level = t.height
"""
