"""The pipeline's stages and its one query with SQL."""

import random

import corpus_pipeline
from stratalake.llm import queries
from tests.compare import difference, duck


def test_site_lines_match_sql(spark, folder):
    name = "op9_site_lines"
    assert difference(queries.QUERIES[name](spark, folder), duck(folder), queries.SQL[name]) is None


def test_stages_keep_the_columns_of_documents(spark, scratch):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    toxic = {r.doc_id for r in spark.read.parquet(f"{folder}/labels.parquet").filter("toxic = 1").collect()}
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{scratch}/{k}")
        docs = spark.read.parquet(f"{scratch}/{k}")
        left = {r.doc_id for r in docs.select("doc_id").collect()}
        assert left <= ids
        ids = left
        if k == 0:
            assert len(ids & toxic) <= 0.2 * len(toxic)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    assert docs.count() == corpus_pipeline.run(spark, folder).count()


def test_near_copies_leave_one_row_of_each_group(spark):
    pick = random.Random(4)
    prose = [[f"w{pick.randrange(3000)}" for _ in range(80)] for _ in range(4)]
    near = [" ".join([*prose[0][:k], "edit", *prose[0][k + 1 :]]) for k in (0, 78)]
    base = [" ".join(p) for p in prose]
    rows = [(5, base[0])] * 30 + [(5, near[0]), (9, near[1]), (None, base[0])]  # one group, least id repeated
    rows += [(5, base[1]), (None, base[2]), (None, base[2]), (3, base[3]), (3, base[3]), (4, None), (4, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)

    def shingles(text):
        words = (text or "").split()
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}

    groups = []  # brute force: exact Jaccard, joined to components
    for row in rows:
        own = shingles(row[1])
        alike = [g for g in groups if own and any(len(own & shingles(t)) >= 0.8 * len(own | shingles(t)) > 0 for _, t in g)]
        groups = [g for g in groups if g not in alike] + [[row, *(r for g in alike for r in g)]]
    left = [tuple(r) for r in corpus_pipeline.near_copies(spark, docs, "").collect()]
    assert len(left) == len(groups) == 7
    for group in groups:
        ids = [i for i, _ in group if i is not None]
        least = min(ids) if ids else None
        assert any(r in group and r[0] == least for r in left)
