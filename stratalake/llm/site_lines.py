"""Site-relative line frequency: lines on too large a share of a host's pages go."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import written

RATIO = 0.1
LEAST_PAGES = 3


def _key(line: Column) -> Column:
    return F.unhex(F.md5(F.trim(line)))


def site_lines(docs: DataFrame, host: str = "source", ratio: float = RATIO, least: int = LEAST_PAGES) -> DataFrame:
    """Per host, the digests of lines on more than `ratio` of its pages and on `least` pages at least.

    Columns host, boilerplate (array of digests). Lines are compared without blanks at either end;
    blank lines do not count. A page counts once for a line, however often it repeats it. As each
    line found fills more than `ratio` of the pages, a host has fewer of them than its mean
    number of lines a page divided by `ratio`: the array is short for any host.
    """
    pages = docs.select(F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), "text")
    lines = F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")
    seen = pages.select("host", F.explode(F.array_distinct(F.transform(lines, _key))).alias("line"))
    counts = seen.groupBy("host", "line").agg(F.count("*").alias("pages")).filter(F.col("pages") >= least)
    totals = pages.groupBy("host").agg(F.count("*").alias("total"))
    common = counts.join(totals, "host").filter(F.col("pages") > ratio * F.col("total"))
    return common.groupBy("host").agg(F.collect_list("line").alias("boilerplate"))


def drop_site_lines(docs: DataFrame, host: str = "source", ratio: float = RATIO, least: int = LEAST_PAGES) -> DataFrame:
    """The rows with the boilerplate lines of their host taken out of the text.

    Adds n_lines and n_dropped behind a struct `row` that holds the given columns, so no name can
    clash; n_chars, where there is one, follows the text. A null host counts as the host
    without a name, a null text has no lines and stays null, and a text that loses every
    line becomes empty. Rows that repeat are pages of their own. No rows give no rows.

    The lines found are written first, so their measured size decides how they meet the texts: Spark sends a small table to the
    texts, which then stay where they are; beyond its broadcast threshold the texts are dealt by host and adaptive
    execution splits a large one.
    """
    marked = docs.select(F.struct("*").alias("row")).withColumn("host", F.coalesce(F.col(f"row.{host}").cast("string"), F.lit("")))
    joined = marked.join(written(site_lines(docs, host, ratio, least), "site-lines"), "host", "left")
    lines = F.split("row.text", "\n")
    kept = F.filter(lines, lambda x: (F.trim(x) == "") | ~F.array_contains("boilerplate", _key(x)))
    kept = F.when(F.col("boilerplate").isNull(), lines).otherwise(kept)
    cut = joined.select(
        "row", F.coalesce(F.size(lines), F.lit(0)).alias("n_lines"), F.size(kept).alias("n_kept"),
        F.array_join(kept, "\n").alias("cut"),
    )
    text = F.when(F.col("n_kept") < F.col("n_lines"), F.col("cut")).otherwise(F.col("row.text"))
    row = F.col("row").withField("text", text)
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType))
    lost = F.when(F.col("row.text").isNull(), 0).otherwise(F.col("n_lines") - F.col("n_kept"))
    n_lines = F.when(F.col("row.text").isNull(), 0).otherwise(F.col("n_lines"))
    return cut.select(row.alias("row"), n_lines.cast("long").alias("n_lines"), lost.cast("long").alias("n_dropped"))


#: The same in SQL, over documents with unique doc_id.
SQL = f"""
WITH line AS (
    SELECT doc_id, coalesce(source, '') AS host, unnest(string_split(text, chr(10))) AS line,
        generate_subscripts(string_split(text, chr(10)), 1) AS pos
    FROM documents WHERE text IS NOT NULL
), total AS (
    SELECT coalesce(source, '') AS host, count(*) AS total FROM documents GROUP BY 1
), common AS (
    SELECT host, trim(line) AS line FROM line JOIN total USING (host) WHERE trim(line) <> ''
    GROUP BY host, trim(line), total
    HAVING count(DISTINCT doc_id) >= {LEAST_PAGES} AND count(DISTINCT doc_id) > {RATIO} * total
), kept AS (
    SELECT doc_id, count(*) AS n_lines, count(common.line) AS n_dropped,
        coalesce(string_agg(line.line, chr(10) ORDER BY pos) FILTER (WHERE common.line IS NULL), '') AS text
    FROM line LEFT JOIN common ON line.host = common.host AND trim(line.line) = common.line GROUP BY doc_id
)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dropped, 0)::BIGINT AS n_dropped,
    length(kept.text)::BIGINT AS n_chars, md5(kept.text) AS text_md5
FROM documents LEFT JOIN kept USING (doc_id)
"""
