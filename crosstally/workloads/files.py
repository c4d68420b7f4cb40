"""Registered queries of sources and sinks: given tables go through files and tables and back."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from crosstally.operators import copies, quality as q
from crosstally.session import shared_folder
from crosstally.sources import sinks, snapshots as src
from crosstally.workloads.ledgers import comparable, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        ORACLE[function.__name__] = sql
        return function

    return register


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/files/{uuid.uuid4().hex}"


def _as_text(df: DataFrame) -> DataFrame:
    return df.select(*(F.col(c).cast("string").alias(c) for c in df.columns))


def _write_csv(df: DataFrame, path: str, **options: object) -> str:
    df.write.options(header=True, quote='"', escape='"', **options).csv(path)
    return path


@query("""
    SELECT doc_id, lang, source, length(text) AS n_chars, md5(text) AS text_md5
    FROM (SELECT doc_id, lang, source, nullif(text, '') AS text FROM documents)
""")
def text_snapshot(spark, sf):
    """Whole texts, with quotes, separators and line breaks, through a header CSV."""
    docs = _as_text(table(spark, sf, "documents").select("doc_id", "lang", "source", "text"))
    path = _write_csv(docs, _folder(spark), lineSep="\n", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    back = src.read_snapshot(spark, path, docs.columns, multiline=True)
    return back.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "lang", "source",
        F.length("text").cast("bigint").alias("n_chars"), F.md5("text").alias("text_md5"),
    )


#: Characters of code page 1252 that Latin-1 lacks, and the bytes that stand for them: fixed values.
_PAGE_1252 = {"€": 0x80, "–": 0x96, "Š": 0x8A, "œ": 0x9C}


@query("""
    SELECT c_custkey AS k, 'Café ' || c_mktsegment || CASE c_custkey % 4 WHEN 0 THEN ' €; –' WHEN 1 THEN ' Šœ' ELSE '' END
        AS label, replace(CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR), '.', ',') AS balance
    FROM customer
""")
def code_page_snapshot(spark, sf):
    """Semicolons, decimal commas and code page 1252."""
    rows = table(spark, sf, "customer").selectExpr(
        "CAST(c_custkey AS STRING) AS `Customer No.`",
        "concat('Café ', c_mktsegment, CASE c_custkey % 4 WHEN 0 THEN ' €; –' WHEN 1 THEN ' Šœ' ELSE '' END) AS `Label`",
        "replace(CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS STRING), '.', ',') AS `Balance (EUR)`",
    )
    bytes_1252 = F.translate("Label", "".join(_PAGE_1252), "".join(map(chr, _PAGE_1252.values())))
    path = _write_csv(rows.withColumn("Label", bytes_1252), _folder(spark), sep=";", encoding="ISO-8859-1")
    back = src.read_snapshot(spark, path, sep=";", encoding="cp1252", lineage=False)
    return back.select(
        src.raw("Customer No.").cast("bigint").alias("k"), F.col("Label").alias("label"),
        src.raw("Balance (EUR)").alias("balance"),
    )


def _monthly_files(spark, sf, headers: str, extra: str) -> str:
    """A titled file for each month of orders: a title of its own, header lines, rows, one like a title."""
    orders = table(spark, sf, "orders").selectExpr(
        "date_format(o_orderdate, 'yyyy-MM') AS file", "o_orderkey AS k",
        "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) AS price",
    )
    rows = orders.selectExpr("file", "2 AS part", "k", f"concat(k, ',', price, {extra}) AS value")
    tops = orders.groupBy("file").agg(F.min("k").alias("k"))
    titles = tops.selectExpr(
        "file", "0 AS part", "k",
        "CASE k % 3 WHEN 0 THEN concat('Earnings of ', file) WHEN 1 THEN 'key' ELSE '17,4.20' END AS value",
    )
    heads = tops.selectExpr("file", "1 AS part", "k", f"explode(array_repeat('key,price', {headers})) AS value")
    similar = tops.selectExpr("file", "3 AS part", "k", "concat('Earnings of ', file) AS value")
    lines = rows.unionByName(titles).unionByName(heads).unionByName(similar)
    path = _folder(spark)
    dealt = lines.repartition("file").sortWithinPartitions("file", "part", "k")
    dealt.select("file", "value").write.partitionBy("file").text(path)
    return path


def _file():
    return F.regexp_extract(src.SOURCE_FILE, r"file=([0-9-]+)", 1).alias("file")


@query("""
    SELECT strftime(o_orderdate, '%Y-%m') AS file, CAST(o_orderkey AS VARCHAR) AS key,
        CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price
    FROM orders
    UNION ALL
    SELECT DISTINCT strftime(o_orderdate, '%Y-%m'), 'Earnings of ' || strftime(o_orderdate, '%Y-%m'), NULL FROM orders
""")
def titled_snapshot(spark, sf):
    """Files that open with titles of any wording, even one like a row; a row like a title stays."""
    path = _monthly_files(spark, sf, "1", "''")
    return src.read_titled_snapshot(spark, path, ["key", "price"]).select(_file(), "key", "price")


@query("""
    SELECT * FROM (
        SELECT strftime(o_orderdate, '%Y-%m') AS file, 1 AS title_lines, min(o_orderkey) % 3 AS header_lines,
            count(*) FILTER (o_orderkey % 64 = 5) AS long_lines
        FROM orders GROUP BY ALL)
    WHERE header_lines <> 1 OR long_lines > 0
""")
def check_titled_files(spark, sf):
    """Files without exactly one header line, or with rows that have too many fields."""
    path = _monthly_files(spark, sf, "CAST(k % 3 AS INT)", "IF(k % 64 = 5, ',more', '')")
    return src.titled_line_problems(spark, path, ["key", "price"]).select(
        _file(), "title_lines", "header_lines", "long_lines"
    )


@query("""
    SELECT 'priority=' || o_orderpriority AS folder, count(*) AS raw_rows,
        count(DISTINCT (o_orderstatus, strftime(o_orderdate, '%Y-%m'))) AS staged_rows
    FROM orders GROUP BY ALL
""")
def row_lineage(spark, sf):
    """Each row names its file: equal rows of two folders are no copies of each other."""
    orders = table(spark, sf, "orders").selectExpr(
        "o_orderpriority AS priority", "o_orderstatus AS status", "date_format(o_orderdate, 'yyyy-MM') AS month"
    )
    path = _folder(spark)
    orders.write.partitionBy("priority").option("header", True).csv(path)
    rows = src.read_snapshot(spark, path, ["status", "month"])
    folder = F.regexp_extract(F.url_decode(src.SOURCE_FILE), "/(priority=[^/]*)/", 1)
    by_folder = rows.withColumn(src.SOURCE_FILE, folder)
    sizes = by_folder.groupBy(src.SOURCE_FILE).agg(F.count("*").alias("raw_rows"))
    staged = copies.drop_exact_copies(by_folder).groupBy(src.SOURCE_FILE).agg(F.count("*").alias("staged_rows"))
    return sizes.join(staged, src.SOURCE_FILE).withColumnRenamed(src.SOURCE_FILE, "folder")


@query("""
    SELECT n_name AS missing FROM nation
    WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)
""")
def missing_inputs(spark, sf):
    """All inputs that a run lacks, named at once: one is expected for each nation."""
    path = _folder(spark)
    suppliers = table(spark, sf, "supplier").filter("s_acctbal > 5000")
    suppliers.write.partitionBy("s_nationkey").option("header", True).csv(path)
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name").collect()  # 25 by definition
    expected = {f"{path}/s_nationkey={n['n_nationkey']}": n["n_name"] for n in nations}
    missing: list[str] = []
    try:
        src.require_inputs(spark, expected)
    except src.MissingInputs as error:
        missing = error.missing
    return spark.createDataFrame([(expected[m],) for m in missing], "missing string")


@query("""
    SELECT c_mktsegment AS segment, strftime(o_orderdate, '%Y-%m') AS month, count(*) AS orders,
        CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
    FROM orders JOIN customer ON c_custkey = o_custkey
    WHERE year(o_orderdate) = 1995 GROUP BY ALL
""")
def layer_tables(spark, sf):
    """Layers bucketed by the join key and partitioned by month; one year's months are read."""
    layer = f"layer_{uuid.uuid4().hex}"
    orders = table(spark, sf, "orders").selectExpr(
        "o_custkey AS custkey", "CAST(o_totalprice AS DECIMAL(18,2)) AS price", "o_orderdate"
    )
    customers = table(spark, sf, "customer").selectExpr("c_custkey AS custkey", "c_mktsegment AS segment")
    facts = sinks.save_table(orders, layer, "orders", bucket_by=["custkey"], month_of="o_orderdate")
    names = sinks.save_table(customers, layer, "customers", bucket_by=["custkey"])
    months = facts.filter("month >= '1995-01' AND month <= '1995-12'")
    sums = months.join(names.hint("merge"), "custkey").groupBy("segment", "month")
    return comparable(sums.agg(F.count("*").alias("orders"), F.sum("price").alias("value")), {"value": 2})


@query("""
    SELECT 'report' AS kind, o_orderpriority AS name, CAST(count(*) AS VARCHAR) AS value FROM orders GROUP BY ALL
    UNION ALL
    SELECT 'blocked', 'unfinished', CAST(count(*) AS VARCHAR) FROM orders WHERE o_orderstatus = 'O'
    UNION ALL
    SELECT 'runs', 'published', '1'
""")
def gated_publication(spark, sf):
    """A report that its checks let through; a failed check blocks the next and leaves the first."""
    folder = _folder(spark)
    orders = table(spark, sf, "orders")
    sizes = orders.groupBy(F.col("o_orderpriority").alias("name")).agg(F.count("*").alias("value"))
    columns = [F.col("name"), F.col("value")]
    passing = q.counted("no_name", sizes.filter("name IS NULL"))
    sinks.publish({"sizes": sinks.Report(sizes, columns, ["name"])}, [passing], folder)
    changed = sinks.Report(sizes.withColumn("value", F.lit(0)), columns, ["name"])
    failed: dict[str, int] = {}
    try:
        sinks.publish({"sizes": changed}, [passing, q.counted("unfinished", orders.filter("o_orderstatus = 'O'"))], folder)
    except sinks.PublicationBlocked as error:
        failed = error.failed
    report = sinks.read_published(spark, folder, "sizes").selectExpr("'report' AS kind", "name", "value")
    blocked = spark.createDataFrame([("blocked", k, str(v)) for k, v in failed.items()], "kind string, name string, value string")
    runs = sinks.published_runs(spark, folder).selectExpr("'runs' AS kind", "'published' AS name", "CAST(count(*) AS STRING) AS value")
    return report.unionByName(blocked).unionByName(runs)


@query("""
    SELECT unnest(['not_null:orders.o_custkey', 'accepted_values:orders.o_orderstatus', 'cheap', 'rows']) AS "check",
        unnest([count(*) FILTER (o_custkey IS NULL), count(*) FILTER (o_orderstatus NOT IN ('F', 'O')),
                count(*) FILTER (o_totalprice < 5000), count(*)]) AS violations
    FROM orders
""")
def counted_layer(spark, sf):
    """Violations counted while a layer is written, beside the rows that it then holds."""
    orders = table(spark, sf, "orders")
    cheap = {"cheap": F.col("o_totalprice") < 5000}
    counts = q.column_counts("orders", ["o_custkey"], {"o_orderstatus": ["F", "O"]}, cheap)
    written, found = sinks.materialise_counted(orders, f"files/{uuid.uuid4().hex}", "orders", counts)
    rows = written.agg(F.lit("rows").alias("check"), F.count("*").alias("violations"))
    if found is None:
        return q.counts_of(written, counts).unionByName(rows)
    return spark.createDataFrame(list(found.items()), "check string, violations long").unionByName(rows)
