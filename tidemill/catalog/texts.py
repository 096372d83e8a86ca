"""Regular expressions, delimited lines, HTML elements and binary payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions import text
from tidemill.operators.quality import text_number_status
from tidemill.plans.testbed import table
from tidemill.sources import files, html


def regex_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "documents").select("doc_id", text.find_emails("text").alias("found"))
    return found.select("doc_id", F.size("found").alias("n"), F.array_join("found", "|").alias("emails"))


def regex_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "documents").select("doc_id", text.split_words("text").alias("words"))
    return words.select("doc_id", F.size("words").alias("n"), F.array_join("words", "|").alias("words"))


def regex_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.mask("text").alias("text"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as padded comma lines; some marks are blank, some are words."""
    marks = (
        F.when(F.col("c_nationkey") == 3, F.lit("  "))
        .when(F.col("c_nationkey") == 7, F.col("c_mktsegment"))
        .otherwise(F.floor(F.col("c_acctbal") / 80).cast("string"))
    )
    line = F.concat_ws(",", F.col("c_custkey").cast("string"), F.concat(F.lit(" "), "c_name", F.lit("\t")), marks)
    return table(spark, sf_dir, "customer").select(line.alias("line"))


def text_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = _lines(spark, sf_dir).select(*files.split_line("line", ["id", "name", "marks"]))
    return fields.select(
        F.col("id").try_cast("bigint").alias("id"),
        "name",
        F.col("marks").try_cast("int").alias("marks"),
        text_number_status("marks", 0, 100).alias("status"),
    )


def html_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = table(spark, sf_dir, "pages").select("page_id", html.link_targets("html").alias("links"))
    return links.select("page_id", F.size("links").alias("n"), F.array_join("links", "|").alias("links"))


def html_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", html.page_title("html").alias("title"))


def html_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as a page whose second table holds its attributes."""
    page = F.concat(
        F.lit("<html><body><table><tr><th>menu</th></tr><tr><td>home</td></tr></table><p>x</p>"
              "<table><thead><tr><th>id</th><th>name</th><th>segment</th></tr></thead><tbody><tr><td>"),
        F.col("c_custkey").cast("string"),
        F.lit("</td><td> "),
        F.col("c_name"),
        F.lit(" &amp; Co</td><td><b>"),
        F.col("c_mktsegment"),
        F.lit("</b></td></tr></tbody></table></body></html>"),
    )
    # the small columnar file is one split; its rows are dealt out before the pages, many times as large, are made
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment").repartition(n_parts)
    pages = customers.select(F.col("c_custkey").alias("page_id"), page.alias("html"))
    body = html.pick_table(html.extract_html_tables(pages, "page_id", "html"), 1, ["id", "name", "segment"])
    return body.select("page_id", F.col("id").try_cast("bigint").alias("id"), "name", "segment")


def binary_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    payload = table(spark, sf_dir, "documents").select("doc_id", F.encode("text", "UTF-8").alias("payload"))
    return payload.select("doc_id", F.octet_length("payload").alias("length"), F.md5("payload").alias("digest"))


QUERIES = {
    "regex_emails": regex_emails,
    "regex_split": regex_split,
    "regex_mask": regex_mask,
    "text_parse": text_parse,
    "html_links": html_links,
    "html_titles": html_titles,
    "html_tables": html_tables,
    "binary_length": binary_length,
}

_SPACE = r"[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_STRIPPED = f"regexp_replace(regexp_replace(text, '^{_SPACE}+', ''), '{_SPACE}+$', '')"

ORACLE = {
    "regex_emails": r"""SELECT doc_id, CAST(len(found) AS INTEGER) AS n, array_to_string(found, '|') AS emails
  FROM (SELECT doc_id, regexp_extract_all(text, '[\p{L}\p{N}_.-]+@[\p{L}\p{N}_.-]+\.[\p{L}\p{N}_]+') AS found FROM documents)""",
    "regex_split": f"""SELECT doc_id, CAST(len(words) AS INTEGER) AS n, array_to_string(words, '|') AS words
  FROM (SELECT doc_id, string_split_regex({_STRIPPED}, '{_SPACE}+') AS words FROM documents)""",
    "regex_mask": r"SELECT doc_id, regexp_replace(text, '\p{Nd}{10}', 'XXXXXXXXXX', 'g') AS text FROM documents",
    "text_parse": """SELECT c_custkey AS id, c_name AS name, m AS marks,
  CASE WHEN c_nationkey = 3 THEN 'missing' WHEN c_nationkey = 7 THEN 'invalid'
    WHEN m < 0 OR m > 100 THEN 'anomaly' ELSE 'ok' END AS status
  FROM (SELECT *, CASE WHEN c_nationkey NOT IN (3, 7) THEN CAST(floor(c_acctbal / 80) AS INTEGER) END AS m FROM customer)""",
    "html_links": r"""SELECT page_id, CAST(len(links) AS INTEGER) AS n, array_to_string(links, '|') AS links
  FROM (SELECT page_id, regexp_extract_all(html, '(?is)<a\s[^>]*?href="([^"]*)"', 1) AS links FROM pages)""",
    "html_titles": r"SELECT page_id, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS title FROM pages",
    "html_tables": """SELECT c_custkey AS page_id, c_custkey AS id, c_name || ' & Co' AS name, c_mktsegment AS segment
  FROM customer""",
    "binary_length": """SELECT doc_id, CAST(octet_length(encode(text)) AS INTEGER) AS length, md5(text) AS digest
  FROM documents""",
}
