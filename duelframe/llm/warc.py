"""Fixity of archived records: Merkle trees over ordered offset ranges, compared root first, branch by branch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duelframe.llm.text import released, stored
from duelframe.operators.ordering import dense_index

#: Records of one archive file, and children of one node: both bound what a group holds.
FILE_RECORDS = 1024
FANOUT = 16


def record(url: Column, body: Column) -> Column:
    """The bytes of a WARC response record with a fixed-order header; null parts count as empty."""
    body = F.coalesce(body.cast("string"), F.lit(""))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "),
        F.coalesce(url.cast("string"), F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return F.concat(head, body, F.lit("\r\n\r\n"))


def archived(pages: DataFrame) -> DataFrame:
    """``(page_id, url, place, file, offset, length, digest)``: where each record lies when written out.

    Records follow each other by ``page_id``, ``url`` and digest, nulls first; a file takes ``FILE_RECORDS`` of
    them and offsets count its bytes. Only digests and lengths are sorted, never the pages themselves; repeated
    rows are records of their own.
    """
    bytes_ = record(F.col("url"), F.col("html"))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.octet_length(bytes_).cast("long").alias("length"), F.sha2(bytes_, 256).alias("digest"))
    placed = dense_index(rows, ["page_id", "url", "digest"], "place").withColumn("place", F.col("place") - 1)
    placed = placed.withColumn("file", F.floor(F.col("place") / FILE_RECORDS))
    before = Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)  # FILE_RECORDS rows at most
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))


def merkle(records: DataFrame) -> list[DataFrame]:
    """Tree levels ``(node, hash)`` from the leaves up to one root; none for an empty table.

    A leaf hashes a record's file, offset, length and digest, so a moved record differs as a changed one does. A
    parent hashes its at most ``FANOUT`` children in order.
    """
    leaf = F.sha2(F.concat_ws("|", "file", "offset", "length", "digest"), 256)
    level = stored(records.select(F.col("place").alias("node"), leaf.alias("hash")), "merkle")
    levels = []
    while (top := level.agg(F.max("node")).first()[0]) is not None:
        levels.append(level)
        if top == 0:
            break
        parents = level.groupBy(F.floor(F.col("node") / FANOUT).alias("parent")).agg(F.array_sort(F.collect_list(F.struct("node", "hash"))).alias("own"))
        level = stored(parents.select(F.col("parent").alias("node"), F.sha2(F.array_join("own.hash", ""), 256).alias("hash")), "merkle")
    return levels


def mismatches(left: list[DataFrame], right: list[DataFrame]) -> DataFrame:
    """Leaf numbers ``(node)`` whose hashes differ or that one tree lacks, found from the roots down.

    On each level only the children of differing nodes are joined. A tree of fewer levels is read as one whose
    root stands for the first node of the level above.
    """
    top = max(len(left), len(right))
    spark = (left or right)[0].sparkSession
    bad = spark.range(1).select(F.col("id").alias("node"))
    for k in reversed(range(top)):
        sides = []
        for tree, name in ((left, "a"), (right, "b")):
            if k < len(tree):
                inside = bad.select(F.col("node").alias("parent")) if k < top - 1 else None
                level = tree[k].select("node", F.col("hash").alias(name), F.floor(F.col("node") / FANOUT).alias("parent"))
                sides.append(level.join(inside, "parent", "left_semi").drop("parent") if inside is not None else level.drop("parent"))
            else:
                sides.append(spark.createDataFrame([], f"node long, {name} string"))
        bad = stored(sides[0].join(sides[1], "node", "full").where("not (a <=> b)").select("node"), "differing")
    return bad


def audit(left: DataFrame, right: DataFrame) -> DataFrame:
    """``(place, state, a, b)`` for each record of two archived replicas that is not the same in both.

    ``state`` is ``changed``, ``missing`` (only in ``left``) or ``extra`` (only in ``right``); ``a`` and ``b`` hold
    the records' columns. Replicas that are equal give no row, as do two empty ones.
    """
    left, right = stored(left, "replica"), stored(right, "replica")
    trees = merkle(left), merkle(right)
    if not trees[0] and not trees[1]:
        empty = left.limit(0)
        return empty.select("place", F.lit("changed").alias("state"), F.struct("*").alias("a"), F.struct("*").alias("b"))
    bad = mismatches(*trees).withColumnRenamed("node", "place")
    released(*trees[0], *trees[1])
    side = lambda df, name: df.join(bad, "place", "left_semi").select("place", F.struct(*[c for c in df.columns]).alias(name))
    both = side(left, "a").join(side(right, "b"), "place", "full")
    state = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").otherwise("changed")
    return both.select("place", state.alias("state"), "a", "b")


def decayed(pages: DataFrame) -> DataFrame:
    """A replica of ``pages`` in which 3 of 256 urls, by their SHA-256, lost a page's first character to another one."""
    hit = F.coalesce((F.substring(F.sha2("url", 256), 1, 2) < "03") & (F.length("html") > 0), F.lit(False))
    return pages.withColumn("html", F.when(hit, F.overlay("html", F.lit("#"), F.lit(1))).otherwise(F.col("html")))


def op9_warc_fixity_audit(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    found = audit(archived(pages), archived(decayed(pages)))
    get = lambda c: F.coalesce(F.col(f"a.{c}"), F.col(f"b.{c}"))
    return found.select(
        get("page_id").alias("page_id"),
        get("file").alias("file"),
        get("offset").alias("offset"),
        get("length").alias("length"),
        "state",
        F.col("a.digest").alias("digest"),
        F.col("b.digest").alias("replica_digest"),
    )


#: The same findings without trees: both replicas laid out in full and compared record by record.
OP9_SQL = """
WITH r AS (
  SELECT page_id, url, coalesce(html, '') AS body,
    coalesce(length(html) > 0 AND substr(sha256(url), 1, 2) < '03', FALSE) AS hit
  FROM pages
), two AS (
  SELECT 0 AS replica, page_id, url, body FROM r
  UNION ALL SELECT 1, page_id, url, CASE WHEN hit THEN '#' || substr(body, 2) ELSE body END FROM r
), rec AS (
  SELECT replica, page_id, url, 'WARC/1.1' || e || 'WARC-Type: response' || e || 'WARC-Target-URI: ' || coalesce(url, '') || e
    || 'Content-Type: text/html' || e || 'Content-Length: ' || strlen(body) || e || e || body || e || e AS x
  FROM two, (SELECT chr(13) || chr(10) AS e)
), laid AS (
  SELECT replica, page_id, strlen(x) AS length, sha256(x) AS digest,
    row_number() OVER (PARTITION BY replica ORDER BY page_id NULLS FIRST, url NULLS FIRST, sha256(x)) - 1 AS place
  FROM rec
), placed AS (
  SELECT *, place // 1024 AS file, coalesce(sum(length) OVER (PARTITION BY replica, place // 1024 ORDER BY place
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset"
  FROM laid
)
SELECT a.page_id, a.file, a."offset", a.length, 'changed' AS state, a.digest, b.digest AS replica_digest
FROM placed a JOIN placed b ON a.place = b.place AND a.replica = 0 AND b.replica = 1
WHERE a.digest <> b.digest OR a."offset" <> b."offset" OR a.length <> b.length
"""
