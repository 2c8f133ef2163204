"""WARC fixity audit by Merkle trees (operator 8).

Pages become WARC records, the records files of consecutive ids, and every
record has its range of offsets in its file. A leaf is the hash of a record
and of its range; a node hashes its children in order and the range they
cover; the roots of the files are the leaves of a tree over all files.

Two replicas are compared from the root down: a level's nodes are joined only
where their parents differ, so an audit of sound replicas reads one row of each
and a damaged record costs one path.

A null page_id has a file by the hash of its page; null url or html are empty;
pages that repeat an id follow each other in the order of their hashes; an
empty table has no tree, and nothing to compare.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Stage

FILE_IDS = 1024  # page ids of one file
FANOUT = 16


def record() -> Column:
    """The bytes of a page's WARC record, as text."""
    html, url = F.coalesce(F.col("html").cast("string"), F.lit("")), F.coalesce(F.col("url").cast("string"), F.lit(""))
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), page, F.lit(">\r\nWARC-Target-URI: "), url,
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(html), F.lit("\r\n\r\n"), html, F.lit("\r\n\r\n"),
    )


def records(pages: DataFrame) -> DataFrame:
    """page_id, file_no, record_no, record_offset, record_length, record_sha256 and the leaf's hash."""
    url_html = F.xxhash64(F.col("url").cast("string"), F.col("html").cast("string"))
    file_no = F.coalesce(F.floor(F.col("page_id").cast("long") / FILE_IDS), -1 - F.pmod(url_html, F.lit(FILE_IDS)))
    text = pages.select(F.col("page_id").cast("long").alias("page_id"), file_no.cast("long").alias("file_no"), record().alias("r"))
    hashed = text.select("page_id", "file_no", F.octet_length("r").cast("long").alias("record_length"), F.sha2("r", 256).alias("record_sha256"))
    order = Window.partitionBy("file_no").orderBy("page_id", "record_sha256")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = hashed.withColumn("record_no", (F.row_number().over(order) - 1).cast("long")).withColumn(
        "record_offset", F.coalesce(F.sum("record_length").over(before), F.lit(0)).cast("long")
    )
    leaf = F.sha2(F.concat_ws("|", F.lit("leaf"), "record_offset", "record_length", "record_sha256"), 256)
    return placed.withColumn("leaf_sha256", leaf)


def _above(nodes: DataFrame, keys: list[str], index: str) -> DataFrame:
    """The next level: each FANOUT neighbours under one node."""
    parent = F.floor(F.col(index) / FANOUT).cast("long").alias("_up")
    kids = F.array_sort(F.collect_list(F.struct(index, "first", "end", "hash")))  # FANOUT rows at most
    up = nodes.groupBy(*keys, parent).agg(kids.alias("k"))
    first, end = F.get("k.first", F.lit(0)), F.element_at("k.end", -1)
    return up.select(
        *keys, F.col("_up").alias(index), first.alias("first"), end.alias("end"),
        F.sha2(F.concat_ws("|", F.lit("node"), first, end, F.array_join("k.hash", "|")), 256).alias("hash"),
    )


class Tree:
    """The levels of a replica's tree, each a written table: ``files`` from the records to the roots
    of the files, ``top`` from those to the one root."""

    def __init__(self, records: DataFrame, name: str):
        stage = Stage(records.sparkSession, f"fixity-{name}")
        self.records = stage.write(records, "records")
        level = self.records.select(
            "file_no", F.col("record_no").alias("no"), F.col("record_offset").alias("first"),
            (F.col("record_offset") + F.col("record_length")).alias("end"), F.col("leaf_sha256").alias("hash"),
        )
        self.files = [level]
        for k in range(1, _levels(level.agg(F.max("no")).first()[0])):
            level = stage.write(_above(level, ["file_no"], "no"), f"file-{k}")
            self.files.append(level)
        roots = level.select("file_no", F.lit(0).cast("long").alias("first"), "end", "hash")
        self.top = [roots]
        low, high = roots.agg(F.min("file_no"), F.max("file_no")).first()
        while low is not None and low != high:
            roots = stage.write(_above(roots, [], "file_no"), f"top-{len(self.top)}")
            self.top.append(roots)
            low, high = low // FANOUT, high // FANOUT
            if (low, high) == (-1, 0):  # floors of negative numbers never meet those of others
                break

    @property
    def roots(self) -> DataFrame:
        """file_no and the hash of each file."""
        return self.top[0].select("file_no", "hash")


def _levels(last: int | None) -> int:
    n = 1
    while last:
        last, n = last // FANOUT, n + 1
    return n


def _differing(a: DataFrame, b: DataFrame, keys: list[str], among: DataFrame | None, up: list[Column]) -> DataFrame:
    """Keys of the nodes of a level that differ, or that one side lacks, under differing parents."""
    sides = []
    for i, side in enumerate((a, b)):
        side = side.select(*keys, F.col("hash").alias(f"h{i}"))
        if among is not None:
            side = side.withColumns({f"_p{k}": c for k, c in enumerate(up)}).join(among, [f"_p{k}" for k in range(len(up))], "left_semi").select(*keys, f"h{i}")
        sides.append(side)
    return sides[0].join(sides[1], keys, "full_outer").where(~F.col("h0").eqNullSafe(F.col("h1"))).select(*keys)


def _parents(found: DataFrame, keys: list[str]) -> DataFrame:
    return found.select(*[F.col(k).alias(f"_p{i}") for i, k in enumerate(keys)])


def audit(a: Tree, b: Tree) -> DataFrame:
    """file_no, record_no of the records in which the replicas differ, found from the roots down."""
    up = F.floor(F.col("file_no") / FANOUT).cast("long")
    found = None
    for k in reversed(range(min(len(a.top), len(b.top)))):  # trees of two heights meet at the lower one
        found = _differing(a.top[k], b.top[k], ["file_no"], _parents(found, ["file_no"]) if found is not None else None, [up])
    keys, parent = ["file_no", "no"], [F.col("file_no"), F.floor(F.col("no") / FANOUT).cast("long")]
    files = min(len(a.files), len(b.files))
    inside, by = _parents(found, ["file_no"]), [F.col("file_no")]
    for k in reversed(range(files)):
        found = _differing(a.files[k], b.files[k], keys, inside, by)
        inside, by = _parents(found, keys), parent
    return found.select("file_no", F.col("no").alias("record_no"))


def ledger(a: Tree, b: Tree) -> DataFrame:
    """Every record of replica a with its file's roots on both sides, and its status."""
    bad = audit(a, b).withColumn("bad", F.lit(True))
    other = b.roots.select("file_no", F.col("hash").alias("replica_root"))
    return (
        a.records.drop("leaf_sha256").join(a.roots.withColumnRenamed("hash", "file_root"), "file_no").join(other, "file_no", "left")
        .join(bad, ["file_no", "record_no"], "left")
        .withColumn("status", F.when(F.col("bad"), "damaged").otherwise("sound")).drop("bad")
    )


def bit_rot(pages: DataFrame, one_in: int = 64) -> DataFrame:
    """A replica in which the first byte of every page whose id ``one_in`` divides has changed."""
    flipped = F.concat(F.when(F.left("html", F.lit(1)) == "#", "%").otherwise("#"), F.substring("html", 2, 2147483646))
    hit = (F.pmod(F.col("page_id"), F.lit(one_in)) == 0) & (F.ascii("html") < 128) & (F.length("html") > 0)
    return pages.withColumn("html", F.when(hit, flipped).otherwise(F.col("html")))
