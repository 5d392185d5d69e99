"""WARC archives: written in parallel, read back in blocks whose records are proved by their chain of offsets."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salescast.staging import materialize, scoped_folder

# The mark of a record, the end of a line, of a header and of a record, and the digits of base32
# beside those of numbers to the base 32.
MARK, LINE, GAP = "WARC/", "\r\n", "\r\n\r\n"
BASE32, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789ABCDEFGHIJKLMNOPQRSTUV"
#: What the reader splits at: a line that begins with the mark. Only its first character is a line feed, so that no
#: occurrence overlaps another one.
SPLIT = "\n" + MARK
#: Bytes of an archive in a range that meets the long records over it.
RANGE = 1 << 20
#: Copies of a tied row that one task writes out.
CHUNK = 1_000
#: A payload that more than one in so many rows share is looked up in a broadcast table, which so has fewer rows than this.
HOT = 1_000


def base32(sha1: Column) -> Column:
    """Forty hexadecimal digits as 32 digits to the base 32."""
    parts = [F.lpad(F.conv(F.substring(sha1, i, 10), 16, 32), 8, "0") for i in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), DIGITS, BASE32)


def _uuid(text: Column) -> Column:
    return F.regexp_replace(F.md5(text), "(.{8})(.{4}).(.{3}).(.{3})(.{12})", "$1-$2-5$3-8$4-$5")


def _order() -> Column:
    """The order of pages with one payload: by id, a null id last, then by address."""
    return F.struct(F.col("page_id").isNull(), "page_id", F.col("url").isNull(), "url")


def _marked(pages: DataFrame, least: int) -> DataFrame:
    """(page_id, url, html, sha, sha1, size, first, ties): each page with the first one of its payload, null where it is alone.

    ``ties`` counts the rows that agree with the first one in id and address. Copies are counted on narrow rows with
    partial sums. The table of payloads with copies meets the pages: its hot keys as a bounded broadcast, so that no
    key with a large share of the rows is shuffled, the others as Spark chooses by the table's size.
    """
    page = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce("html", F.lit("")).alias("html"))
    page = page.select("*", F.sha2("html", 256).alias("sha"), F.sha1(F.col("html").cast("binary")).alias("sha1"),
                       F.octet_length("html").cast("long").alias("size"))
    kinds = (page.where(F.col("size") >= least).groupBy("sha", "page_id", "url").agg(F.count(F.lit(1)).alias("n"))
             .groupBy("sha").agg(F.sum("n").alias("rows"), F.min_by(F.struct("page_id", "url", F.col("n").alias("ties")), _order()).alias("f")))
    copied = materialize(kinds.where("rows > 1").select(
        F.col("sha").alias("c_sha"), "rows", "f.page_id", "f.url", "f.ties"), "warc-copied")
    copied = copied.select("c_sha", "rows", F.struct("page_id", "url").alias("first"), "ties")
    total = copied.agg(F.sum("rows")).first()[0] or 0
    hot = copied.where(F.col("rows") * HOT > total).select(
        F.col("c_sha").alias("h_sha"), F.col("first").alias("h_first"), F.col("ties").alias("h_ties"))
    page = page.join(F.broadcast(hot), F.col("sha") == F.col("h_sha"), "left")
    # Rows that are found meet nothing in the second join, so their key may be any; it spreads them.
    key = F.when(F.col("h_sha").isNull(), F.col("sha")).otherwise(F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string")))
    page = page.withColumn("key", key).join(copied, F.col("key") == F.col("c_sha"), "left")
    return page.select("page_id", "url", "html", "sha", "sha1", "size", F.coalesce("h_first", "first").alias("first"),
                       F.coalesce("h_ties", "ties").alias("ties"))


def records(pages: DataFrame, least: int = 0) -> DataFrame:
    """(page_id, url, html, sha, sha1, size, first): what is to be written; ``first`` is null for a response.

    Of pages with equal payloads of at least ``least`` bytes the one with the smallest id is the response and the others
    name it; smaller payloads are all responses. Rows that agree in id, address and payload differ in nothing, so one of
    them is the response and the others are written from their number.
    """
    page = _marked(pages, least)
    own = F.col("first").isNotNull() & F.col("page_id").eqNullSafe(F.col("first.page_id")) & F.col("url").eqNullSafe(F.col("first.url"))
    alone = page.where(~(own & (F.col("ties") > 1))).withColumn("first", F.when(~own, F.col("first"))).drop("ties")
    tied = page.where(own & (F.col("ties") > 1))
    kept = ("page_id", "url", "sha", "sha1", "size")
    narrow = materialize(tied.select(*kept, "first", "ties").distinct(), "warc-tied")
    if narrow.isEmpty():
        return alone
    one = tied.groupBy(*kept).agg(F.first("html").alias("html")).select(
        "page_id", "url", "html", "sha", "sha1", "size", F.lit(None).cast(alone.schema["first"].dataType).alias("first"))
    left = F.col("ties") - 1
    parts = narrow.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((left - 1) / CHUNK))).alias("part"))
    parts = parts.repartition("sha", "part")
    many = parts.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(CHUNK), left - F.col("part") * CHUNK))).alias("nth"))
    many = many.select("page_id", "url", F.lit("").alias("html"), "sha", "sha1", "size", "first")
    return alone.union(one).union(many)


def write(pages: DataFrame, path: str, least: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write one record for each row of (page_id, url, html) to uncompressed WARC/1.1 files in the folder ``path``.

    A response holds an HTTP header and the HTML in UTF-8; a revisit holds the header alone and names the digest, whose
    payload it stands for. A null HTML is an empty one, a null id or address is left out of the header, and line ends in an
    address are escaped. An empty table gives no record; other columns are not read. Each task writes its rows as it
    reads them, and Spark commits the files of finished tasks only.
    """
    again = F.col("first").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE}Content-Length: "),
                    F.col("size").cast("string"), F.lit(GAP))
    address = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    response = _uuid(F.concat(F.lit("response:"), F.col("sha")))
    own = F.when((F.col("size") >= least) & ~again, response).otherwise(F.expr("uuid()"))
    head = F.concat_ws(  # what is null is left out
        LINE, F.lit(MARK + "1.1"),
        F.when(again, F.lit("WARC-Type: revisit")).otherwise(F.lit("WARC-Type: response")),
        F.concat(F.lit("WARC-Record-ID: <urn:uuid:"), own, F.lit(">")),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), address),
        F.concat(F.lit("X-Page-Id: "), F.col("page_id").cast("string")),
        F.when(again, F.concat(F.lit("WARC-Refers-To: <urn:uuid:"), response, F.lit(">"))),
        F.when(again, F.concat(F.lit("X-Refers-To-Page-Id: "), F.col("first.page_id").cast("string"))),
        F.when(again, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), base32(F.col("sha1"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), (F.octet_length(http) + F.when(again, 0).otherwise(F.col("size"))).cast("string")))
    rows = records(pages, least).select(F.concat(head, F.lit(GAP), http, F.when(again, F.lit("")).otherwise(F.col("html"))).alias("value"))
    rows.write.option("lineSep", GAP).text(path)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, size_of_file, block, nth, text): the archives cut at every line that begins with the mark, in order.

    Spark reads a file in blocks by many tasks and gives each piece to the block that its cut begins in.
    """
    return spark.read.option("lineSep", SPLIT).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size_of_file"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("nth"), F.col("value").alias("text"))


def _placed(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ``v``, the offset of each in its file: the bytes before it, first by block, then within it.

    A block is bounded by the reader, and a file has one row a block.
    """
    bytes_ = F.col("bytes") + len(SPLIT)
    ahead = lambda total, *keys: F.coalesce(F.sum(total).over(
        Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = pieces.groupBy("file", "block").agg(F.sum(bytes_).alias("total"))
    blocks = blocks.select(F.col("file").alias("b_file"), F.col("block").alias("b_block"), ahead("total", "file", "block").alias("base"))
    inside = pieces.withColumn("inside", ahead(bytes_, "file", "block", "nth"))
    return inside.join(blocks, (F.col("file") == F.col("b_file")) & (F.col("block") == F.col("b_block"))).withColumn(
        "v", F.col("base") + F.col("inside")).drop("b_file", "b_block", "base", "inside")


def _header(name: str) -> Column:
    """The value of a header line, or null."""
    found = F.regexp_extract("head", rf"(?im)^{name}:[ \t]*(.*?)[ \t]*$", 1)
    return F.when(found != "", found)


def _read_block(block: Column) -> list[Column]:
    """Length and digest of the payload of a record's block: what follows its HTTP header, where it has one."""
    text = block.cast("string")
    http = F.substring_index(text, GAP, 1)
    skipped = F.when(F.col("is_http"), F.octet_length(http) + len(GAP)).otherwise(0)
    payload = F.when(F.col("is_http"), block.substr(skipped + 1, F.greatest(F.octet_length(block) - skipped, F.lit(0)))).otherwise(block)
    said = F.regexp_extract(http, r"(?im)^Content-Length:[ \t]*([0-9]+)", 1).cast("long")
    return [F.octet_length(payload).cast("long").alias("bytes_here"), base32(F.sha1(payload)).alias("digest_here"),
            F.when(F.col("is_http"), said).alias("bytes_said")]


def _candidates(pieces: DataFrame) -> DataFrame:
    """One narrow row a piece: its size, and where it reads like a record, its header, its length and its digest.

    The payload is digested where the piece holds all of it; ``whole`` says so.
    """
    opens = F.startswith("text", F.lit(MARK))
    head = F.substring_index("body", GAP, 1)
    df = pieces.select("file", "size_of_file", "block", "nth", F.octet_length("text").cast("long").alias("bytes"), opens.alias("opens"),
                       F.when(opens, F.substr("text", F.lit(len(MARK) + 1))).otherwise(F.col("text")).alias("body"))
    df = df.withColumn("head", F.when(F.col("body").rlike(r"\A1\.[01]\r\n") & F.contains("body", F.lit(GAP)), head))
    df = df.withColumn("length", F.regexp_extract("head", r"(?im)^Content-Length:[ \t]*([0-9]{1,18})[ \t]*$", 1).cast("long"))
    df = df.withColumn("skip", (F.octet_length("head") + len(GAP)).cast("long"))
    df = df.withColumn("is_http", F.coalesce(F.startswith(F.lower(_header("Content-Type")), F.lit("application/http")), F.lit(False)))
    df = df.withColumn("whole", F.col("skip") + F.col("length") <= F.octet_length("body"))
    block = F.when(F.col("whole"), F.col("body").cast("binary").substr((F.col("skip") + 1).cast("int"), F.col("length").cast("int")))
    return df.select(
        "file", "size_of_file", "block", "nth", "bytes", "opens", "length", "skip", "is_http", "whole",
        F.lower(_header("WARC-Type")).alias("record_type"), _header("X-Page-Id").cast("long").alias("page_id"),
        _header("WARC-Target-URI").alias("url"), _header("X-Refers-To-Page-Id").cast("long").alias("refers_to"),
        F.regexp_extract(_header("WARC-Payload-Digest"), r"(?i)^sha1:([A-Z2-7]{32})$", 1).alias("digest_said"), *_read_block(block))


def _exits(links: pd.DataFrame) -> pd.DataFrame:
    """Where the chain from each candidate of a block leaves the block, by pointer jumping."""
    links = links.sort_values("at")
    at, after = links["at"].to_numpy(), links["after"].to_numpy()
    to = _inside(at, after)
    while not np.array_equal(jump := to[to], to):
        to = jump
    return pd.DataFrame({"file": links["file"].to_numpy(), "block": links["block"].to_numpy(), "at": at, "leaves": after[to]})


def _inside(at: np.ndarray, after: np.ndarray) -> np.ndarray:
    """The index of each candidate's successor in its block, or its own where there is none."""
    nth = np.minimum(np.searchsorted(at, after), len(at) - 1)
    return np.where(at[nth] == after, nth, np.arange(len(at)))


def _chained(links: pd.DataFrame) -> pd.DataFrame:
    """The candidates of a block that its entry reaches, by pointer jumping."""
    links = links.sort_values("at")
    at, after = links["at"].to_numpy(), links["after"].to_numpy()
    reached, to = at == links["entry"].to_numpy(), _inside(at, after)
    while True:
        more = reached.copy()
        more[to[reached]] = True
        if np.array_equal(more, reached):
            break
        reached, to = more, to[to]
    return pd.DataFrame({"file": links["file"].to_numpy()[reached], "at": at[reached]})


def reachable(links: DataFrame) -> DataFrame:
    """(file, at) of the candidates that the chain from the start of each file reaches, from (file, block, at, after).

    ``after`` is where a candidate says that the next record begins. Chains are first cut short within blocks: each
    candidate learns where its chain leaves its block. Of those only the ones where some chain enters a block can matter;
    over them the start of each file jumps 1, 2, 4, ... blocks ahead. The one entry reached in a block then marks its chain.
    """
    links = materialize(links, "warc-links")
    cut = materialize(links.groupBy("file", "block").applyInPandas(_exits, "file string, block long, at long, leaves long"), "warc-exits")
    ends = cut.select("file", F.col("leaves").alias("at")).distinct()
    starts = cut.where("at = 0").select("file", "at", "block")
    doors = materialize(cut.join(ends, ["file", "at"], "left_semi").where("at > 0"), "warc-doors")
    reached = starts
    jumps = cut.where("at = 0").unionByName(doors).select("file", "at", "leaves")
    known = doors.select("file", "at", "block")
    while not (jumps := _stored_jumps(jumps, known)).isEmpty():
        landed = reached.join(jumps, ["file", "at"]).select("file", F.col("leaves").alias("at")).join(known, ["file", "at"])
        reached = materialize(reached.unionByName(landed).distinct(), "warc-reached")
        jumps = jumps.join(jumps.select("file", F.col("at").alias("leaves"), F.col("leaves").alias("next")), ["file", "leaves"]).select(
            "file", "at", F.col("next").alias("leaves"))
    entries = reached.select("file", "block", F.col("at").alias("entry"))
    return links.join(entries, ["file", "block"]).groupBy("file", "block").applyInPandas(_chained, "file string, at long")


def _stored_jumps(jumps: DataFrame, known: DataFrame) -> DataFrame:
    """The jumps that land on an entry, stored."""
    return materialize(jumps.join(known.select("file", F.col("at").alias("leaves")), ["file", "leaves"], "left_semi"), "warc-jumps")


def _long_payloads(spark: SparkSession, path: str, long: DataFrame) -> DataFrame:
    """(file, at, bytes_here, digest_here, bytes_said) of records whose block holds the mark and so lies in several pieces.

    The archives that have such records are read again, and their pieces meet the records over ranges of a file.
    """
    files = long.select("file").distinct()
    pieces = _placed(_pieces(spark, path).join(files, "file", "left_semi").withColumn("bytes", F.octet_length("text").cast("long")))
    start = F.when(F.col("at") == 0, 0).otherwise(F.col("at") + len(MARK))
    spans = long.select(F.col("file").alias("l_file"), "at", start.alias("start"), "begins", "length", "is_http")
    until = F.col("begins") + F.col("length")
    spans = spans.withColumn("range", F.explode(F.sequence(F.floor(F.col("start") / RANGE), F.floor(until / RANGE))))
    met = pieces.join(spans, (F.col("file") == F.col("l_file")) & (F.floor(F.col("v") / RANGE) == F.col("range"))
                      & (F.col("v") >= F.col("start")) & (F.col("v") <= until))  # a block may end with the mark
    whole = met.groupBy("file", "at", "start", "begins", "length", "is_http").agg(
        F.array_sort(F.collect_list(F.struct("v", "text"))).alias("p"))
    text = F.array_join(F.transform("p", lambda x: x["text"]), SPLIT).cast("binary")
    block = text.substr((F.col("begins") - F.col("start") + 1).cast("int"), F.col("length").cast("int"))
    return whole.withColumn("whole_block", block).select("file", "at", *_read_block(F.col("whole_block")))


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row a record of the uncompressed archives in the folder ``path``, wherever tasks cut the files.

    file, at (offset of the record), record_type, page_id, url, refers_to, payload_bytes and payload_digest (base32 SHA-1). A
    record's own payload is measured; a revisit has the length and the digest that it names. The mark of a record may also stand
    in a payload: each task emits, for every line that reads like the begin of a record, where its successor would begin, and
    only what the chain from the start of the file reaches is a record. A chain that does not end at the end of its file, or a
    payload that differs from the digest its header names, raises an error, so nothing is left out silently. Files without records give
    no rows. A record is held whole by one task.
    """
    seen = materialize(_candidates(_pieces(spark, path)), "warc-pieces")
    # The first piece of a file holds the mark itself, the others begin behind it.
    at = F.when(F.col("v") == 0, 0).otherwise(F.col("v") - len(MARK))
    placed = _placed(seen).withColumn("at", at).where(F.col("length").isNotNull() & (F.col("opens") == (F.col("v") == 0)))
    placed = materialize(placed.withColumn("begins", F.col("at") + len(MARK) + F.col("skip")).withColumn(
        "after", F.col("begins") + F.col("length") + len(GAP)), "warc-placed")
    true = reachable(placed.select("file", "block", "at", "after"))
    rows = materialize(placed.join(true, ["file", "at"], "left_semi"), "warc-records")
    sizes = seen.groupBy("file").agg(F.max("size_of_file").alias("ends"))
    torn = sizes.join(rows.groupBy("file").agg(F.max("after").alias("after")), "file", "left").where("ends > 0 and not ends <=> after")
    if (bad := torn.first()) is not None:
        raise ValueError(f"the chain of records ends at {bad['after']} of {bad['ends']} bytes: {bad['file']}")
    long = rows.where("not whole")
    if not long.isEmpty():
        whole = _long_payloads(spark, path, long)
        parts = rows.where("not whole").drop("bytes_here", "digest_here", "bytes_said").join(whole, ["file", "at"])
        rows = materialize(rows.where("whole").unionByName(parts), "warc-whole")
    again = F.col("record_type") == "revisit"
    said = F.when(F.col("digest_said") != "", F.upper("digest_said"))
    wrong = rows.where(~again & said.isNotNull() & (said != F.col("digest_here"))).select("file", "at").first()
    if wrong is not None:
        raise ValueError(f"a payload differs from its digest: {wrong['file']} at {wrong['at']}")
    return rows.select(
        "file", "at", "record_type", "page_id", "url", "refers_to",
        F.when(again, F.coalesce("bytes_said", "bytes_here")).otherwise(F.col("bytes_here")).alias("payload_bytes"),
        F.when(again, F.coalesce(said, "digest_here")).otherwise(F.col("digest_here")).alias("payload_digest"))


def round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to: one row a page, written to archives and read back.

    Rules and odd rows as in :func:`write` and :func:`read`: null HTML counts as empty, rows that repeat an id are
    records of their own, a null id stays null and is the last to be a response, an empty table gives no rows.
    """
    spark = pages.sparkSession
    path = scoped_folder(spark, "warc")
    write(pages, path, least)
    return read(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
