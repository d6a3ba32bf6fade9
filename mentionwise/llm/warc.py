"""WARC archives: writing with de-duplication by payload, and reading by boundary chains.

Writing: one record for each page. Of pages with equal payloads of at least
``min_bytes`` bytes, that with the largest id is a response and the others revisit it.
Spark's text writer puts the records into files, one after another, as the format asks.

Reading: tasks read the files in splits, cut at every occurrence of the version line,
be it a boundary or part of a payload. Each piece that reads like a record's head is a
candidate, and its length says where its successor must start. Only what the chain of
successors reaches from the start of a file is a record; version lines and whole
records inside payloads are never reached. Candidates in a row, each the successor of
the one before, form a run, which is left in one place only; so pointers jump from run
to run, their distance doubling with each self-join. A file without such traps has one
run for each split.

Payloads are not moved: what is asked of them is computed where they are read. Only
records that hold a version line themselves are put together from their pieces.

Edge cases: a null payload is an empty one; null ids and addresses have no line in the
record, and null ids rank lowest. Pages that share the largest id of their payload are
all responses (a repeated page repeats its record). Line ends in addresses are escaped.
A file that does not start with a record has none; behind a broken boundary a file ends,
and a record that the file's end cuts off is none.
Revisits whose response is not among the records keep null in what it would say. Other
columns of the pages are not read, so they may have any name; no page, no records.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mentionwise.llm.alignment import quoted
from mentionwise.llm.scratch import Scratch

# payloads that occur more than once are broadcast up to so many, with 100 bytes each
BROADCAST_ROWS = 200_000

# fixed values: the format's own words
VERSION = "WARC/1.1\r\n"
END = "\r\n\r\n"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
# the digits that Spark's conv() uses
CONV32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
# ---- end of fixed values

PAGE_ID = "Page-ID"


def base32(digest: Column) -> Column:
    """Bare upper-case base32 of a SHA-1 in hex: five hex digits are four of base32."""
    parts = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), CONV32, BASE32)


def _uuid(digest: Column) -> Column:
    parts = [F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A head's line; nothing for null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def records_of(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = 0,
    date: str = "2000-01-01T00:00:00Z",
) -> DataFrame:
    """``record``: the text of each page's record, without the end that follows each record."""
    steps = Scratch(pages.sparkSession)
    body = F.coalesce(quoted(payload).cast("string"), F.lit(""))
    # told by SHA-256; the digest in the record is the format's SHA-1
    rows = pages.select(
        quoted(page_id).cast("string").alias("id"), quoted(page_id).alias("rank"), quoted(url).cast("string").alias("url"),
        body.alias("body"),
    ).withColumn("key", F.sha2("body", 256))
    repeated = rows.where(F.octet_length("body") >= min_bytes).groupBy("key").agg(
        F.max("rank").alias("first"), F.count(F.lit(1)).alias("n")
    )
    repeated = steps.write(repeated.where("n > 1").drop("n"), "repeated")
    if repeated.count() <= BROADCAST_ROWS:
        repeated = F.broadcast(repeated)
    told = rows.join(repeated.withColumn("again", F.lit(True)), "key", "left")
    revisit = F.coalesce("again", F.lit(False)) & ~F.col("rank").eqNullSafe(F.col("first"))

    def name(of: Column) -> Column:
        return _uuid(F.md5(F.concat_ws(":", F.coalesce(of.cast("string"), F.lit("-")), "key")))

    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length("body").cast("string"), F.lit(END),
    )
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("body")))
    address = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    kind = F.when(revisit, "revisit").otherwise("response")
    head = F.concat(
        F.lit(f"{VERSION}WARC-Type: "), kind, F.lit("\r\n"),
        _line("WARC-Record-ID", F.when(~revisit, name(F.col("rank"))).otherwise(
            _uuid(F.md5(F.concat_ws(":", F.coalesce("id", F.lit("-")), "key", F.lit("revisit"))))
        )),
        _line("WARC-Date", F.lit(date)), _line("WARC-Target-URI", address), _line(PAGE_ID, F.col("id")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.sha1("body")))),
        _line("WARC-Profile", F.when(revisit, IDENTICAL)), _line("WARC-Refers-To", F.when(revisit, name(F.col("first")))),
        F.lit("Content-Type: application/http;msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"), F.lit(END),
    )
    return told.select(F.concat(head, block).alias("record"))


def write_archives(records: DataFrame, path: str) -> None:
    """Records (``record``) into WARC files under ``path``, through Spark's writer and its commits."""
    records.select("record").write.option("lineSep", END).text(path)


def field(head: Column, name: str) -> Column:
    """A line of a record's head; null if it is not there."""
    found = F.regexp_extract(head, rf"(?im)^{name}:[ \t]*(.*?)[ \t]*$", 1)
    return F.when(found != "", found)


@contextmanager
def fixed_splits(spark: SparkSession):
    """Files are cut the same way in every scan, however many executors there are by then."""
    key = "spark.sql.files.minPartitionNum"
    held = spark.conf.get(key, None)
    spark.conf.set(key, held or str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.unset(key) if held is None else spark.conf.set(key, held)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """What lies between version lines: ``file, split, seq`` (in order) and ``body``."""
    return spark.read.option("lineSep", VERSION).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("seq"), F.col("value").alias("body"),
    )


def _parsed(pieces: DataFrame, of_payload: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """Pieces with ``head``, ``need`` (their record's bytes with its end; null: no record) and the payload's columns.

    The payload's columns are null if the record goes on behind the piece.
    """
    size = F.octet_length("body").cast("long")
    head = F.substring_index("body", END, 1)
    length = F.regexp_extract(head, r"(?im)^Content-Length:[ \t]*(\d{1,15})[ \t]*$", 1)
    reads = (F.octet_length(head) < size) & (length != "") & field(head, "WARC-Record-ID").isNotNull()
    told = pieces.withColumns({"size": size, "head": F.when(reads, head)})
    told = told.withColumn("need", F.octet_length("head") + length.try_cast("long") + 2 * len(END))
    block = F.substring(
        F.col("body").cast("binary"), F.octet_length("head") + len(END) + 1,
        (F.col("need") - F.octet_length("head") - 2 * len(END)).cast("int"),
    )
    # bytes of the answer's own head, up to the first empty line
    answer = F.when(
        F.lower(field(F.col("head"), "Content-Type")).startswith("application/http"),
        F.octet_length(F.substring_index(block.cast("string"), END, 1)) + len(END),
    ).otherwise(0)
    payload = F.substring(block, answer + 1, F.octet_length(block))
    whole = F.col("need") <= F.col("size")
    return told.withColumns({name: F.when(whole, f(payload)) for name, f in of_payload.items()})


def read_archives(
    spark: SparkSession, path: str, of_payload: dict[str, Callable[[Column], Column]] | None = None
) -> DataFrame:
    """``file, at, head`` of every record under ``path``, and what ``of_payload`` makes of its payload's bytes.

    ``at`` is the byte of the file where the record starts. By default the payload itself
    is returned, as ``payload``.
    """
    of_payload = of_payload or {"payload": lambda p: p}
    steps = Scratch(spark)
    with fixed_splits(spark):
        pieces = _pieces(spark, path)
        parsed = steps.write(_parsed(pieces, of_payload).drop("body"), "pieces")
        placed = _placed(parsed)
        # a split's candidates lie in one task
        candidates = steps.write(_in_runs(placed.where("need IS NOT NULL")), "candidates")
        reached = _reached(candidates, steps)
        records = candidates.join(reached, ["file", "run"]).where("at >= entry")
        records = steps.write(records.select("file", "split", "seq", "at", "need", "size"), "records")
        full = records.where("need <= size").join(parsed.drop("size", "need"), ["file", "split", "seq"])
        names = ["file", "at", "head", *of_payload]
        found = full.select(names)
        longer = records.where("need > size")
        if not longer.isEmpty():
            found = found.unionByName(steps.write(_joined(pieces, placed, records, of_payload), "joined").select(names))
    return found


def _placed(parsed: DataFrame) -> DataFrame:
    """Pieces with ``at``, the byte of the file where their version line starts."""
    length = F.col("size") + len(VERSION)
    narrow = parsed.select("file", "split", "seq", "size", "need")
    splits = narrow.groupBy("file", "split").agg(F.sum(length).alias("bytes"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select(
        "file", "split", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("before"),
        (F.sum("bytes").over(Window.partitionBy("file")) - len(VERSION)).alias("end"),
    )
    within = Window.partitionBy("file", "split").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("before") + F.coalesce(F.sum(length).over(within), F.lit(0)) - len(VERSION)
    placed = narrow.join(splits, ["file", "split"]).withColumn("at", at)
    # neither what lies before a file's first version line nor what the file's end cuts off is a record
    inside = (F.col("at") >= 0) & (F.col("at") + F.col("need") + len(VERSION) <= F.col("end"))
    return placed.withColumn("need", F.when(inside, F.col("need"))).drop("before", "end")


def _in_runs(candidates: DataFrame) -> DataFrame:
    """Candidates with ``next``, where their successor starts, and ``run``, the first byte of their run."""
    order = Window.partitionBy("file", "split").orderBy("seq")
    told = candidates.withColumn("next", F.col("at") + F.col("need") + len(VERSION))
    starts = F.when(F.coalesce(F.lag("next").over(order) != F.col("at"), F.lit(True)), F.col("at"))
    run = F.last(F.col("starts"), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return told.withColumn("starts", starts).withColumn("run", run).drop("starts")


def _reached(candidates: DataFrame, steps: Scratch) -> DataFrame:
    """``file, run, entry``: the runs on the chain from a file's start, and where the chain enters them."""
    exits = candidates.groupBy("file", "run").agg(F.max("next").alias("exit"))
    places = candidates.select("file", F.col("at").alias("exit"), F.col("run").alias("to"))
    jumps = steps.write(
        exits.join(places, ["file", "exit"]).select("file", "run", "to", F.col("exit").alias("entry")), "jumps"
    )
    start = candidates.where("at = 0").select("file", "run", F.col("at").alias("entry"))
    reached = steps.write(start, "reached")
    while not jumps.isEmpty():
        more = reached.drop("entry").join(jumps, ["file", "run"]).select("file", F.col("to").alias("run"), "entry")
        grown = steps.write(reached.unionByName(more), "reached")
        onward = jumps.select("file", F.col("run").alias("to"), F.col("to").alias("later"), F.col("entry").alias("at"))
        doubled = jumps.drop("entry").join(onward, ["file", "to"]).select(
            "file", "run", F.col("later").alias("to"), F.col("at").alias("entry")
        )
        doubled = steps.write(doubled, "jumps")
        steps.drop(reached, jumps)
        reached, jumps = grown, doubled
    return reached


def _joined(
    pieces: DataFrame, placed: DataFrame, records: DataFrame, of_payload: dict[str, Callable[[Column], Column]]
) -> DataFrame:
    """The records that go on behind their first piece, put together from all their pieces."""
    marked = placed.drop("need").join(
        records.select("file", "split", "seq", F.col("at").alias("own"), F.col("need").alias("wanted")),
        ["file", "split", "seq"], "left",
    )
    record = F.when(F.col("own").isNotNull(), F.struct("own", "wanted"))
    within = Window.partitionBy("file", "split").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    # a split's first pieces may belong to the last record of the splits before
    ends = marked.groupBy("file", "split").agg(F.max(record).alias("latest"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("file", "split", F.last("latest", ignorenulls=True).over(earlier).alias("before"))
    owned = marked.withColumn("mine", F.last(record, ignorenulls=True).over(within)).join(ends, ["file", "split"])
    owner = F.coalesce("mine", "before")
    parts = owned.withColumn("owner", owner).where(
        (F.col("at") < F.col("owner.own") + F.col("owner.wanted") + len(VERSION))
    ).select("file", "split", "seq", "at", "size", "owner")
    first = F.col("at") == F.col("owner.own")
    parts = parts.where(~first | (F.col("owner.wanted") > F.col("size")))
    texts = pieces.join(parts, ["file", "split", "seq"]).groupBy("file", "owner").agg(
        F.sort_array(F.collect_list(F.struct("at", "body"))).alias("parts")
    )
    whole = texts.select(
        "file", F.col("owner.own").alias("at"), F.col("owner.wanted").alias("wanted"),
        F.array_join("parts.body", VERSION).alias("body"),
    )
    complete = whole.where(
        F.assert_true(F.octet_length("body") >= F.col("wanted"), F.lit("an archive changed while it was read")).isNull()
    )
    return _parsed(complete, of_payload)


def resolved(records: DataFrame, facts: list[str]) -> DataFrame:
    """Records with ``page_id, record_type, refers_to`` (the response's page); revisits take ``facts`` from it.

    A response that very many revisit is one row; adaptive joins split the revisits.
    """
    head = F.col("head")
    told = records.select(
        field(head, PAGE_ID).alias("page_id"), field(head, "WARC-Type").alias("record_type"),
        field(head, "WARC-Record-ID").alias("name"), field(head, "WARC-Refers-To").alias("target"), *facts,
    )
    responses = told.where("record_type <> 'revisit'")
    # a repeated page has repeated its record
    by_name = responses.groupBy(F.col("name").alias("target")).agg(
        F.first("page_id").alias("refers_to"), *[F.first(f).alias(f) for f in facts]
    )
    revisits = told.where("record_type = 'revisit'").drop(*facts).join(by_name, "target", "left")
    names = ["page_id", "record_type", "refers_to", *facts]
    own = responses.withColumn("refers_to", F.lit(None).cast("string"))
    return own.select(names).unionByName(revisits.select(names))
