"""Records of files that no line end delimits, read by many tasks.

A JSON array, a GeoJSON collection or a delimited file with line ends inside quotes is one document, but its text
still splits at any frequent character (``lineSep`` of the text source). What a stretch between two such characters
does to the reader's state, whether it flips the quotes and by how much it opens brackets, is known for
both states it may begin in. So one pass adds these up for each block (split of the file), a running sum over the
few block rows gives every block its opening state, and in a second pass each block finds its own record ends.
Only the open ends at block edges are put together across blocks.
"""

from __future__ import annotations

import csv
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from arealens.operators.materialize import materialize
from arealens.session import checkpoint_dir

#: Depth is braces plus so much for each bracket.
BRACKET = 1 << 32
#: Encodings whose quotes and line ends are the single bytes of ASCII.
BYTEWISE = {None: "UTF-8", "utf-8": "UTF-8", "utf8": "UTF-8", "latin1": "ISO-8859-1", "iso-8859-1": "ISO-8859-1", "us-ascii": "US-ASCII", "windows-1252": "windows-1252"}


def _count(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def _frames(spark: SparkSession, path: str, mark: str) -> DataFrame:
    """Stretches of text between marks: file, block (where its split begins), position in it, frame."""
    text = spark.read.option("lineSep", mark).text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("frame"),
    )


def _json_state(frame: Column) -> dict[str, Column]:
    """What a frame that a closing brace follows does: quotes, and depth if it begins outside or inside a string."""
    plain = F.regexp_replace(frame, r"(?s)\\.", "")  # a backslash and what it escapes
    quotes = _count(plain, '"') % 2

    def rise(rest: Column, ends_inside: Column) -> Column:
        bare = F.regexp_replace(rest, r'"[^"]*("|\z)', "")
        braces = _count(bare, "{") - _count(bare, "}") - F.when(ends_inside, 0).otherwise(1)
        return braces + (_count(bare, "[") - _count(bare, "]")) * F.lit(BRACKET)

    return {
        "quotes": quotes,
        "rise_outside": rise(plain, quotes == 1),
        "rise_inside": rise(F.regexp_replace(plain, r'\A[^"]*("|\z)', ""), quotes == 0),
    }


def _csv_state(frame: Column) -> dict[str, Column]:
    return {"quotes": _count(frame, '"') % 2, "rise_outside": F.lit(0).cast("long"), "rise_inside": F.lit(0).cast("long")}


def _opening_states(frames: DataFrame) -> DataFrame:
    """Per file and block: whether it opens inside quotes, and at which depth."""
    earlier = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    flipped = F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2 == 1
    blocks = (
        frames.withColumn("flipped", flipped)
        .groupBy("file", "block")
        .agg(
            (F.sum("quotes") % 2).alias("quotes"),
            F.sum(F.when(F.col("flipped"), F.col("rise_inside")).otherwise(F.col("rise_outside"))).alias("rise_outside"),
            F.sum(F.when(F.col("flipped"), F.col("rise_outside")).otherwise(F.col("rise_inside"))).alias("rise_inside"),
        )
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row for each block
    inside = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2
    rise = F.when(F.col("inside") == 1, F.col("rise_inside")).otherwise(F.col("rise_outside"))
    opened = blocks.withColumn("inside", inside).withColumn("depth", F.coalesce(F.sum(rise).over(before), F.lit(0)))
    return opened.select("file", "block", "inside", "depth")


def _records(spark: SparkSession, path: str, mark: str, state, depths: list[int], keep_open: bool) -> DataFrame:
    """(file, block, number, record) of the stretches that end outside quotes at one of ``depths``; the mark ends each.

    ``keep_open`` keeps what is left unclosed at the end of a file.
    """
    frames = _frames(spark, path, mark)
    effects = state(F.col("frame"))
    opening = materialize(_opening_states(frames.select("file", "block", "at", *[c.alias(n) for n, c in effects.items()])), "blocks")
    order = Window.partitionBy("file", "block").orderBy("at")
    earlier, so_far = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, 0)
    rows = (
        frames.select("*", *[c.alias(n) for n, c in effects.items()])
        .join(opening, ["file", "block"])
        .withColumn("fresh", (F.col("block") == 0) | ((F.col("inside") == 0) & F.col("depth").isin(depths)))
        .withColumn("flipped", (F.col("inside") + F.coalesce(F.sum("quotes").over(earlier), F.lit(0))) % 2)
        .withColumn("rise", F.when(F.col("flipped") == 1, F.col("rise_inside")).otherwise(F.col("rise_outside")))
        .withColumn("depth", F.col("depth") + F.sum("rise").over(so_far))
        .withColumn("closes", ((F.col("flipped") + F.col("quotes")) % 2 == 0) & F.col("depth").isin(depths))
        .withColumn("number", F.coalesce(F.sum(F.col("closes").cast("long")).over(earlier), F.lit(0).cast("long")))
    )
    # grouped as it was partitioned: no further shuffle
    pieces = rows.groupBy("file", "block", "number").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "frame"))), lambda r: r["frame"]), mark).alias("piece"),
        F.bool_or("closes").alias("closed"),
        F.bool_or("fresh").alias("fresh"),
    )
    pieces = materialize(pieces, "pieces")
    starts = (F.col("number") > 0) | F.col("fresh")  # the block before may end with a record's end
    whole = pieces.where(F.col("closed") & starts).select("file", "block", "number", F.col("piece").alias("record"))
    # at most two for each block: one that ends a record begun before, one that begins a record ended later
    running = Window.partitionBy("file").orderBy("block", "number").rowsBetween(Window.unboundedPreceding, 0)
    edges = pieces.where(~(F.col("closed") & starts)).withColumn("begun", F.sum(starts.cast("int")).over(running))
    joined = edges.groupBy("file", "begun").agg(
        F.min(F.struct("block", "number")).alias("first"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "number", "piece"))), lambda r: r["piece"]), mark).alias("record"),
        F.bool_or("closed").alias("closed"),
    )
    if not keep_open:
        joined = joined.where("closed")
    return whole.unionByName(joined.select("file", "first.block", "first.number", "record"))


def json_records(spark: SparkSession, path: str) -> DataFrame:
    """``record``: the objects of a JSON array (or of a file that is one object, or many), as text on one line.

    Text outside the objects, and an object that the file leaves open, is not read.
    """
    found = _records(spark, path, "}", _json_state, [0, BRACKET], keep_open=False)
    return found.select(F.concat(F.translate(F.regexp_replace("record", r"\A[^{]*", ""), "\r\n", "  "), F.lit("}")).alias("record"))


def feature_records(spark: SparkSession, path: str) -> DataFrame:
    """``record``: the features of GeoJSON collections as text; other members of a collection are not read."""
    found = _records(spark, path, "}", _json_state, [BRACKET + 1], keep_open=False)
    later = F.col("record").rlike(r"\A\s*,")  # the first feature follows what the collection holds before it
    header = F.regexp_replace("record", r'(?s)\A.*?"features"\s*:\s*\[\s*', "")
    text = F.when(later, F.regexp_replace("record", r"\A\s*,\s*", "")).otherwise(header)
    return found.select(F.concat(text, F.lit("}")).alias("record"))


def land_json_lines(spark: SparkSession, path: str) -> str:
    """A new folder with one object of the JSON file per line, for readers that infer a schema."""
    folder = f"{checkpoint_dir(spark)}/arealens-lines-{uuid.uuid4().hex}"
    json_records(spark, path).write.text(folder)
    return folder


def header_names(line: str, sep: str) -> list[str]:
    """Column names of a header line: empty ones and repeated ones (whatever their case) get their position."""
    names = next(csv.reader([line], delimiter=sep), [])
    lower = [n.lower() for n in names]
    return [f"_c{i}" if not n else f"{n}{i}" if lower.count(n.lower()) > 1 else n for i, n in enumerate(names)]


def quoted_rows(spark: SparkSession, path: str, sep: str = ",", encoding: str | None = None, skip_bad_lines: bool = False) -> DataFrame:
    """All columns as text of delimited files whose quoted fields may hold line ends.

    A quote inside a quoted field is doubled, and no other field holds quotes. Each file begins with a header on one line. Rows of
    another width are filled with NULL or cut, or skipped. Encodings in which quotes and line ends are not single bytes do not split.
    """
    charset = BYTEWISE[(encoding or "utf-8").lower()]

    def decoded(column: str) -> Column:
        return F.col(column) if charset == "UTF-8" else F.decode(F.col(column).cast("binary"), charset)

    first = spark.read.option("lineSep", "\n").text(path).select(decoded("value").alias("line")).limit(1).collect()
    line = first[0]["line"].lstrip(chr(0xFEFF)) if first else ""
    ends_with_return = line.endswith("\r")
    names = header_names(line.rstrip("\r"), sep)
    if not names:
        return spark.createDataFrame([], StructType([]))
    records = _records(spark, path, "\n", _csv_state, [0], keep_open=True).where("block > 0 OR number > 0")
    record = F.regexp_replace(decoded("record"), r"\r\z", "") if ends_with_return else decoded("record")
    fields = ", ".join(f"`_f{i}` string" for i in range(len(names)))
    options = {"sep": sep, "escape": '"', "multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    parsed = records.select(record.alias("record")).where("trim(record) <> ''").select(F.from_csv("record", f"{fields}, `_corrupt` string", options).alias("r"))
    if skip_bad_lines:
        parsed = parsed.where("r._corrupt IS NULL")
    return parsed.select(*[F.col(f"r._f{i}").alias(n) for i, n in enumerate(names)])
