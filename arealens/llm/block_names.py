"""Exact duplicates by deterministic block naming.

A text is cut into blocks of so many bytes. Equal blocks at equal places get one integer name: the shared
blocks are sorted over range partitions and numbered in that order. Neighbouring names are then named in
pairs, level by level, until each text has one name. Names are given by comparing the bytes (or the pairs)
themselves, so two texts share their last name only if they are equal; nothing is hashed into an identity.

A block, or a pair, that only one text holds at its place proves that text unique: it gets no name, and
what is built on it gets none. The first round names (length, first block), which ends the matter for most
texts before more of them is shuffled; the later rounds name the rest inside these classes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealens.operators.materialize import materialize
from arealens.operators.skew import hottest_keys, lookup_join

#: Bytes of a block, and of the short first one that tells most texts apart. Results do not depend on them; a
#: text of n blocks takes log2(n) levels.
BLOCK = 4096
HEAD = 256


def _shared_names(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n (rows that hold them, two at least), name: integers in the order of the keys."""
    shared = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return materialize(shared.orderBy(*keys).withColumn("name", F.monotonically_increasing_id()), "names")


def _give_names(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with the name of their keys, null where no other row has them."""
    names = _shared_names(rows, keys)
    hot = hottest_keys(names, keys, weight="n")
    return lookup_join(rows, names.select(*keys, "name"), keys, hot)


def _slice(data: Column, block: Column, size: int) -> Column:
    return F.substring(data, (block * size + 1).cast("int"), F.lit(size))


def _whole_names(rest: DataFrame, size: int) -> DataFrame:
    """(row, name) for ``rest`` (row, class, bytes): one name per row, equal for equal bytes of one class, null for unique ones."""
    places = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    blocks = (
        rest.withColumn("blocks", F.expr(f"(octet_length(bytes) + {size - 1}) div {size}"))
        .select("row", "class", "blocks", "bytes", F.explode(places).alias("place"))
        .select("row", "class", "blocks", "place", _slice(F.col("bytes"), F.col("place"), size).alias("block"))
    )
    level = materialize(_give_names(blocks, ["class", "place", "block"]).drop("block"), "level")
    whole = level.where("blocks = 1").select("row", "name")
    while not (open_ := level.where("blocks > 1")).isEmpty():
        odd = F.col("place") % 2 == 1
        pairs = materialize(
            open_.groupBy("row", "class", "blocks", F.expr("place div 2").alias("place")).agg(
                F.max(F.when(~odd, F.col("name"))).alias("first"),
                F.coalesce(F.max(F.when(odd, F.col("name"))), F.lit(-1)).alias("second"),  # -1: the last name has no partner
                F.bool_or(F.col("name").isNull()).alias("alone"),
            ),
            "pairs",
        )
        named = _give_names(pairs.where("not alone"), ["class", "place", "first", "second"])
        alone = pairs.where("alone").withColumn("name", F.lit(None).cast("long"))
        level = named.unionByName(alone).select("row", "class", F.expr("(blocks + 1) div 2").alias("blocks"), "place", "name")
        level = materialize(level, "level")
        whole = whole.unionByName(level.where("blocks = 1").select("row", "name"))
    return whole


def _resolve(docs: DataFrame, size: int, head: int, carried: list[str]) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    read = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text.alias("text"),
        F.octet_length(text).cast("long").alias("length"),
        F.substring(text.cast("binary"), 1, head).alias("head"),
        *([F.struct(*[F.col(f"`{c}`") for c in carried]).alias("carried")] if carried else []),
    )
    named = _give_names(read, ["length", "head"])
    beyond = F.col("name").isNotNull() & (F.col("length") > head)
    rows = materialize(
        named.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.col("name").alias("class"),
            "length",
            F.sha2(F.col("text"), 256).alias("text_sha256"),
            F.when(beyond, F.expr(f"substring(cast(text as binary), {head + 1})")).alias("bytes"),
            *(["carried"] if carried else []),
        ),
        "rows",
    )
    whole = _whole_names(rows.where("bytes is not null").select("row", "class", "bytes"), size)
    rows = rows.drop("bytes")
    short = rows.where(f"class is not null and length <= {head}").withColumn("name", F.lit(-1).cast("long"))
    long = rows.where(f"class is not null and length > {head}").join(whole, "row", "left")
    named = materialize(short.unionByName(long), "identities")
    copies = materialize(
        named.where("name is not null")
        .groupBy("class", "name")
        .agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "row")).alias("last"))
        .where("group_size > 1"),
        "copies",
    )
    hot = hottest_keys(copies, ["class", "name"], weight="group_size")
    resolved = lookup_join(named, copies, ["class", "name"], hot)
    unique = rows.where("class is null").withColumns(
        {"name": F.lit(None).cast("long"), "group_size": F.lit(None).cast("long"), "last": F.lit(None).cast(copies.schema["last"].dataType)}
    )
    found = F.col("group_size").isNotNull()
    return resolved.unionByName(unique).select(
        "doc_id",
        F.when(found, F.col("last.doc_id")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.coalesce(F.col("group_size"), F.lit(1).cast("long")).alias("group_size"),
        F.when(found, F.col("last.row") == F.col("row")).otherwise(True).alias("kept"),
        "text_sha256",
        *(["carried"] if carried else []),
    )


def exact_duplicates(docs: DataFrame, block: int = BLOCK, head: int = HEAD) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are; null counts as the empty text. The row with the largest doc_id of
    a group is kept, a null doc_id only where all are null; of rows that repeat that doc_id one is kept.
    ``text_sha256`` is of the text in UTF-8. Further columns are ignored; an empty table gives no rows.
    """
    return _resolve(docs, block, head, [])


def drop_copies(docs: DataFrame, block: int = BLOCK, head: int = HEAD) -> DataFrame:
    """The rows of ``docs`` that :func:`exact_duplicates` keeps, all columns as they were."""
    return _resolve(docs, block, head, docs.columns).where("kept").select("carried.*")
