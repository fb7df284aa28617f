"""Seed files: header CSV read with an explicit schema, landed as parquet.

Records may hold line breaks inside quotes, so a record's start can't be told
from its line alone.  A file is still read by many tasks: each counts the
quotes of its block of bytes, the running parity of the blocks before tells
whether a block begins inside quotes, and then each task cuts its block into
records.  The pieces of a record that lies in several blocks are joined by the
place where it begins.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chronodim.plans.session import write_table

# Landing schema of the cost-centre source (natural key ``center_cd``,
# change time ``updated_at``).
COST_CENTER_DDL = (
    "center_cd string, center_name string, region string, country string, "
    "cost_type string, status string, valid_from date, updated_at timestamp"
)


# Header line, quotes doubled, line breaks inside quotes; blanks and empty
# texts are kept as they are (NULL is an unquoted empty field).
CSV = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false",
       "ignoreTrailingWhiteSpace": "false", "lineSep": "\n"}
# an unquoted empty field is NULL, a quoted one an empty text: no text may
# stand for NULL
READ = {**CSV, "mode": "FAILFAST", "nullValue": "\x00"}


def read_csv_whole(spark: SparkSession, path: str, schema: str | StructType = COST_CENTER_DDL) -> DataFrame:
    """Header CSV by Spark's own multi-line reader: one task a file."""
    return spark.read.schema(schema).options(**READ).csv(path)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of blocks (file, block, odd: it begins inside quotes) to pieces
    of records: (file, block and number where the record began; the block of
    the piece; text; ended).  What continues a record of an earlier block
    carries no beginning."""
    now, state = None, None

    def close():
        """The unfinished record at the end of a block."""
        if state["open"] is not None:
            begun, lines = state["open"]
            yield (*now, begun, "\n".join(lines), False)

    for b in batches:
        out: list[tuple] = []
        quotes = pc.count_substring(b.column("value"), '"').to_pylist()
        for file, block, odd, text, n in zip(b.column("file").to_pylist(), b.column("block").to_pylist(), b.column("odd").to_pylist(), b.column("value").to_pylist(), quotes, strict=True):
            if (file, block) != now:
                if now is not None:
                    out += close()
                # number -1: the rest of a record that began in an earlier block
                now, state = (file, block), {"n": 0, "open": (-1, []) if odd else None}
            if state["open"] is None:
                state["open"] = (state["n"], [])
                state["n"] += 1
            begun, lines = state["open"]
            lines.append(text)
            inside = (begun < 0 and len(lines) == 1) or state.get("inside", False)
            state["inside"] = inside != (n % 2 == 1)
            if not state["inside"]:
                out.append((file, block, begun, "\n".join(lines), True))
                state["open"] = None
        if out:
            yield _pieces(out)
    if now is not None:
        rest = list(close())
        if rest:
            yield _pieces(rest)


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["file", "block", "begun", "record", "ended"])


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of the CSV files at ``path`` (quotes doubled inside quotes):
    file, block, begun (number in the block; the header is 0 of block 0),
    record.  No file is read by one task, and only records that lie in
    several blocks are shuffled."""
    lines = spark.read.option("lineSep", "\n").text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    count = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    blocks = lines.groupBy("file", "block").agg((F.sum(count) % 2).alias("odd"))
    before = F.sum("odd").over(W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1))  # a row a block
    blocks = blocks.withColumn("before", before).where("before % 2 = 1").select("file", "block", F.lit(True).alias("odd"))
    # the lines keep their order only if they don't move, so the other side is
    # broadcast: a row for a block of 128 MB that begins inside quotes, under a
    # millionth of the input
    pieces = lines.join(F.broadcast(blocks), ["file", "block"], "left").select("file", "block", F.coalesce("odd", F.lit(False)).alias("odd"), "value").mapInArrow(_cut, "file string, block long, begun long, record string, ended boolean")
    whole = pieces.where("begun >= 0 and ended").drop("ended")
    parts = pieces.where("begun < 0 or not ended")
    # a piece that begins a record opens a group of the pieces up to its end
    order = W.partitionBy("file").orderBy("block", F.col("begun") >= 0)
    parts = parts.withColumn("group", F.sum((F.col("begun") >= 0).cast("int")).over(order))
    joined = parts.groupBy("file", "group").agg(F.sort_array(F.collect_list(F.struct("block", "begun", "record"))).alias("p"))
    joined = joined.select("file", F.col("p")[0]["block"].alias("block"), F.col("p")[0]["begun"].alias("begun"), F.array_join("p.record", "\n").alias("record"))
    return whole.union(joined)


def read_csv_seed(spark: SparkSession, path: str, schema: str | StructType = COST_CENTER_DDL) -> DataFrame:
    """Header CSV with a declared schema (no inference pass over the data;
    ANSI casts reject malformed dates and times), large files by many tasks.

    Blank lines are no records; the columns of the header are taken by place."""
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    records = csv_records(spark, path).where("not (block = 0 and begun = 0) and record <> ''")
    options = {k: v for k, v in READ.items() if k not in ("header", "multiLine", "lineSep")}
    return records.select(F.from_csv("record", _ddl(kind), options).alias("r")).select("r.*")


def _ddl(kind: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kind.fields)


def write_csv_seed(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").options(**CSV).csv(path)


def land_seed(spark: SparkSession, csv_path: str, parquet_path: str,
              schema: str | StructType = COST_CENTER_DDL) -> DataFrame:
    """Seed load: read the CSV, write it as a parquet table,
    return the landed table."""
    return write_table(read_csv_seed(spark, csv_path, schema), parquet_path)
