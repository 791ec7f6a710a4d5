"""Writers of reports. Executors make the lines and write them; the driver only names files.

A report that people open is one file: one task sorts its lines, on disk where they are many, and writes them. Tables of any number of
rows are written by all executors (`write_csv_table`, `append_csv_table`, `write_json`)."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrangle.operators.numbering import numbered
from quadrangle.sources.scratch import measured, written

BOM, CRLF = chr(0xFEFF), "\r\n"


def csv_field(value: Column) -> Column:
    """Quoted only where it must be; null is nothing."""
    text = F.coalesce(value.cast("string"), F.lit(""))
    return F.when(text.rlike('[",\r\n]'), F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text)


def csv_line(columns: list[str]) -> Column:
    return F.concat_ws(",", *(csv_field(F.col(f"`{c}`")) for c in columns))


def _file_system(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _one_file(lines: DataFrame, order: list[Column | str], path: str, end: str) -> None:
    """Lines (column `line`) in the given order as one file that takes the place of what is there."""
    spark, parts = lines.sparkSession, f"{path}.{uuid.uuid4().hex}"
    lines.repartition(1).sortWithinPartitions(*order).select("line").write.option("lineSep", end).text(parts)
    folder, fs = _file_system(spark, parts)
    (part,) = (s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-"))
    target, _ = _file_system(spark, path)
    fs.delete(target, False)
    if not fs.rename(part, target):
        raise OSError(f"{path} could not be written")
    fs.delete(folder, True)


def _numbered(rows: DataFrame, line: Column) -> DataFrame:
    """at (grows with the order of the partitions, from 1) and line."""
    return rows.select((F.monotonically_increasing_id() + 1).alias("at"), line.alias("line"))


def _edges(spark: SparkSession, *lines: tuple[int, str]) -> DataFrame:
    return spark.createDataFrame(list(lines), "at long, line string")


LAST = (1 << 63) - 1


def write_report_csv(rows: DataFrame, path: str, nul: str | None = None) -> int:
    """One file as people's spreadsheets read it: byte order mark, CRLF, fields quoted only where they must be, null as nothing. NUL
    characters stay unless another text is given for them. Rows keep the order of their partitions. Returns the number of rows."""
    line = csv_line(rows.columns)
    if nul is not None:
        line = F.replace(line, F.lit(chr(0)), F.lit(nul))
    lines, seen = measured(_numbered(rows, line), F.count("*").alias("n"))
    head = _edges(rows.sparkSession, (0, BOM + ",".join(rows.columns)))
    _one_file(head.unionByName(lines), ["at"], path, CRLF)
    return seen["n"]


def append_csv(rows: DataFrame, path: str) -> None:
    """Adds rows without a header to one file, by writing it anew. Tables that grow are folders: `append_csv_table`."""
    old = rows.sparkSession.read.text(path, wholetext=True).select(F.lit(0).cast("long").alias("at"), F.regexp_replace("value", r"\r?\n\z", "").alias("line"))
    _one_file(old.unionByName(_numbered(rows, csv_line(rows.columns))), ["at"], path, CRLF)


def write_csv_table(rows: DataFrame, path: str) -> None:
    """Rows of any number, written by all executors."""
    rows.write.csv(path, header=True, escape='"', mode="overwrite")


def append_csv_table(rows: DataFrame, path: str) -> None:
    """Adds rows to a folder of CSV files; files that are there stay as they are."""
    rows.write.csv(path, header=True, escape='"', mode="append")


def with_batches(rows: DataFrame, order: list[Column | str], size: int, name: str = "batch") -> DataFrame:
    """rows with the number of their batch of `size` rows, from 1, in the given order."""
    return numbered(rows, order, "_n").withColumn(name, (F.floor((F.col("_n") - 1) / size) + 1).cast("int")).drop("_n")


def batch_file(number: Column | str) -> Column:
    return F.format_string("website-research-batch-%04d.csv", F.col(number) if isinstance(number, str) else number)


def write_batches(rows: DataFrame, folder: str, columns: list[str], batch: str = "batch") -> list[str]:
    """One report file for each value of the batch column, all written by the executors; files of an earlier export go first. A batch is of
    bounded size, and one task writes its file. The driver gives the files their names."""
    spark = rows.sparkSession
    lines = written(rows.select(F.col(batch).cast("int").alias("batch"), (F.monotonically_increasing_id() + 1).alias("at"), csv_line(columns).alias("line")))
    heads = lines.select("batch").distinct().select("batch", F.lit(0).cast("long").alias("at"), F.lit(BOM + ",".join(columns)).alias("line"))
    parts = f"{folder}/export-{uuid.uuid4().hex}"
    dealt = heads.unionByName(lines).repartition("batch").sortWithinPartitions("batch", "at")
    dealt.select("batch", "line").write.option("lineSep", CRLF).partitionBy("batch").text(parts)
    at, fs = _file_system(spark, folder)
    for old in (s.getPath() for s in fs.listStatus(at)):
        name = old.getName()
        if name.startswith("website-research-batch-") and name.endswith(".csv") and name[23:-4].isdigit():
            fs.delete(old, False)
    names = []
    for status in fs.listStatus(_file_system(spark, parts)[0]):
        number = status.getPath().getName().partition("batch=")[2]
        if number:
            name = f"website-research-batch-{int(number):04d}.csv"
            (part,) = (s.getPath() for s in fs.listStatus(status.getPath()) if s.getPath().getName().startswith("part-"))
            fs.rename(part, _file_system(spark, f"{folder}/{name}")[0])
            names.append(name)
    fs.delete(_file_system(spark, parts)[0], True)
    return sorted(names)


def write_json(rows: DataFrame, path: str) -> None:
    rows.write.json(path, mode="overwrite")


def write_nested_json(head: dict, sections: dict[str, tuple[DataFrame, DataFrame]], path: str) -> None:
    """One JSON document: the entries of head, then for each section an array of groups, each with its fields and an array `rows`.

    sections: by name the groups (group_key, and what is shown of them, `size` among it) and their members (group_key and fields). Groups
    come largest first, then by key; members by their fields in order. A group's members are lines of the file and never one value, so
    a group of any size passes; commas stand before all but the first, which a minimum finds. `files.read_report` reads a section back."""
    import json

    spark = next(iter(sections.values()))[0].sparkSession
    body = None
    for number, (name, (groups, members)) in enumerate(sections.items()):
        fields = [c for c in members.columns if c != "group_key"]
        entry = F.struct(*fields)
        known = written(groups)
        first = known.agg(F.min(F.struct((-F.col("size")).alias("s"), F.col("group_key").alias("k")))["k"].alias("first_key"))
        shown = F.to_json(F.struct(F.col("group_key").alias("key"), *(c for c in known.columns if c != "group_key")), {"ignoreNullFields": "false"})
        place = [F.lit(number).alias("section"), (-F.col("size")).alias("by_size"), F.col("group_key").alias("key")]
        opened = known.crossJoin(F.broadcast(first)).select(  # first is one row
            *place, F.lit(0).alias("kind"), F.lit(None).cast("string").alias("member"),
            F.concat(F.when(F.col("group_key") == F.col("first_key"), "").otherwise(","), F.regexp_replace(shown, r"\}\z", ',"rows":[')).alias("line"),
        )
        own = members.select("group_key", F.to_json(entry, {"ignoreNullFields": "false"}).alias("member"))
        own = own.withColumn("member", F.coalesce("member", F.lit("{}")))
        least = own.groupBy("group_key").agg(F.min("member").alias("least"))
        numbered_rows = own.groupBy("group_key", "member").agg(F.count("*").alias("copies"))  # equal members follow each other
        lines = numbered_rows.join(least, "group_key").join(known.select("group_key", "size"), "group_key")
        again = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
        lines = lines.select("*", again.alias("copy"))
        lines = lines.select(*place, F.lit(1).alias("kind"), "member", F.concat(F.when((F.col("member") == F.col("least")) & (F.col("copy") == 1), "").otherwise(","), F.col("member")).alias("line"))
        closed = known.select(*place, F.lit(2).alias("kind"), F.lit(None).cast("string").alias("member"), F.lit("]}").alias("line"))
        frame = f"{',' if number or head else ''}{json.dumps(name)}:["
        edges = spark.createDataFrame([(number, None, None, -1, None, frame), (number, 1, None, 3, None, "]")], "section int, by_size long, key string, kind int, member string, line string")
        part = edges.unionByName(opened).unionByName(lines).unionByName(closed)
        body = part if body is None else body.unionByName(part)
    start = "{" + ",".join(f"{json.dumps(k)}:{json.dumps(v)}" for k, v in head.items())
    ends = spark.createDataFrame([(-1, None, None, 0, None, start), (len(sections), None, None, 0, None, "}")], "section int, by_size long, key string, kind int, member string, line string")
    _one_file(body.unionByName(ends), ["section", F.asc_nulls_first("by_size"), F.asc_nulls_first("key"), "kind", "member"], path, "\n")


def _escaped(text: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def write_review_page(rows: DataFrame, path: str, title: str) -> None:
    """A static page with a table of rows, escaped, in the order of their partitions."""
    from html import escape

    head = "".join(f"<th>{escape(c)}</th>" for c in rows.columns)
    start = f"<!doctype html><html><head><meta charset='utf-8'><title>{escape(title)}</title></head><body><table><thead><tr>{head}</tr></thead><tbody>"
    cells = [F.concat(F.lit("<td>"), _escaped(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))), F.lit("</td>")) for c in rows.columns]
    body = _numbered(rows, F.concat(F.lit("<tr>"), *cells, F.lit("</tr>")))
    _one_file(body.unionByName(_edges(rows.sparkSession, (0, start), (LAST, "</tbody></table></body></html>"))), ["at"], path, "\n")
