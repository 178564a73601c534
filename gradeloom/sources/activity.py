"""Reading and filtering the raw log, writing and reading the tables made from it."""

from __future__ import annotations

import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from gradeloom.functions.scalars import real, repaired_term
from gradeloom.operators.blocks import numbered
from gradeloom.schema import ACTIVITY, EXPORT_COLUMNS
from gradeloom.session import materialize


# Words of a text table that stand for a missing value.
NULL_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
    "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def worded(df: DataFrame) -> DataFrame:
    """Text columns with the words for a missing value as null."""
    return df.withColumns({c: F.when(~F.col(c).isin(NULL_WORDS), F.col(c)) for c, kind in df.dtypes if kind == "string"})


def rejected(df: DataFrame) -> DataFrame:
    """(column, values): texts that are there but are no value of their column's declared type."""
    bad = [F.count_if(F.col(f.name).isNotNull() & typed(df, f).isNull()).alias(f.name) for f in ACTIVITY if f.name in df.columns]
    counts = worded(df).agg(*bad)
    pair = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("values")) for c in counts.columns]))
    return counts.select(pair.alias("pair")).select("pair.*")


def typed(df: DataFrame, field: T.StructField):
    """A column in its declared type, null where it is no such value; whole numbers may come as 5.0."""
    c = F.col(field.name)
    if isinstance(field.dataType, T.LongType) and dict(df.dtypes)[field.name] == "string":
        c = c.try_cast("double")
    return c.try_cast(field.dataType)


def conform(df: DataFrame) -> DataFrame:
    """The declared columns and types, null where a value is not of the type, NaN as null."""
    df = worded(df)
    df = df.select(*[typed(df, field).alias(field.name) for field in ACTIVITY])
    doubles = [f.name for f in ACTIVITY if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: real(c) for c in doubles})


def read_activity(spark: SparkSession, path: str, format: str = "parquet", multiline: bool = False, **filters) -> DataFrame:
    """Scan the raw log (Parquet, or CSV with `;`) and keep what the filters ask for.

    CSV is read as text and conformed. `multiline` reads quoted line breaks; a file is then one task's.
    """
    if format == "csv":
        raw = spark.read.csv(path, sep=";", header=True, multiLine=multiline, escape='"')
        return filter_activity(conform(raw), **filters)
    # a written log has its types already: filters go first, so that they reach the scan
    return conform(filter_activity(spark.read.format(format).load(path), **filters))


#: Rows are laid out by these, so that a filter on either finds few files and row groups.
LAYOUT = ["course_name", "learner_id"]
#: Columns with a Bloom filter in each row group, for values that lie within its range but are not there.
BLOOMED = ["learner_id", "learner_no"]


def write_log(df: DataFrame, path: str, layout: list[str] = LAYOUT, bloomed: list[str] = BLOOMED, row_group_bytes: int | None = None,
              files: int | None = None) -> None:
    """Write a log whose files and row groups can be skipped.

    Rows are dealt to files by ranges of `layout` and lie in that order, then by step, so a row group holds few
    courses and learners; its least and greatest values rule out most filters on them. `bloomed` columns that the log
    has get a Bloom filter a row group, which rules out a learner that is between two others. `files` is Spark's
    number of shuffle partitions if not given; smaller `row_group_bytes` skip more and read slower in full.
    """
    order = [c for c in [*layout, "step"] if c in df.columns]
    spread = df.repartitionByRange(*([files] if files else []), *[c for c in layout if c in df.columns], "row_id")
    writer = spread.sortWithinPartitions(*order).write.mode("overwrite")
    for c in bloomed:
        if c in df.columns:
            writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true").option(f"parquet.bloom.filter.adaptive.enabled#{c}", "true")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)


HELD = "row_id long, file string, record string, faults array<struct<column:string,text:string>>"


def sorted_out(raw: DataFrame, names: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Numbered text rows parted into those that conform and those that are held: (rows, held).

    `raw` has the columns of `names` (of the export: ours), row_id, file and, where a line has not as many fields as the
    header, its text as `broken`. A row is held if it is broken or a text is there that is no value of its column's type.
    `record` is the line, put together again where it isn't broken; `faults` names the columns and their texts.
    """
    ours = raw.select("row_id", "file", "broken", *[F.col(theirs).alias(name) for theirs, name in names.items()])
    ready = worded(ours)
    fields = [f for f in ACTIVITY if f.name in names.values()]
    bad = [F.when(F.col(f.name).isNotNull() & typed(ready, f).isNull(), F.struct(F.lit(f.name).alias("column"), F.col(f.name).alias("text")))
           for f in fields]
    line = F.to_csv(F.struct(*[F.col(n) for n in names.values()]), {"sep": ";", "quote": '"', "escape": '"', "nullValue": ""})
    broken = F.array(F.struct(F.lit("").alias("column"), F.col("broken").alias("text")))
    ready = ready.withColumn("faults", F.when(F.col("broken").isNotNull(), broken).otherwise(F.array_compact(F.array(*bad))))
    held = ready.where(F.size("faults") > 0).select("row_id", "file", F.coalesce("broken", line).alias("record"), "faults")
    return conform(ready.where(F.size("faults") == 0)), held


def read_export(spark: SparkSession, csv_path: str, multiline: bool = False) -> DataFrame:
    """The export's lines as text columns with row_id, their number in the order of files and lines, file and broken."""
    header = spark.read.csv(csv_path, sep=";", header=True, escape='"').columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, "broken"]])
    raw = spark.read.csv(csv_path, sep=";", header=True, multiLine=multiline, escape='"', schema=schema,
                         mode="PERMISSIVE", columnNameOfCorruptRecord="broken")
    place = ["file_path", "file_block_start", "line"]
    raw = raw.select(*[F.col(c) for c in header], "broken", "_metadata.file_path", "_metadata.file_block_start",
                     F.monotonically_increasing_id().alias("line"))
    return numbered(raw, place).withColumnRenamed("file_path", "file").drop("file_block_start", "line")


def ingest_export(spark: SparkSession, csv_path: str, out_path: str, multiline: bool = False, held_path: str | None = None) -> DataFrame:
    """Turn a gradebook export (CSV with `;`, its own column names) into the activity table, once.

    The order of lines in the export matters, so each row gets its number in it. Words for a missing value become null.
    Numbers that are none become null too, see `rejected`; with `held_path` lines with such texts, or with too few or
    too many fields, are held instead: written there with file, number, text and what is wrong, see `release`. Every line
    is then in one of the two tables. The table is laid out by `write_log`. Later jobs read it, not the export.
    """
    if held_path is None:
        raw = spark.read.csv(csv_path, sep=";", header=True, multiLine=multiline, escape='"')
        place = ["file_path", "file_block_start", "line"]
        raw = raw.select(
            *[F.col(theirs).alias(ours) for theirs, ours in EXPORT_COLUMNS.items()],
            "_metadata.file_path", "_metadata.file_block_start",
            F.monotonically_increasing_id().alias("line"),
        )
        write_log(conform(numbered(raw, place)), out_path)
        return spark.read.parquet(out_path)
    lines = materialize(read_export(spark, csv_path, multiline))  # numbered once, so that both tables agree
    rows, held = sorted_out(lines, EXPORT_COLUMNS)
    write_log(rows, out_path)
    held.write.mode("overwrite").parquet(held_path)
    return spark.read.parquet(out_path)


def release(held: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Held lines, their `record` put right by hand or rule, as activity rows; and those that still don't conform.

    A record has the activity's columns as `sorted_out` writes them. Numbers of lines stay, so rows go back to their places.
    """
    ours = list(EXPORT_COLUMNS.values())
    fields = F.from_csv("record", ", ".join(f"`{c}` string" for c in ours) + ", broken string",
                        {"sep": ";", "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"})
    raw = held.select("row_id", "file", fields.alias("r")).select("row_id", "file", "r.*")
    return sorted_out(raw, {c: c for c in ours})


def filter_activity(
    df: DataFrame,
    course_name: str | None = None,
    learner_ids: list[str] | DataFrame | None = None,
    max_step: float | None = None,
    term: str | None = None,
    learner_nos: list[str] | None = None,
    keep_null_step: bool = False,
) -> DataFrame:
    """Row filters on the raw log. They come before cleaning: a step cut after it is another result.

    A list of learners becomes a predicate at the scan, a DataFrame with `learner_id` a semi join.
    A null step fails the step cut unless `keep_null_step` counts it as 0.
    """
    if course_name is not None:
        df = df.where(F.col("course_name") == course_name)
    if term is not None:
        # every raw spelling of a term ends like it, and that part of the test reaches the scan
        df = df.where(F.col("term").endswith(term[1:]) & (repaired_term() == term))
    if isinstance(learner_ids, DataFrame):
        df = df.join(learner_ids.select("learner_id").distinct(), "learner_id", "left_semi")
    elif learner_ids is not None:
        df = df.where(F.col("learner_id").isin(list(learner_ids)))
    if learner_nos is not None:
        df = df.where(F.col("learner_no").isin(list(learner_nos)))
    if max_step is not None:
        within = F.col("step") <= max_step
        df = df.where(within | F.col("step").isNull() if keep_null_step and max_step >= 0 else within)
    return df


def seeded_pick(df: DataFrame, column: str, seed: int):
    """One value of a column: least seeded digest, least value on a tie. None if there is none."""
    digest = F.md5(F.concat(F.col(column).cast("string"), F.lit(f":{seed}")))
    named = df.where(F.col(column).isNotNull())
    return named.agg(F.min_by(column, F.struct(digest, F.col(column)))).first()[0]


def random_slice(df: DataFrame, seed: int, least_step: float = 15.0) -> DataFrame:
    """Activity of one drawn course and learner up to a drawn step above `least_step`.

    The three drawn values come back as literals, so that the last scan is pushed down to them.
    """
    df = df.where(F.col("course_name") == F.lit(seeded_pick(df, "course_name", seed)))
    df = df.where(F.col("learner_id") == F.lit(seeded_pick(df, "learner_id", seed)))
    return df.where(F.col("step") <= F.lit(seeded_pick(df.where(F.col("step") > least_step), "step", seed)))


def column_facts(df: DataFrame) -> DataFrame:
    """Counts and range that a caller needs to name a slice of the log."""
    return df.agg(
        F.count("*").alias("events"),
        F.countDistinct("course_name").alias("courses"),
        F.countDistinct("learner_no").alias("learners"),
        F.min("step").alias("first_step"),
        F.max("step").alias("last_step"),
    )


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    df.write.mode("overwrite").partitionBy(*(partition_by or [])).parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_predictions(df: DataFrame, path: str, format: str = "json", scoring_id: str | None = None) -> None:
    """Put predictions into the sink, as JSON below course and step folders or as CSV with a header.

    With `scoring_id` they lie below a folder of that name and replace what a scoring of the same name left there: rows
    are written aside, whole, and the folder is then put in place of the old one. So a job can be run again, and one
    that dies leaves the old rows or, between two moves, none, never half or double ones. Without, rows are appended.
    """
    if scoring_id is None:
        target, mode = path, "append"
    else:
        target, mode = f"{path}/.writing-{uuid.uuid4().hex}", "error"
    if format == "csv":
        df.write.mode(mode).option("header", True).csv(target)
    else:
        df.write.mode(mode).partitionBy("course_name", "step").json(target)
    if scoring_id is not None:
        jvm = df.sparkSession._jvm
        place = jvm.org.apache.hadoop.fs.Path(f"{path}/scoring_id={quote(scoring_id, safe='')}")
        fs = place.getFileSystem(df.sparkSession._jsc.hadoopConfiguration())
        fs.delete(place, True)
        if not fs.rename(jvm.org.apache.hadoop.fs.Path(target), place):
            raise OSError(f"{place.toString()} could not be put in place")
