"""CSV scans. The format turns empty strings into NULL; Parquet layers do not."""

from __future__ import annotations

import csv
import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_strata import storage
from retail_strata.schemas import CLOUD_SCHEMAS

#: Names that Spark gives to the parts of one job; the identifier is the job's.
_PART = re.compile(r"part-\d+-([0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})")


def headers(
    spark: SparkSession, path: str | list[str], encoding: str = "UTF-8"
) -> dict[str, list[tuple[str, str | None]]]:
    """What to read under each header line: ``(path, pattern of its file names or None)``.

    Parts of one job have one header, so only one of them is opened, for its first line; other files
    are opened one by one. Files without a line are left out. No job runs and no text is scanned.
    """
    found: dict[str, list[tuple[str, str | None]]] = {}

    def add(line: str | None, place: str, pattern: str | None = None) -> bool:
        if line is not None:
            found.setdefault(line, []).append((place, pattern))
        return line is not None

    for given in [path] if isinstance(path, str) else path:
        for entry in storage.matches(spark, given):
            if entry.is_file:
                add(storage.first_line(spark, entry.path, encoding), entry.path)
                continue
            jobs: dict[str, str] = {}
            loose = []
            for file in storage.files_below(spark, entry.path):
                job = _PART.match(file.name)
                if file.size == 0 or (job and job[1] in jobs):
                    continue
                line = storage.first_line(spark, file.path, encoding)
                if line is not None and job:
                    jobs[job[1]] = line
                elif line is not None:
                    loose.append((line, file.path))
            lines = {*jobs.values(), *(line for line, _ in loose)}
            if len(lines) == 1:
                add(lines.pop(), entry.path)
                continue
            for job, line in jobs.items():
                add(line, entry.path, f"part-*-{job}*")
            for line, file in loose:
                add(line, file)
    return found


def read_csv(spark: SparkSession, path: str | list[str], **options: str) -> DataFrame:
    """CSV with a header row; every column is a string.

    Columns are bound by name: files under different headers are read apart, and a column that a
    file lacks is NULL in its rows. The scan checks each file it opens against the header taken for
    it and raises if that is another one, instead of giving out columns under wrong names.
    A header has one line. One with empty or repeated names is left to Spark, which renames such
    columns and does not check them.
    """
    by_header = headers(spark, path, options.get("encoding", "UTF-8"))

    def read(line: str, places: list[str], pattern: str | None) -> DataFrame:
        reader = spark.read.options(header=True, **options)
        if pattern is not None:
            reader = reader.option("pathGlobFilter", pattern)
        separator = options.get("sep", options.get("delimiter", ","))
        names = next(csv.reader([line], delimiter=separator, quotechar=options.get("quote", '"')))
        if all(names) and len({n.lower() for n in names}) == len(names):
            columns = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
            reader = reader.schema(columns).option("enforceSchema", False)
        return reader.csv(places)

    if not by_header:
        return spark.read.options(header=True, **options).csv(path)
    parts = []
    for line in sorted(by_header):
        whole = [place for place, pattern in by_header[line] if pattern is None]
        if whole:
            parts.append(read(line, whole, None))
        parts += [read(line, [place], pattern) for place, pattern in by_header[line] if pattern]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def bind_schema(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """``df`` cast to ``schema`` (name -> type) column by column, matched by name.

    A value that does not parse is NULL, a column that is absent is all NULL, others are dropped.
    """
    return df.select(
        *[
            (
                F.col(f"`{name}`").try_cast(type_)
                if name in df.columns
                else F.lit(None).cast(type_)
            ).alias(name)
            for name, type_ in schema.items()
        ]
    )


def read_entity(
    spark: SparkSession, path: str | list[str], entity: str, **options: str
) -> DataFrame:
    """CSV of a cloud entity with its declared schema, whatever the order of each file's columns."""
    return bind_schema(read_csv(spark, path, **options), CLOUD_SCHEMAS[entity])
