"""Detection feeds: tagged CSV lists, directory globs and raw response bodies.

Feeds differ in layout (near-real-time files lack ``type``, instruments add
their own columns), so every file is read by its own header as text columns
and projected *by name* onto the declared schema: absent columns become
typed nulls, extra columns are dropped, nothing is inferred.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from hazardpanel.operators.metrics import side_by_side
from hazardpanel.schemas import DETECTION_CSV


#: ``type`` of a row whose text is neither empty nor a number: no known type, so
#: neither filter (type 0; type 0 or unknown) keeps it, and ``unreadable`` counts it.
UNREADABLE = -1
_MISSING = ["", "na", "nan", "null", "none", "n/a"]


def parse_field(text: Column, field: T.StructField) -> Column:
    """A text cell as its declared type.  Whole numbers may be written with a
    fraction of zero (``2.0``, as tables with gaps are).  Text in ``type`` that is
    no number becomes ``UNREADABLE``, never "unknown"; elsewhere it is null."""
    if not isinstance(field.dataType, T.IntegralType):
        return text.try_cast(field.dataType)
    number = text.try_cast("double")
    whole = F.when(number == F.floor(number), number).try_cast(field.dataType)
    exact = F.coalesce(text.try_cast(field.dataType), whole)       # long ids keep all their digits
    if field.name != "type":
        return exact
    missing = text.isNull() | F.lower(F.trim(text)).isin(_MISSING)
    return F.when(~missing, F.coalesce(exact, F.lit(UNREADABLE).cast(field.dataType)))


def unreadable(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows whose ``type`` could not be read (per ``by``)."""
    bad = F.count_if(F.col("type") == UNREADABLE).alias("n_unreadable")
    return df.groupBy(*by).agg(bad) if by else df.agg(bad)


def _project(df: DataFrame, schema: T.StructType) -> DataFrame:
    have = set(df.columns)
    cols: list[Column] = []
    for f in schema.fields:
        if f.name in have:
            cols.append(parse_field(F.col(f"`{f.name}`"), f).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def _names_two(line: Column, names: Sequence[str]) -> Column:
    """A cheap test that every header line passes and hardly a data line does: at least
    two names of the schema stand in it.  No splitting, no pattern."""
    hits = [line.contains(n) for n in names]
    some = hits[0]
    for h in hits[1:]:
        some = some | h
    return some & (sum(h.cast("int") for h in hits[1:]) + hits[0].cast("int") >= 2)


def read_by_own_header(spark: SparkSession, path: str, schema: T.StructType, file_glob: str = "*.csv") -> DataFrame:
    """All CSV files matching ``path``, each read by *its own* header, projected
    by name onto ``schema``, with the file's path in ``_file``.

    Spark's CSV reader takes the header of one file for all of them.  So header
    lines (they name at least two columns of ``schema``; data lines name none) are
    looked up first, in the first split of each file and with a plain substring test
    before any line is taken apart, and files of one layout are read together: each
    file by one scan.  Files without a header line (empty ones) hold no rows.
    """
    names = F.array(*[F.lit(n) for n in schema.names])
    lines = spark.read.option("pathGlobFilter", file_glob).text(path).filter((F.col("_metadata.file_block_start") == 0) & _names_two(F.col("value"), schema.names))
    lines = lines.select("value", F.col("_metadata.file_path").alias("_file"))
    fields = F.transform(F.split("value", ","), lambda x: F.trim(F.regexp_replace(x, '["\r\ufeff]', "")))
    headers = lines.select("_file", fields.alias("h")).filter(F.size(F.array_intersect("h", names)) >= 2).distinct()
    # file names reach the driver, where Spark's own file listing holds them as well; joining every line
    # with its file's header instead would shuffle all lines once that table is too large to broadcast
    layouts = headers.groupBy("h").agg(F.collect_set("_file").alias("files")).collect()
    out = None
    for row in sorted(layouts, key=lambda r: r["h"]):
        layout = T.StructType([T.StructField(n, T.StringType()) for n in row["h"]])
        raw = spark.read.schema(layout).option("header", True).option("enforceSchema", True).csv(row["files"])
        one = _project(raw.withColumn("_file", F.col("_metadata.file_path")), with_extra(schema, [("_file", T.StringType())]))
        out = one if out is None else out.unionByName(one)
    return out if out is not None else spark.createDataFrame([], with_extra(schema, [("_file", T.StringType())]))


def with_extra(schema: T.StructType, extra: Sequence[tuple[str, T.DataType]] = ()) -> T.StructType:
    fields = list(schema.fields) + [T.StructField(n, t) for n, t in extra if n not in schema.names]
    return T.StructType(fields)


def read_csv_by_header(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read header CSVs as text and project their columns by name onto ``schema``."""
    return read_by_own_header(spark, path, schema, "*").drop("_file")


def read_detections(spark: SparkSession, sources: Iterable[tuple[str, dict]],
                    schema: T.StructType = DETECTION_CSV) -> DataFrame:
    """Union of tagged feeds; a listed path that does not exist is skipped.

    ``sources`` is ``[(path, {"tag_column": "value", ...}), ...]``; every
    file gets its tags as literal columns.  Tag columns missing from some
    feeds come out null (``unionByName(allowMissingColumns=True)``).
    """
    frames = []
    for path, tags in sources:
        try:
            df = read_csv_by_header(spark, path, schema)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
                continue
            raise
        for k, v in (tags or {}).items():
            df = df.withColumn(k, F.lit(v))
        frames.append(df)
    if not frames:
        return spark.createDataFrame([], schema)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def scan_glob(spark: SparkSession, pattern: str, schema: T.StructType = DETECTION_CSV,
              source_regex: str = r"([^/]+)/[^/]+$", file_glob: str = "*.csv") -> DataFrame:
    """All feeds matching a directory glob; the source name comes from the file
    path (by default the name of the folder holding the file)."""
    rows = read_by_own_header(spark, pattern, schema, file_glob)
    return rows.withColumn("source", F.lower(F.regexp_extract("_file", source_regex, 1))).drop("_file")


def _body_lines(body_col: str) -> Column:
    return F.filter(F.split(F.regexp_replace(F.col(body_col), "\r", ""), "\n"), lambda x: F.length(F.trim(x)) > 0)


def _accepted(lines: Column) -> Column:
    """A body counts when it has a header with a comma and a line after it."""
    return F.coalesce((F.size(lines) >= 2) & lines[0].contains(","), F.lit(False))


def parse_body_lines(bodies: DataFrame, schema: T.StructType = DETECTION_CSV,
                     body_col: str = "value", source_col: str | None = "source") -> DataFrame:
    """Every data line of the accepted bodies: the columns of ``schema`` and
    ``_corrupt``, the line itself where it does not fit its header.

    Lines are parsed as CSV (quotes may hold commas) by their own body's header;
    bodies of one header are parsed together, so there are as many scans as
    layouts.  A line with too few or too many fields is corrupt, not fatal.
    """
    keep = [source_col] if source_col and source_col in bodies.columns else []
    cut = bodies.select(*keep, _body_lines(body_col).alias("_lines"))
    lines = cut.filter(_accepted(F.col("_lines"))).select(*keep, F.col("_lines")[0].alias("_head"), F.explode(F.slice("_lines", 2, F.size("_lines"))).alias("_line"))
    out = None
    for (head,) in lines.select("_head").distinct().orderBy("_head").collect():      # one row per layout
        names = [n.strip().strip('"') for n in head.split(",")]
        parsed = lines.filter(F.col("_head") == head).select(*keep, F.from_csv(
            "_line", ", ".join(f"`{n}` string" for n in [*names, "_corrupt"]),
            {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("r"))
        flat = parsed.select(*keep, "r.*")
        cols = [parse_field(F.col(f"`{f.name}`"), f).alias(f.name) if f.name in names else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
        one = flat.select(*keep, *cols, "_corrupt")
        out = one if out is None else out.unionByName(one)
    if out is None:
        return lines.select(*keep, *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields], F.lit(None).cast("string").alias("_corrupt"))
    return out


def parse_bodies(bodies: DataFrame, schema: T.StructType = DETECTION_CSV,
                 body_col: str = "value", source_col: str | None = "source") -> DataFrame:
    """Rows out of raw CSV response bodies (one body per row).

    A body is rejected when, after dropping blank lines, it has fewer than two
    lines or its header has no comma (error pages, empty answers); a line that
    does not fit its header is left out.  ``body_audit`` counts both.
    """
    return parse_body_lines(bodies, schema, body_col, source_col).filter(F.col("_corrupt").isNull()).drop("_corrupt")


def read_bodies(spark: SparkSession, pattern: str, source_regex: str = r"source=([^/]+)/") -> DataFrame:
    """One row per landed response file (whole text), with its source name."""
    raw = spark.read.text(pattern, wholetext=True)
    return raw.withColumn("source", F.regexp_extract(F.col("_metadata.file_path"), source_regex, 1))


def body_audit(bodies: DataFrame, schema: T.StructType = DETECTION_CSV, body_col: str = "value") -> DataFrame:
    """One row: accepted and rejected bodies, and lines left out of the accepted ones."""
    ok = _accepted(_body_lines(body_col))
    counts = bodies.agg(F.count_if(ok).alias("accepted"), F.count_if(~ok).alias("rejected"))
    lines = parse_body_lines(bodies, schema, body_col, None).agg(F.count_if(F.col("_corrupt").isNotNull()).alias("corrupt_lines"))
    return side_by_side(counts, lines).select(*[F.col(c).cast("long").alias(c) for c in ("accepted", "rejected", "corrupt_lines")])
