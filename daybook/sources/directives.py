"""Directive files in, problems sorted out. Batch and stream read through the same steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.identity import is_blank
from daybook.schema import DIRECTIVE

# Error types that do not stop a load (fixed values).
WARNINGS = ["PadError", "DeprecatedError"]
CORRUPT = "_corrupt_record"
UNREADABLE = "unreadable"      # kind of a row that stands for a line that does not parse; `description` holds the line
SHORT = 2 ** 16                # bytes of a file that may be a packed empty one
IN_FILE_BITS = 40              # positions inside a file are below 2**40


class CriticalErrors(ValueError):
    """Raised when the input holds errors that stop a load."""


def shaped(df: DataFrame, fmt: str) -> DataFrame:
    """Rows of a directive source (for JSON its lines, as `value`), batch or stream, as directives.

    Rows without a file name get the path they were read from. A JSON line that does not parse
    stays as a row of the kind `unreadable`, which no load accepts."""
    path = F.col("_metadata.file_path")
    if fmt == "json":
        schema = T.StructType(DIRECTIVE.fields + [T.StructField(CORRUPT, T.StringType())])
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
        # exploded, so that conditions on what is parsed stay above it: moved below, each would parse every line again
        parsed = F.explode(F.array(F.from_json("value", schema, options)))
        df = df.filter(F.trim("value") != "").select(parsed.alias("r"), path.alias("file_path")).select("r.*", "file_path")
        bad = F.col(CORRUPT).isNotNull()
        df = df.withColumns({"kind": F.when(bad, UNREADABLE).otherwise(F.col("kind")),
                             "description": F.when(bad, F.col(CORRUPT)).otherwise(F.col("description"))}).drop(CORRUPT)
    else:
        df = df.withColumn("file_path", path)
    return df.withColumn("source_file", F.coalesce("source_file", "file_path"))


def _raw(reader, paths, fmt: str) -> DataFrame:
    return (reader.format("text") if fmt == "json" else reader.schema(DIRECTIVE).format(fmt)).load(paths)


def _files(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """The files below a path that hold rows (file_path). Of text only short files are read for that: no packer makes a long one of nothing."""
    paths = lambda df: df.select(F.col("_metadata.file_path").alias("file_path"))
    if fmt != "json":
        return paths(_raw(spark.read, path, fmt)).distinct()
    size = F.col("_metadata.file_size")
    listed = spark.read.format("binaryFile").load(path)      # its content is not read where it is not asked for
    return paths(listed.filter(size >= SHORT)).unionByName(paths(_raw(spark.read, path, fmt).filter(size < SHORT))).distinct()


def read_directives(spark: SparkSession, paths: str | list[str], fmt: str = "json", positions: str = "run") -> DataFrame:
    """Directives of one or many paths together.

    positions='run': `seq` is unique over everything that is read together; a load checks it.
    positions='file': `seq` counts inside each file; files follow each other in the order of
    the given paths, then by name, and positions are made unique in that order."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    df = shaped(_raw(spark.read, paths, fmt), fmt)
    if positions == "run":
        return df.drop("file_path")
    if positions != "file":
        raise ValueError("positions must be 'run' or 'file'")
    parts = [_files(spark, p, fmt).select("file_path", F.lit(i).alias("part")) for i, p in enumerate(paths)]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    # one row per file, as in the listing the driver holds anyway
    order = dict.fromkeys(r.file_path for r in sorted(found.collect(), key=lambda r: (r.part, r.file_path)))
    ranks = spark.createDataFrame([(f, i) for i, f in enumerate(order)], "file_path string, _file bigint")
    inside = (F.col("seq") >= 0) & (F.col("seq") < 1 << IN_FILE_BITS)
    place = F.shiftleft(F.col("_file"), IN_FILE_BITS) + F.col("seq")
    # broadcast: joined otherwise, the rows of a file would all be moved to one task
    return df.join(F.broadcast(ranks), "file_path").withColumn("seq", F.when(inside, place)).select(*[f.name for f in DIRECTIVE.fields])


def stream_directives(spark: SparkSession, path: str, fmt: str, max_files: int) -> DataFrame:
    """The same rows from a folder that files arrive in; `file_path` is kept."""
    return shaped(_raw(spark.readStream.option("maxFilesPerTrigger", max_files), path, fmt), fmt)


def parse_errors(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """JSON lines that do not parse, as error rows."""
    return unreadable(read_directives(spark, paths, "json"))


def unreadable(d: DataFrame) -> DataFrame:
    """Error rows for the lines of a run that did not parse."""
    return d.filter(F.col("kind") == UNREADABLE).select(
        F.lit("ParserError").alias("error_type"), F.col("description").alias("message"),
        "source_file", F.lit(None).cast("bigint").alias("source_line"))


def triage_errors(errors: DataFrame) -> DataFrame:
    """Add severity and a readable place to error rows (error_type, message, source_file, source_line)."""
    place = F.concat(F.coalesce("source_file", F.lit("unknown")), F.lit(":"),
                     F.coalesce(F.col("source_line").cast("string"), F.lit("unknown")))
    return (errors.withColumn("severity", F.when(F.col("error_type").isin(WARNINGS), "warning").otherwise("critical"))
            .withColumn("place", F.when(~is_blank("source_file") | F.col("source_line").isNotNull(), place)))


def assert_no_critical(errors: DataFrame) -> int:
    """Raise if any error is critical; otherwise the number of warnings."""
    marked = triage_errors(errors)
    seen = {r.severity: r.n for r in marked.groupBy("severity").agg(F.count(F.lit(1)).alias("n")).collect()}
    if n := seen.get("critical"):
        first = marked.filter("severity = 'critical'").select("error_type", "place", "message").limit(1).collect()[0]
        raise CriticalErrors(f"{n} critical errors, such as {first.error_type} at {first.place}: {first.message}")
    return seen.get("warning", 0)
