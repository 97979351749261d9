"""Ingestion and publication: typed CSV scans, dataset registry, schema
conformance, ordered CSV sink, gated publication, curated views, row counts.

Paths may be any Hadoop file system URI; existence checks go through the session's
Hadoop FileSystem, never the local disk.
"""

from __future__ import annotations

import csv
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.timestamps import CANONICAL_PATTERN, empty_to_null, parse_ts_optional
from .schemas import DECLARED, columns, struct_type, timestamp_columns  # noqa: F401 (re-exported)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def require_datasets(spark: SparkSession, paths: dict[str, str]) -> None:
    """SRC-2: fail once, naming every missing input (not just the first)."""
    missing = [f"{n} ({p})" for n, p in paths.items() if not path_exists(spark, p)]
    if missing:
        raise FileNotFoundError("missing input datasets: " + ", ".join(missing))


def csv_headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The headers of a CSV file or folder, each with the files that have it. Only the first line of
    every file is read, beside the listing that any scan of the folder makes. Files without a line
    have no rows and are left out."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found: dict[tuple[str, ...], list[str]] = {}
    for file in sorted(spark.read.option("recursiveFileLookup", "true").text(path).inputFiles()):
        p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(p)
        stream = p.getFileSystem(conf).open(p)
        try:
            reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(
                codec.createInputStream(stream) if codec is not None else stream, "UTF-8"))
            line = reader.readLine()
        finally:
            stream.close()
        if line is not None:
            names = next(csv.reader([line.removeprefix("\ufeff")], escapechar="\\"), []) or [""]
            found.setdefault(tuple(names), []).append(file)
    return found


def scan_csv_text(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """The declared columns as text, '' as NULL. Every file is bound by its own header: files are
    grouped by header and each group is one scan, so a folder may mix column orders. Declared columns
    that a header lacks are NULL there (``header_issues`` names them). ``_malformed`` is the whole line
    of a row whose number of fields is not its header's (NULL otherwise), ``_file`` the row's file."""
    parts = []
    for names, files in csv_headers(spark, path).items():
        # positions as names: a header may repeat a name or hold any text
        places = T.StructType([*[T.StructField(f"_c{i}", T.StringType()) for i in range(len(names))],
                               T.StructField("_line", T.StringType())])
        # the fields' number is only checked if all fields are read: nothing of each is part of the line
        malformed = F.concat("_line", F.substring(F.concat_ws("", *[f"_c{i}" for i in range(len(names))]), 1, 0))
        rows = (spark.read.schema(places).option("header", "true").option("mode", "PERMISSIVE")
                .option("columnNameOfCorruptRecord", "_line").csv(files))
        parts.append(rows.select(*[(empty_to_null(F.col(f"_c{names.index(c)}")) if c in names else F.lit(None).cast("string")).alias(c)
                                   for c in columns(dataset)], malformed.alias("_malformed"), F.col("_metadata.file_path").alias("_file")))
    if not parts:
        none = T.StructType([T.StructField(c, T.StringType()) for c in [*columns(dataset), "_malformed", "_file"]])
        return spark.createDataFrame([], none)
    return reduce(DataFrame.unionByName, parts)


def malformed_rows(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """The rows of a CSV file or folder with too few or too many fields: file and whole line."""
    return scan_csv_text(spark, path, dataset).filter("_malformed is not null").select(
        F.lit(dataset).alias("dataset"), F.col("_file").alias("file"), F.col("_malformed").alias("line"))


def header_issues(spark: SparkSession, path: str, dataset: str) -> list[tuple]:
    """Missing, extra and repeated columns of any header of a CSV file or folder: (dataset, column, issue)."""
    declared, out = columns(dataset), {}
    for names in csv_headers(spark, path):
        out |= dict.fromkeys([*[(dataset, c, "missing") for c in declared if c not in names],
                              *[(dataset, c, "extra") for c in names if c not in declared],
                              *[(dataset, c, "repeated") for i, c in enumerate(names) if c in names[:i]]])
    return list(out)


def _converted(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.TimestampNTZType):
        return parse_ts_optional(text)
    return text.try_cast(kind)


def scan_csv_typed(spark: SparkSession, path: str, dataset: str, keep_raw: bool = False) -> DataFrame:
    """SRC-1: a header CSV, or a folder of them, typed to its declared schema. No row and no value goes
    silently: text that does not convert is NULL in its column and kept with its name in
    ``_unconverted`` (an array of column and text, empty for clean rows) when ``keep_raw`` is set, and a
    row with too few or too many fields keeps its whole line in ``_malformed``; ``keep_raw`` also
    keeps the text of every timestamp as ``_raw_<column>`` for rules TS-*. Without it such text and such
    rows raise."""
    text = scan_csv_text(spark, path, dataset)
    kinds = dict(DECLARED[dataset][1])
    bad = F.filter(F.array(*[F.when(F.col(c).isNotNull() & _converted(F.col(c), k).isNull(),
                                    F.struct(F.lit(c).alias("column"), F.col(c).alias("text")))
                             for c, k in kinds.items()]), lambda x: x.isNotNull())
    if keep_raw:
        return text.select(*[_converted(F.col(c), k).alias(c) for c, k in kinds.items()],
                           *[F.col(c).alias("_raw_" + c) for c in timestamp_columns(dataset)], bad.alias("_unconverted"), "_malformed")
    whole = text.filter(F.when(F.col("_malformed").isNull(), F.lit(True)).otherwise(F.raise_error(F.concat(
        F.lit(f"{dataset}: fields do not fit the header: "), F.col("_malformed"))).cast("boolean")))
    return whole.select(*[F.when(F.col(c).isNotNull() & _converted(F.col(c), k).isNull(), F.raise_error(F.concat(
        F.lit(f"{dataset}.{c} does not convert: "), F.col(c))).cast(k)).otherwise(_converted(F.col(c), k)).alias(c)
        if not isinstance(k, T.StringType) else F.col(c) for c, k in kinds.items()])


def conversion_counts(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """SRC-4 on data: per declared column, the rows of a CSV file and those whose text does not
    convert to the declared type (one aggregate over one scan)."""
    scan = scan_csv_typed(spark, path, dataset, keep_raw=True)
    names = columns(dataset)
    counts = scan.agg(F.count(F.lit(1)).alias("n"), *[
        F.count(F.when(F.array_contains("_unconverted.column", c), 1)).alias(c) for c in names])
    return counts.select(F.lit(dataset).alias("dataset"), F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col("n").alias("n_rows"), F.col(c).alias("n_unconverted")) for c in names])))


def schema_conformance(df: DataFrame, dataset: str, check_types: bool = False) -> list[tuple]:
    """SRC-4: differences between a DataFrame's columns and the declared list:
    (dataset, column, issue, expected, actual) with issue in missing / extra / position /
    type. ``df.to(schema)`` is not a check: it silently drops and fills columns."""
    declared = DECLARED[dataset][1]
    actual = [(f.name, f.dataType) for f in df.schema.fields]
    anames = [a for a, _ in actual]
    dnames = [d for d, _ in declared]
    out = []
    for i, (c, t) in enumerate(declared):
        if c not in anames:
            out.append((dataset, c, "missing", t.simpleString(), None))
            continue
        at = dict(actual)[c]
        if check_types and at.simpleString() != t.simpleString():
            out.append((dataset, c, "type", t.simpleString(), at.simpleString()))
    for c, t in actual:
        if c not in dnames:
            out.append((dataset, c, "extra", None, t.simpleString()))
    common_d = [c for c in dnames if c in anames]
    common_a = [c for c in anames if c in dnames]
    for c_d, c_a in zip(common_d, common_a):
        if c_d != c_a:
            out.append((dataset, c_a, "position", c_d, c_a))
    return out


CONFORMANCE_SCHEMA = "dataset string, column string, issue string, expected string, actual string"


@dataclass
class DatasetRegistry:
    """SRC-5: the ten tables as one named set, optionally exposed as temp views."""
    tables: dict[str, DataFrame] = field(default_factory=dict)

    def register(self, name: str, df: DataFrame) -> "DatasetRegistry":
        self.tables[name] = df
        return self

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    def create_views(self, prefix: str = "") -> list[str]:
        """SNK-3 (views): one temp view per table."""
        names = []
        for n, df in self.tables.items():
            df.createOrReplaceTempView(prefix + n)
            names.append(prefix + n)
        return names

    def row_counts(self) -> DataFrame:
        """SNK-4: row count of every table as one DataFrame (one small aggregate each,
        unioned: a single job, only the counts reach the driver)."""
        parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("dataset"), "n_rows")
                 for n, df in self.tables.items()]
        return reduce(DataFrame.unionByName, parts)


def write_csv_ordered(df: DataFrame, path: str, dataset: str | None = None, cols: list[str] | None = None) -> None:
    """SNK-1: header CSV with the declared column order, overwriting. Missing values are
    written as empty fields (not as ``""``), timestamps in canonical text."""
    names = cols or columns(dataset)
    (df.select(*names).write.mode("overwrite").option("header", "true").option("emptyValue", "")
     .option("nullValue", "").option("timestampNTZFormat", CANONICAL_PATTERN)
     .option("timestampFormat", CANONICAL_PATTERN).csv(path))


def switch_pointer(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small text file in one step: written beside it, then renamed over it, so a reader
    finds the old or the new text and never none."""
    import uuid
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs, target = _fs(spark, path)
    fs.mkdirs(target.getParent())
    draft = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex[:8]}")
    out = fs.create(draft, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(
        fs.makeQualified(draft), fs.makeQualified(target), how)


def read_pointer(spark: SparkSession, path: str) -> str | None:
    """Text of a pointer file, None if there is none yet."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_gated(spark: SparkSession, tables: dict[str, DataFrame], violations: DataFrame, target: str,
                  fmt: str = "csv", partition_by: dict[str, list[str]] | None = None) -> dict:
    """SNK-2: publish the ten tables only when all 100 rules ran, none found an ERROR, and every
    table has exactly its declared columns.

    The gate is one small aggregate (the only value brought to the driver). On success the tables
    are written in declared column order to a fresh run directory and the ``_CURRENT`` pointer is
    switched last, so readers never see a half-written publication. ``fmt='parquet'`` writes curated
    tables, partitioned as ``partition_by`` says."""
    from ..quality.suite import gate, not_evaluated
    g = gate(violations, tables).collect()[0]
    issues = [i for t in DECLARED for i in (schema_conformance(tables[t], t) if t in tables else [(t, None, "missing table", None, None)])
              if i[2] != "position"]
    result = {"n_errors": int(g["n_errors"]), "passed": bool(g["passed"]) and not issues, "published": False, "run_path": None,
              "not_evaluated": not_evaluated(tables), "schema_issues": issues}
    if not result["passed"]:
        return result
    import uuid
    run = f"{target.rstrip('/')}/run-{uuid.uuid4().hex[:12]}"
    for name in DECLARED:
        if fmt == "csv":
            write_csv_ordered(tables[name], f"{run}/{name}", name)
        else:
            write_curated(tables[name].select(*columns(name)), f"{run}/{name}", (partition_by or {}).get(name, []))
    switch_pointer(spark, f"{target.rstrip('/')}/_CURRENT", run)
    result.update(published=True, run_path=run)
    return result


def write_curated(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """SNK-3 (tables): columnar output partitioned for pruning (e.g. by date)."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def publish_partitions(df: DataFrame, path: str, column: str, touched: list | None = None) -> None:
    """SNK-3, incremental: replace just the partitions of ``column`` that ``df`` has rows for (dynamic
    partition overwrite), one writer per partition value and 128 MB or so of it. Values in ``touched``
    that have no rows any more lose their partition; all others stay as they are."""
    spark = df.sparkSession
    (df.hint("rebalance", F.col(column)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(column).parquet(path))
    if touched:
        left = {r[0] for r in df.filter(F.col(column).isin(touched)).select(F.col(column).cast("string")).distinct().collect()}
        for value in touched:
            fs, p = _fs(spark, f"{path}/{column}={value}")
            if str(value) not in left and fs.exists(p):
                fs.delete(p, True)


def read_published(spark: SparkSession, target: str, dataset: str, fmt: str = "csv") -> DataFrame | None:
    """SNK-2, reader: a table of the run that is current now; a publication that ends later does not change
    what this DataFrame reads. None before the first publication."""
    run = read_pointer(spark, f"{target.rstrip('/')}/_CURRENT")
    if run is None:
        return None
    return scan_csv_typed(spark, f"{run}/{dataset}", dataset) if fmt == "csv" else spark.read.parquet(f"{run}/{dataset}")


def retire_runs(spark: SparkSession, target: str, keep: int) -> list[str]:
    """Delete published runs but the newest ``keep`` and the current one; readers of those lose nothing.
    Returns the deleted paths."""
    fs, base = _fs(spark, target)
    current = read_pointer(spark, f"{target.rstrip('/')}/_CURRENT")
    runs = sorted((x for x in fs.listStatus(base) if x.isDirectory() and x.getPath().getName().startswith("run-")),
                  key=lambda x: (-x.getModificationTime(), x.getPath().getName()))
    gone = [x.getPath() for x in runs[keep:] if x.getPath().getName() != (current or "").rstrip("/").rsplit("/", 1)[-1]]
    for p in gone:
        fs.delete(p, True)
    return [str(p) for p in gone]
