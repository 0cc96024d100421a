"""Publishing partitions under their published names, with a table of the files written.

A run stages its partitions below ``_staging``, hashes the bytes written where they lie, and
then moves each file to its name: ``part.parquet``, and ``part.00001.parquet`` and so on for
the further pieces of a partition too large for one file. The table of its files, kept below
``_files``, is written last and is the run's commit mark. Folders that start with an underscore
are not seen by readers of the tree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from partledger.functions import names
from partledger.functions.digests import object_tag
from partledger.operators.lineage import type_name
from partledger.sinks.archive import write_partitions
from partledger.spec import PARQUET_FILE, SIA_PA, DatasetSpec

STAGING, FILES = "_staging", "_files"
#: Types of partition columns in tables; ``mes`` and ``ano`` are numbers there.
_KEY_TYPES = {"ano": "int", "mes": "int"}
#: How documents describe the columns that the path holds, after the data columns.
_PATH_TYPES = {"agravo": "VARCHAR", "ano": "BIGINT", "mes": "VARCHAR", "uf": "VARCHAR"}


def piece_name(piece: Column) -> Column:
    """Published name of a partition's piece, counted from 0."""
    numbered = F.concat(F.lit("part."), F.lpad(piece.cast("string"), 5, "0"), F.lit(".parquet"))
    return F.when(piece == 0, F.lit(PARQUET_FILE)).otherwise(numbered)


def directory(spec: DatasetSpec) -> Column:
    """Directory of a row's partition below the data set's root."""
    parts = []
    for c in spec.partition_cols:
        value = names.two_digits(F.col(c)) if c == "mes" else F.col(c).cast("string")
        parts.append(F.concat(F.lit(f"{c}="), value))
    return F.concat_ws("/", *parts)


def _from_path(spec: DatasetSpec) -> list[Column]:
    return [
        F.regexp_extract("path", f"/{c}=([^/]+)/", 1).cast(_KEY_TYPES.get(c, "string")).alias(c)
        for c in spec.partition_cols
    ]


def published_schema(schema: T.StructType, spec: DatasetSpec = SIA_PA) -> list[tuple[str, str]]:
    """Names and types as a document lists them: data columns, then those of the path by name."""
    fields = [(f.name, type_name(f.dataType)) for f in schema.fields if f.name not in spec.partition_cols]
    return fields + [(c, _PATH_TYPES[c]) for c in sorted(spec.partition_cols)]


def hashed_files(spark: SparkSession, root: str, spec: DatasetSpec = SIA_PA) -> DataFrame:
    """Partition columns, ``path, bytes, sha256, etag`` of the data files below ``root`` as they are.

    Each file is read and hashed by one task, and its bytes go no further; a file may have 2 GiB.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(root)
    )
    digests = files.select(
        "path",
        F.length("content").cast("bigint").alias("bytes"),
        F.sha2("content", 256).alias("sha256"),
        object_tag(F.col("content")).alias("etag"),
    )
    inside = F.lit(True)
    for c in spec.partition_cols:
        inside = inside & F.col("path").rlike(f"/{c}=[^/]+/")
    return digests.filter(inside).select(*_from_path(spec), "path", "bytes", "sha256", "etag")


def stage(
    data: DataFrame,
    root: str,
    run: str,
    spec: DatasetSpec = SIA_PA,
    sort_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Writes the partitions of ``data`` aside; returns the stored table of their files.

    Partition columns, ``piece, name, path, bytes, sha256, etag, schema, ddl``. Staging a run
    again replaces what it staged before, also where the new one has fewer partitions or none.
    """
    spark = data.sparkSession
    folder = f"{root.rstrip('/')}/{STAGING}/run={run}"
    _delete(spark, folder)
    write_partitions(data, f"{folder}/data", spec, sort_cols)
    found = hashed_files(spark, f"{folder}/data", spec)
    # A partition's pieces are as many as its bytes need.
    pieces = Window.partitionBy(*spec.partition_cols).orderBy("path")
    plain = T.StructType([f for f in data.schema.fields if f.name not in spec.partition_cols])
    columns = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(t).alias("type")) for n, t in published_schema(data.schema, spec)])
    table = (
        found.withColumn("piece", (F.row_number().over(pieces) - 1).cast("int"))
        .withColumn("name", F.concat_ws("/", directory(spec), piece_name(F.col("piece"))))
        .withColumn("schema", columns)
        .withColumn("ddl", F.lit(plain.json()))
    )
    table.write.parquet(f"{folder}/files")
    return spark.read.parquet(f"{folder}/files")


def commit(spark: SparkSession, root: str, run: str, spec: DatasetSpec = SIA_PA) -> None:
    """Moves a staged run's files to their names and keeps its table of files as the commit mark.

    Directory operations only, two or three a file. Stopped halfway it can be called again:
    files that are at their place already are left there. Pieces of an earlier, larger version
    of a partition go; other partitions are not touched.
    """
    base = root.rstrip("/")
    folder = f"{base}/{STAGING}/run={run}"
    files = spark.read.parquet(f"{folder}/files")
    context, path = _context(spark, base), spark._jvm.org.apache.hadoop.fs.Path
    overwrite = spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    keep = {}
    for row in files.select("path", "name").toLocalIterator():
        source, target = path(row["path"]), path(f"{base}/{row['name']}")
        if context.util().exists(source):
            context.mkdir(target.getParent(), None, True)
            context.rename(source, target, overwrite)
        keep.setdefault(row["name"].rpartition("/")[0], set()).add(row["name"].rpartition("/")[2])
    for folder_name, wanted in keep.items():
        for status in context.util().listStatus(path(f"{base}/{folder_name}")):
            name = status.getPath().getName()
            if name.endswith(".parquet") and name not in wanted:
                context.delete(status.getPath(), False)
    files.drop("path").write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{base}/{FILES}/run={run}")
    _delete(spark, folder)


def publish(
    data: DataFrame, root: str, run: str, spec: DatasetSpec = SIA_PA, sort_cols: Sequence[str] | None = None
) -> DataFrame:
    """Stages and commits the partitions of ``data``; returns :func:`published_files`."""
    stage(data, root, run, spec, sort_cols)
    commit(data.sparkSession, root, run, spec)
    return published_files(data.sparkSession, root, spec)


def unfinished_runs(spark: SparkSession, root: str) -> list[str]:
    """Staged runs without a commit mark, oldest name first: to be committed or staged again."""
    base = root.rstrip("/")
    context, path = _context(spark, base), spark._jvm.org.apache.hadoop.fs.Path
    staged = path(f"{base}/{STAGING}")
    if not context.util().exists(staged):
        return []
    return sorted(s.getPath().getName().partition("=")[2] for s in context.util().listStatus(staged))


def published_files(spark: SparkSession, root: str, spec: DatasetSpec = SIA_PA) -> DataFrame:
    """The files of each partition's last run (by name): partition columns, ``run, piece, name,
    bytes, sha256, etag, schema, ddl``."""
    base = f"{root.rstrip('/')}/{FILES}"
    runs = spark.read.option("basePath", base).parquet(f"{base}/run=*").withColumn("run", F.col("run").cast("string"))
    cols = list(spec.partition_cols)
    last = runs.groupBy(*cols).agg(F.max("run").alias("_last"))
    return runs.join(last, cols).filter(F.col("run") == F.col("_last")).drop("_last")


def outputs(files: DataFrame, spec: DatasetSpec = SIA_PA) -> DataFrame:
    """Partition columns, ``bytes, files, sha256`` per partition.

    The hash of a partition of one file is the file's; of several, that of their hashes as
    text in order of the pieces. ``files`` has ``name`` or ``path``.
    """
    where = F.element_at(F.split("name" if "name" in files.columns else "path", "/"), -1)
    # The first piece's name sorts after the others': it has no number.
    order = F.when(where == PARQUET_FILE, F.lit("")).otherwise(where)
    grouped = files.groupBy(*spec.partition_cols).agg(
        F.sum("bytes").alias("bytes"),
        F.count(F.lit(1)).alias("files"),
        F.array_sort(F.collect_list(F.struct(order.alias("at"), "sha256"))).alias("_pieces"),
    )
    hashes = F.transform("_pieces", lambda p: p["sha256"])
    whole = F.when(F.size(hashes) == 1, hashes[0]).otherwise(F.sha2(F.array_join(hashes, "").cast("binary"), 256))
    return grouped.select(*spec.partition_cols, "bytes", "files", whole.alias("sha256"))


def describe_published(files: DataFrame, spec: DatasetSpec = SIA_PA) -> DataFrame:
    """Partition columns, ``columns`` and ``schema`` of each partition as it was written."""
    first = files.filter(F.col("piece") == 0)
    return first.select(*spec.partition_cols, F.size("schema").alias("columns"), "schema")


def _context(spark: SparkSession, root: str):
    jvm = spark._jvm
    uri = jvm.org.apache.hadoop.fs.Path(root).toUri()
    conf = spark._jsc.hadoopConfiguration()
    if uri.getScheme() is None:
        return jvm.org.apache.hadoop.fs.FileContext.getFileContext(conf)
    return jvm.org.apache.hadoop.fs.FileContext.getFileContext(uri, conf)


def _delete(spark: SparkSession, folder: str) -> None:
    context, path = _context(spark, folder), spark._jvm.org.apache.hadoop.fs.Path(folder)
    if context.util().exists(path):
        context.delete(path, True)


def drop_documents(gone: DataFrame, root: str, dataset: str) -> int:
    """Removes the provenance documents of the given partitions (``KEY``), as part of a commit.

    Every key is checked before anything goes. Returns how many there were; directory
    operations only, one a partition.
    """
    spark = gone.sparkSession
    key = names.provenance_key(F.lit(dataset), F.col("ano"), F.col("uf"), F.col("mes"))
    checked = gone.select(names.require_provenance_upload_key(key, dataset).alias("key")).distinct()
    base = root.rstrip("/")
    context, path, removed = _context(spark, base), spark._jvm.org.apache.hadoop.fs.Path, 0
    for row in checked.toLocalIterator():
        folder = path(f"{base}/{row['key'].rpartition('/')[0]}")
        if context.util().exists(folder):
            context.delete(folder, True)
            removed += 1
    return removed
