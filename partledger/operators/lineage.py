"""Which source files a partition was made from, and the documents that say so."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partledger.functions import names, rules
from partledger.functions.jsontext import pretty_json
from partledger.functions.times import iso_millis
from partledger.operators.listing import archived_files, missing_variant
from partledger.spec import (
    BEFORE_RECORD,
    CONVERSION_NOTES,
    FAILED,
    KEY,
    SIA_PA,
    SOURCES_VERSION,

    WRITTEN,
    DatasetSpec,
)

_STRING, _INT, _LONG = T.StringType(), T.IntegerType(), T.LongType()


def _record(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


# Layout of the documents: field names and order are fixed values of the format.
RECORDED_FILE = _record(
    bytes=_LONG, cacheMtime=_STRING, file=_STRING, ftpMtime=_STRING, ftpPath=_STRING
)
PARTITION = _record(ano=_INT, mes=_INT, uf=_STRING)
SOURCES_RECORD = _record(files=T.ArrayType(RECORDED_FILE), partition=PARTITION, version=_INT)
SOURCE_FILE = _record(bytes=_LONG, file=_STRING, ftpPath=_STRING, mtime=_STRING, sha256=_STRING)
OUTPUT = _record(
    columns=_INT,
    file=_STRING,
    fingerprint=_STRING,
    rows=_LONG,
    schema=T.ArrayType(_record(name=_STRING, type=_STRING)),
    sha256=_STRING,
)
PIPELINE = _record(archiveScript=_STRING, datasusSdk=_STRING, decoder=_STRING, notes=_STRING)
RECONSTRUCTED = _record(
    certification=_record(
        dbcRecordCount=_LONG,
        ftpNewestMtime=_STRING,
        minAgeHours=_INT,
        parquetLastModified=_STRING,
        stateSourceSize=_LONG,
    ),
    notes=_STRING,
    previous=_record(
        generatedAt=_STRING, outputSha256=_STRING, pipeline=T.MapType(_STRING, _STRING)
    ),
    reason=_STRING,
)


def build_sources_record(files: DataFrame, spec: DatasetSpec = SIA_PA) -> DataFrame:
    """One record per partition from its files (``KEY, position, name, size, mtime, cache_mtime``).

    Files keep the order in which they were read; an unknown listing time stays NULL.
    """
    entry = F.struct(
        "position",
        F.struct(
            F.col("size").alias("bytes"),
            F.col("cache_mtime").alias("cacheMtime"),
            F.col("name").alias("file"),
            iso_millis(F.col("mtime")).alias("ftpMtime"),
            F.concat(F.lit(spec.source_dir + "/"), "name").alias("ftpPath"),
        ).alias("f"),
    )
    grouped = files.groupBy(*KEY).agg(F.array_sort(F.collect_set(entry)).alias("_files"))
    record = F.struct(
        F.transform("_files", lambda e: e["f"]).alias("files"),
        F.struct("ano", "mes", "uf").alias("partition"),
        F.lit(SOURCES_VERSION).alias("version"),
    )
    return grouped.select(*KEY, record.alias("record"))


def sources_record_text(record: Column) -> Column:
    return F.concat(pretty_json(record, SOURCES_RECORD), F.lit("\n"))


def _integer(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).rlike(r"^(BIGINT|DECIMAL\(\d+,0\))$"), F.lit(False))


def _string(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value) == "STRING", F.lit(False))


def _recorded_file(item: Column) -> Column:
    """The typed entry of a sources record, NULL when any field is malformed."""

    def part(name: str) -> Column:
        return F.try_variant_get(item, f"$.{name}", "variant")

    def text(name: str) -> Column:
        return F.try_variant_get(item, f"$.{name}", "string")

    size = F.try_variant_get(item, "$.bytes", "bigint")
    ftp_mtime = part("ftpMtime")
    valid = (
        _string(part("file"))
        & (text("file") != "")
        & _string(part("ftpPath"))
        & text("ftpPath").endswith(F.concat(F.lit("/"), text("file")))
        & _integer(part("bytes"))
        & (size > 0)
        & _string(part("cacheMtime"))
        & (text("cacheMtime") != "")
        & (F.coalesce(F.is_variant_null(ftp_mtime), F.lit(False)) | _string(ftp_mtime))
    )
    entry = F.struct(
        size.alias("bytes"),
        text("cacheMtime").alias("cacheMtime"),
        text("file").alias("file"),
        F.when(_string(ftp_mtime), text("ftpMtime")).alias("ftpMtime"),
        text("ftpPath").alias("ftpPath"),
    )
    return F.when(F.coalesce(valid, F.lit(False)), entry)


def parse_sources_record(text: Column, uf: Column, ano: Column, mes: Column) -> Column:
    """``struct(problem, files)`` of a partition's sources record."""
    body = F.try_parse_json(text)

    def part(path: str) -> Column:
        return F.try_variant_get(body, path, "variant")

    version_ok = _integer(part("$.version")) & (
        F.try_variant_get(body, "$.version", "bigint") == SOURCES_VERSION
    )
    partition_ok = (
        _integer(part("$.partition.ano"))
        & _integer(part("$.partition.mes"))
        & _string(part("$.partition.uf"))
    )
    same = (
        (F.try_variant_get(body, "$.partition.uf", "string") == uf)
        & (F.try_variant_get(body, "$.partition.ano", "bigint") == ano)
        & (F.try_variant_get(body, "$.partition.mes", "bigint") == mes)
    )
    files = F.transform(F.try_variant_get(body, "$.files", "array<variant>"), _recorded_file)
    problem = (
        F.when(body.isNull(), F.lit("record-not-json"))
        .when(~F.coalesce(version_ok, F.lit(False)), F.lit("record-version"))
        .when(~partition_ok, F.lit("record-partition"))
        .when(~F.coalesce(same, F.lit(False)), F.lit("record-of-other-partition"))
        .when(files.isNull() | (F.size(files) == 0), F.lit("record-without-files"))
        .when(F.exists(files, lambda f: f.isNull()), F.lit("record-file-malformed"))
    )
    return F.struct(problem.alias("problem"), F.when(problem.isNull(), files).alias("files"))


def record_follows_rule(
    files: Column, uf: Column, ano: Column, mes: Column, spec: DatasetSpec = SIA_PA
) -> Column:
    """Whether the recorded paths are those the archive would read, in its order."""
    listed = F.array_distinct(
        F.transform(
            files,
            lambda f: F.struct(
                F.coalesce(
                    names.parse_source_name(f["file"], spec, ignore_case=False)["variant"], F.lit("?")
                ).alias("suffix"),
                f["file"].alias("name"),
            ),
        )
    )
    expected = F.transform(
        archived_files(F.array_sort(listed), uf, ano, mes, spec),
        lambda v: F.concat(F.lit(spec.source_dir + "/"), v["name"]),
    )
    return expected == F.transform(files, lambda f: f["ftpPath"])


def group_cache(cache: DataFrame, spec: DatasetSpec = SIA_PA) -> DataFrame:
    """Cached source files (``name, bytes, mtime, sha256``) per partition, in order.

    Only exact names count, as on the source.
    """
    parsed = cache.withColumn("_p", names.parse_source_name(F.col("name"), spec, ignore_case=False))
    return (
        parsed.filter(F.col("_p").isNotNull())
        .groupBy(F.col("_p.uf").alias("uf"), F.col("_p.ano").alias("ano"), F.col("_p.mes").alias("mes"))
        .agg(
            F.array_sort(
                F.collect_set(
                    F.struct(
                        F.col("_p.variant").alias("suffix"),
                        "name",
                        F.col("bytes").alias("size"),
                        "mtime",
                        "sha256",
                    )
                )
            ).alias("cached")
        )
    )


def _described(file: Column, path: Column) -> Column:
    return F.struct(
        file["size"].alias("bytes"),
        file["name"].alias("file"),
        path.alias("ftpPath"),
        file["mtime"].alias("mtime"),
        file["sha256"].alias("sha256"),
    )


def _first_problem(checked: Column) -> Column:
    return F.try_element_at(F.filter(checked, lambda c: c["problem"].isNotNull()), F.lit(1))


def _sources_from_record(files: Column, cached: Column) -> Column:
    """Each recorded file looked up in the cache and checked against the record."""

    def check(f: Column) -> Column:
        hit = F.try_element_at(F.filter(cached, lambda c: c["name"] == f["file"]), F.lit(1))
        problem = (
            F.when(hit.isNull(), F.lit("not-in-cache"))
            .when(hit["size"] == 0, F.lit("empty-in-cache"))
            .when(hit["size"] != f["bytes"], F.lit("size-differs-from-record"))
            .otherwise(rules.source_problem(hit["size"], f["bytes"], hit["sha256"], hit["mtime"]))
        )
        problem = F.coalesce(
            problem, F.when(hit["mtime"] != f["cacheMtime"], F.lit("downloaded-after-archive"))
        )
        return F.struct(
            problem.alias("problem"),
            f["file"].alias("file"),
            _described(hit, f["ftpPath"]).alias("source"),
        )

    return F.transform(files, check)


def _sources_from_cache(chosen: Column, spec: DatasetSpec) -> Column:
    def check(c: Column) -> Column:
        return F.struct(
            rules.source_problem(c["size"], c["size"], c["sha256"], c["mtime"]).alias("problem"),
            c["name"].alias("file"),
            _described(c, F.concat(F.lit(spec.source_dir + "/"), c["name"])).alias("source"),
        )

    return F.transform(chosen, check)


def choose_sources(
    partitions: DataFrame,
    cache: DataFrame,
    spec: DatasetSpec = SIA_PA,
    allow_cache_fallback: bool = False,
) -> DataFrame:
    """The sources of each partition: from its record, or from the cache when allowed.

    ``partitions`` has ``KEY, record_text``; a record always wins. Adds ``from_cache``,
    ``problem``, ``problem_file`` and ``sources`` (NULL when there is a problem). The
    cache is grouped once and joined on the partition key.
    """
    uf, ano, mes = (F.col(c) for c in KEY)
    empty = F.expr("cast(array() as array<struct<suffix:string,name:string,size:bigint,mtime:string,sha256:string>>)")
    df = partitions.join(group_cache(cache, spec), KEY, "left").withColumn(
        "cached", F.coalesce("cached", empty)
    )
    df = df.withColumn(
        "_record",
        F.when(F.col("record_text").isNotNull(), parse_sources_record(F.col("record_text"), uf, ano, mes)),
    )
    present = F.filter("cached", lambda c: c["size"] > 0)
    df = df.withColumn("_chosen", archived_files(present, uf, ano, mes, spec))
    suffixes = F.transform("_chosen", lambda c: c["suffix"])
    split = F.coalesce(F.try_element_at(suffixes, F.lit(1)) != "", F.lit(False))

    recorded = F.col("record_text").isNotNull()
    files = F.col("_record.files")
    rule_problem = F.when(
        ~F.coalesce(record_follows_rule(files, uf, ano, mes, spec), F.lit(False)),
        F.lit("record-against-rule"),
    )
    record_problem = F.coalesce(F.col("_record.problem"), rule_problem)
    cache_problem = (
        F.when(F.lit(not allow_cache_fallback), F.lit("no-record"))
        .when(F.size("_chosen") == 0, F.lit("nothing-in-cache"))
        .when(split & missing_variant(suffixes).isNotNull(), F.lit("variant-gap"))
        .when(split & (F.size(suffixes) == 1), F.lit("lone-variant"))
    )
    df = df.withColumn(
        "_problem", F.when(recorded, record_problem).otherwise(cache_problem)
    ).withColumn(
        "_checked",
        F.when(recorded, _sources_from_record(files, F.col("cached"))).otherwise(
            _sources_from_cache(F.col("_chosen"), spec)
        ),
    )
    first = _first_problem(F.col("_checked"))
    problem = F.coalesce(F.col("_problem"), first["problem"])
    return df.select(
        *partitions.columns,
        (~recorded).alias("from_cache"),
        problem.alias("problem"),
        F.when(F.col("_problem").isNull(), first["file"]).alias("problem_file"),
        F.when(problem.isNull(), F.transform("_checked", lambda c: c["source"])).alias("sources"),
    )


def emission_outcomes(chosen: DataFrame, allow_cache_fallback: bool = False) -> DataFrame:
    """What emitting provenance does to each partition.

    Takes :func:`choose_sources` output with ``kept_text`` (local document or NULL) and
    ``parquet_sha``. A local document without record is kept only if it describes the
    current data; ``drop_document`` marks the ones that must not be published.
    """
    keep = F.col("kept_text").isNotNull() & F.col("record_text").isNull() & F.lit(not allow_cache_fallback)
    df = chosen.withColumn("_kept", rules.assess_kept(F.col("kept_text"), F.col("parquet_sha")))
    kind = (
        F.when(keep & F.col("_kept.problem").isNull(), F.lit(BEFORE_RECORD))
        .when(keep | F.col("problem").isNotNull(), F.lit(FAILED))
        .otherwise(F.lit(WRITTEN))
    )
    reason = F.when(keep, F.col("_kept.problem")).otherwise(F.col("problem"))
    return (
        df.withColumn("kind", kind)
        .withColumn("problem", reason)
        .withColumn("legacy", F.when(F.col("kind") == BEFORE_RECORD, F.col("_kept.legacy")))
        .withColumn("drop_document", (F.col("kind") == FAILED) & F.col("kept_text").isNotNull())
        .drop("_kept")
    )


# SQL names under which documents list column types.
_TYPE_NAMES = {
    T.StringType: "VARCHAR", T.LongType: "BIGINT", T.IntegerType: "INTEGER", T.ShortType: "SMALLINT",
    T.ByteType: "TINYINT", T.DoubleType: "DOUBLE", T.FloatType: "FLOAT", T.BooleanType: "BOOLEAN",
    T.DateType: "DATE", T.TimestampType: "TIMESTAMP WITH TIME ZONE", T.TimestampNTZType: "TIMESTAMP",
    T.BinaryType: "BLOB",
}


def type_name(dtype: T.DataType) -> str:
    if isinstance(dtype, T.DecimalType):
        return f"DECIMAL({dtype.precision},{dtype.scale})"
    return _TYPE_NAMES.get(type(dtype), dtype.simpleString().upper())


def describe_output(data: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows, column count and ordered column names and types per partition of one vintage."""
    by = KEY if by is None else by
    fields = F.array(
        *[
            F.struct(F.lit(f.name).alias("name"), F.lit(type_name(f.dataType)).alias("type"))
            for f in data.schema.fields
        ]
    )
    return (
        data.groupBy(*by)
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("columns", F.lit(len(data.columns)))
        .withColumn("schema", fields)
    )


def single_or_split(sources: Column) -> Column:
    """The only source, or NULL for a partition made from several."""
    return F.when(F.size(sources) == 1, F.try_element_at(sources, F.lit(1)))


def provenance_body(
    df: DataFrame,
    dataset: str,
    generated_at: Column,
    pipeline: dict[str, str],
) -> DataFrame:
    """Adds ``body``: the provenance document of each row as a struct.

    ``df`` has ``KEY, rows, fingerprint, schema, sha256, sources``.
    """
    body = F.struct(
        F.lit(dataset).alias("dataset"),
        generated_at.alias("generatedAt"),
        F.struct(
            F.size("schema").alias("columns"),
            F.concat(
                names.partition_path(F.col("ano"), F.col("uf"), F.col("mes")), F.lit("/part.parquet")
            ).alias("file"),
            "fingerprint",
            "rows",
            "schema",
            "sha256",
        ).alias("output"),
        F.struct("ano", "mes", "uf").alias("partition"),
        F.struct(
            *[F.lit(pipeline[k]).alias(k) for k in ("archiveScript", "datasusSdk", "decoder")],
            F.lit(CONVERSION_NOTES).alias("notes"),
        ).alias("pipeline"),
        single_or_split(F.col("sources")).alias("source"),
        F.when(F.size("sources") > 1, F.col("sources")).alias("sources"),
    )
    return df.withColumn("body", body)


def _body_type(split: bool, reconstructed: bool) -> T.StructType:
    t = (
        T.StructType()
        .add("dataset", T.StringType())
        .add("generatedAt", T.StringType())
        .add("output", OUTPUT)
        .add("partition", PARTITION)
        .add("pipeline", PIPELINE)
        .add("source", SOURCE_FILE)
    )
    if split:
        t = t.add("sources", T.ArrayType(SOURCE_FILE))
    return t.add("reconstructed", RECONSTRUCTED) if reconstructed else t


def provenance_text(body: Column, reconstructed: bool = False) -> Column:
    """The document as text: ``source`` alone, or ``source: null`` with ``sources``."""
    text = F.when(
        body["sources"].isNull(), pretty_json(body, _body_type(False, reconstructed))
    ).otherwise(pretty_json(body, _body_type(True, reconstructed)))
    return F.concat(text, F.lit("\n"))


def validate_provenance(documents: DataFrame, files: DataFrame, outputs: DataFrame) -> DataFrame:
    """Recheck published documents against the files they describe.

    ``documents``: ``KEY, sha256, sources``; ``files``: ``name, size, sha256`` as listed and
    rehashed; ``outputs``: ``KEY, sha256`` of the data. One row per problem.
    """
    claimed = documents.select(*KEY, F.explode("sources").alias("s")).select(
        *KEY,
        F.col("s.file").alias("name"),
        F.col("s.bytes").alias("_bytes"),
        F.col("s.sha256").alias("_sha"),
    )
    against = claimed.join(files.select("name", "size", "sha256"), "name", "left")
    source_problem = (
        F.when(F.col("size").isNull(), F.lit("source-not-listed"))
        .when(F.col("size") != F.col("_bytes"), F.lit("source-size"))
        .when(F.col("sha256") != F.col("_sha"), F.lit("source-hash"))
    )
    sources = against.select(*KEY, "name", source_problem.alias("problem"))
    data = documents.select(*KEY, F.col("sha256").alias("_said")).join(
        outputs.select(*KEY, "sha256"), KEY, "left"
    )
    output_problem = F.when(~F.col("_said").eqNullSafe(F.col("sha256")), F.lit("output-hash"))
    output = data.select(*KEY, F.lit("part.parquet").alias("name"), output_problem.alias("problem"))
    return sources.unionByName(output).filter(F.col("problem").isNotNull())


def listed_but_undocumented(
    documents: DataFrame, listing: DataFrame, spec: DatasetSpec = SIA_PA
) -> DataFrame:
    """Listed variants of documented partitions that their document does not mention."""
    named = documents.select(F.explode("sources").alias("s")).select(F.col("s.file").alias("name"))
    p = names.parse_source_name(F.col("name"), spec)
    listed = (
        listing.select("name", p.alias("_p"))
        .filter(F.col("_p").isNotNull())
        .select("_p.uf", "_p.ano", "_p.mes", "name")
    )
    return listed.join(documents.select(*KEY), KEY, "left_semi").join(named, "name", "left_anti")


