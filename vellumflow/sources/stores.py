"""Sinks and store-like sources: JSON lines, CSV and report files, artifacts with checksums, manifests, migration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

METADATA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("title", "abstract", "document_type", "language", "year", "publisher", "geographic_scope", "methodology", "policy_area", "target_population", "funding")]
    + [T.StructField(c, T.ArrayType(T.StringType())) for c in ("authors", "keywords", "institutions", "data_sources", "programs", "recommendations")]
    + [T.StructField(f"{c}_confidence", T.DoubleType()) for c in ("title", "authors", "year", "abstract", "keywords", "document_type")]
    + [T.StructField("needs_review", T.BooleanType()), T.StructField("notes", T.StringType())]
)


def write_json_lines(df: DataFrame, path: str) -> None:
    """One JSON object a line and row; nulls are left out as JSON writers do."""
    df.write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)


def write_report(df: DataFrame, path: str) -> None:
    """Reports as one JSON object a row."""
    df.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)


def put_artifacts(df: DataFrame, path: str, content: str = "content") -> DataFrame:
    """Writes rows with their content and its SHA-256 and size, and returns what was written, read back."""
    df.withColumn("sha256", F.sha2(F.col(content), 256)).withColumn("size_bytes", F.octet_length(F.col(content)).cast("long")).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def damaged(df: DataFrame, content: str = "content", expected: str = "sha256") -> DataFrame:
    """Rows whose content doesn't have the expected checksum; a null on either side counts as damage."""
    return df.where(~F.sha2(F.col(content), 256).eqNullSafe(F.col(expected)) | F.col(content).isNull())


def as_text(content: Column, max_bytes: int | None = None) -> Column:
    """UTF-8 text of a binary value, invalid bytes replaced, cut to ``max_bytes`` bytes first."""
    cut = F.substring(content, 1, max_bytes) if max_bytes else content
    return F.decode(cut, "utf-8")


def list_prefix(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Objects below a folder: (path, modificationTime, length), contents not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path).select("path", "modificationTime", "length")


def read_manifests(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(manifests, unreadable): every manifest.json below a folder; those that can't be read apart, with their text."""
    full = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    rows = spark.read.schema(full).option("recursiveFileLookup", "true").option("pathGlobFilter", "manifest.json").option("multiLine", "true").option("columnNameOfCorruptRecord", "_corrupt").json(path).cache()
    return rows.where("_corrupt is null").drop("_corrupt"), rows.where("_corrupt is not null").select("_corrupt")


def parse_metadata(c: Column) -> Column:
    """Metadata JSON as a struct; unreadable JSON gives an empty one, confidences outside [0, 1] become null."""
    parsed = F.from_json(c, METADATA, {"mode": "PERMISSIVE"})
    for name in (f.name for f in METADATA.fields if f.name.endswith("_confidence")):
        parsed = parsed.withField(name, F.when(parsed[name].between(0, 1), parsed[name]))
    return parsed


def needs_review(metadata: Column) -> Column:
    """The stated flag, else whether the mean of the stated confidences is below .6, else true."""
    known = F.array_compact(F.array(*[metadata[f.name] for f in METADATA.fields if f.name.endswith("_confidence")]))
    mean = F.aggregate(known, F.lit(0.0), lambda s, x: s + x) / F.size(known)
    return F.coalesce(metadata["needs_review"], F.when(F.size(known) > 0, mean < 0.6), F.lit(True))


def pdf_bitstreams(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(files, items without any): the PDFs of repository items (item_uuid, handle, bundles) in bundles named ORIGINAL."""
    each = items.select("item_uuid", "handle", F.explode_outer("bundles").alias("b")).where("b.name = 'ORIGINAL' or b is null")
    files = each.select("item_uuid", "handle", F.explode_outer("b.bitstreams").alias("f"))
    is_pdf = F.lower(F.coalesce(F.col("f.mimeType"), F.lit(""))).contains("pdf") | F.lower(F.coalesce(F.col("f.name"), F.lit(""))).endswith(".pdf")
    found = files.where(is_pdf).select("item_uuid", F.col("f.uuid").alias("bitstream_uuid"), F.col("f.name").alias("filename"), F.col("handle").alias("item_handle"))
    return found, items.select("item_uuid").join(found.select("item_uuid").distinct(), "item_uuid", "left_anti")


def image_index(images: DataFrame, doc: str = "document_id") -> DataFrame:
    """For each document its images in order of name under new names image_0001.ext, their number and total size."""
    order = F.row_number().over(Window.partitionBy(doc).orderBy("name"))
    extension = F.lower(F.regexp_extract("name", r"(\.[A-Za-z0-9]+)$", 1))
    named = images.withColumn("n", order).withColumn("new_name", F.format_string("image_%04d%s", "n", extension))
    return named.groupBy(doc).agg(F.count(F.lit(1)).alias("count"), F.sum("size_bytes").alias("total_bytes"), F.array_sort(F.collect_list(F.struct("new_name", "name", "size_bytes"))).alias("images"))


def to_migrate(source: DataFrame, target: DataFrame, key: str = "object_key") -> DataFrame:
    """Source objects that the target doesn't have; run again after copying, it is empty."""
    return source.join(target.select(key).distinct(), key, "left_anti")
