"""Hashes, ids, maps and JSON sizes."""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

from vellumflow.functions.text import squash_ws

#: Keys that a message between stages may not carry, and its largest size in bytes.
FORBIDDEN_KEYS = (
    "markdown", "markdown_content", "full_text", "content_list", "mineru_json", "chunks", "embeddings", "dense_vectors", "sparse_vectors", "qdrant_points",
    "images", "binary_data", "raw_response", "pdf_bytes", "file_content",
)
MAX_MESSAGE_BYTES = 16 * 1024


def config_hash(config: dict) -> str:
    """First 16 hex digits of the SHA-256 of the sorted JSON of a configuration."""
    return hashlib.sha256(json.dumps(config, sort_keys=True, ensure_ascii=False).encode()).hexdigest()[:16]


def text_hash(c: Column) -> Column:
    """SHA-256 of the text with white space squashed."""
    return F.sha2(squash_ws(F.coalesce(c, F.lit(""))), 256)


def chunk_id(document_id: Column, bitstream: Column, checksum: Column, version: Column, config: Column, index: Column, text: Column) -> Column:
    """Id of a chunk from all that determines it; nulls count as empty."""
    return chunk_id_of_hash(document_id, bitstream, checksum, version, config, index, text_hash(text))


def chunk_id_of_hash(document_id: Column, bitstream: Column, checksum: Column, version: Column, config: Column, index: Column, hashed: Column) -> Column:
    """The same from the text's digest."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in (document_id, bitstream, checksum, version, config, index)]
    return F.sha2(F.concat_ws("|", *parts, hashed), 256)


def uuid5(namespace: uuid.UUID, name: Column) -> Column:
    """Name-based UUID, as SQL over SHA-1."""
    raw = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), F.encode(name, "utf-8")))
    variant = F.lower(F.hex((F.conv(F.substring(raw, 17, 2), 16, 10).cast("int").bitwiseAND(0x3F)).bitwiseOR(0x80)))
    return F.concat_ws("-", F.substring(raw, 1, 8), F.substring(raw, 9, 4), F.concat(F.lit("5"), F.substring(raw, 14, 3)), F.concat(variant, F.substring(raw, 19, 2)), F.substring(raw, 21, 12))


def document_version(checksum: Column, config: Column) -> Column:
    return F.concat(F.coalesce(checksum, F.lit("")), F.lit(":"), F.coalesce(config, F.lit("")))


def drop_nulls(m: Column) -> Column:
    return F.map_filter(m, lambda _, v: v.isNotNull())


def merge_maps(first: Column, later: Column) -> Column:
    """Both maps' entries; the later map's value wins."""
    keys = F.map_keys(later)
    kept = F.map_filter(first, lambda k, _: ~F.array_contains(keys, k))
    return F.when(first.isNull(), later).when(later.isNull(), first).otherwise(F.map_concat(kept, later))


def json_bytes(c: Column) -> Column:
    return F.octet_length(F.to_json(c))


def message_problem(message: Column, max_bytes: int = MAX_MESSAGE_BYTES) -> Column:
    """Why a message (map of strings) can't be sent: forbidden key, binary value, too large; null when it can."""
    binary = F.exists(F.map_values(message), lambda v: v.rlike(r"^(JVBERi0|iVBORw0KGgo|/9j/|data:[\w/+.-]+;base64,)") | v.rlike(r"\x00"))
    return (
        F.when(F.arrays_overlap(F.transform(F.map_keys(message), F.lower), F.array(*map(F.lit, FORBIDDEN_KEYS))), "forbidden_key")
        .when(binary, "binary_value")
        .when(json_bytes(message) > max_bytes, "too_large")
    )


def object_key_problem(key: Column) -> Column:
    """Why an object key is refused: empty, absolute, or leading out of its place; null when it is fine."""
    return F.when(F.coalesce(F.trim(key), F.lit("")) == "", "empty").when(key.rlike(r"^[/\\]|^[A-Za-z]:"), "absolute").when(key.rlike(r"(^|[/\\])\.\.([/\\]|$)"), "traversal").when(key.rlike(r"[\x00-\x1f]"), "control")


def sanitize_component(c: Column) -> Column:
    """A path component of letters, digits, dot, dash and underscore; anything else becomes an underscore."""
    t = F.regexp_replace(F.try_element_at(F.split(F.coalesce(c, F.lit("")), r"[/\\]"), F.lit(-1)), r"[^A-Za-z0-9._-]", "_")
    t = F.regexp_replace(t, r"^\.+", "")
    return F.when(t == "", "_").otherwise(t)


def artifact_uri(bucket: Column | str, key: Column) -> Column:
    bucket = F.lit(bucket) if isinstance(bucket, str) else bucket
    return F.concat(F.lit("s3://"), bucket, F.lit("/"), key)


def parse_uri(uri: Column) -> Column:
    return F.struct(F.regexp_extract(uri, "^s3://([^/]+)/(.+)$", 1).alias("bucket"), F.regexp_extract(uri, "^s3://([^/]+)/(.+)$", 2).alias("key"))


def store_metadata(m: Column) -> Column:
    """Metadata fit for an object store: keys of small letters, digits and dashes, ASCII values of 256 characters, nulls dropped."""
    ascii_only = lambda v: F.left(F.regexp_replace(v, r"[^\x20-\x7e]", ""), F.lit(256))
    return F.transform_keys(F.transform_values(drop_nulls(m), lambda _, v: ascii_only(v)), lambda k, _: F.regexp_replace(F.lower(k), "[^a-z0-9-]", "-"))
