"""Document images of MongoDB change events: JSON text with extended types, and patches of documents.

The connector sends a document as JSON text in ``after`` and, for an update,
a patch of its fields. Text is decoded in a second stage; patches are folded
field by field, as the newest value of each, so no key's events meet in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .decode import inferred_ddl_to_struct
from .transform import DELETED, quoted

# Extended JSON wrappers and what is left of them. Inside a JSON string quotes are escaped, so none matches there.
EXTENDED = (
    (r'\{\s*"\$(?:numberInt|numberLong|numberDouble)"\s*:\s*"(-?[0-9][^"]*)"\s*\}', "$1"),
    (r'\{\s*"\$numberDouble"\s*:\s*"[^"]*"\s*\}', "null"),  # infinities and NaN are no JSON numbers
    (r'\{\s*"\$numberDecimal"\s*:\s*("[^"]*")\s*\}', "$1"),  # its digits, as text
    (r'\{\s*"\$(?:oid|uuid|symbol)"\s*:\s*("[^"]*")\s*\}', "$1"),
    (r'\{\s*"\$date"\s*:\s*("[^"]*"|-?[0-9]+)\s*\}', "$1"),
    (r'\{\s*"\$binary"\s*:\s*("[^"]*")\s*(?:,\s*"\$type"\s*:\s*"[^"]*"\s*)?\}', "$1"),
    (r'\{\s*"\$binary"\s*:\s*\{\s*"base64"\s*:\s*("[^"]*")\s*(?:,\s*"subType"\s*:\s*"[^"]*"\s*)?\}\s*\}', "$1"),
)
SET, UNSET = "$set", "$unset"


def plain_json(text: Column) -> Column:
    """Extended JSON text with its typed wrappers replaced by plain values; other text stays as it is."""
    out = text
    for pattern, plain in EXTENDED:
        out = F.regexp_replace(out, pattern, plain)
    return F.when(text.contains('"$'), out).otherwise(text)


def document_struct(texts: DataFrame, column: str) -> T.StructType:
    """The merged type of a column of JSON documents, by one aggregation; only its text reaches the driver."""
    row = texts.select(F.schema_of_variant_agg(F.try_parse_json(F.col(column))).alias("s")).first()
    ddl = row["s"] if row is not None else None
    return inferred_ddl_to_struct(texts.sparkSession, ddl) if ddl and ddl.startswith("OBJECT<") else T.StructType([])


def decode_documents(df: DataFrame, struct: T.StructType | None = None, *, columns: Sequence[str] = ("after", "before")) -> DataFrame:
    """Envelope rows whose images are JSON text, with typed images: :func:`cdclake.operators.transform.unwrap` then flattens them.

    Without ``struct`` the type is inferred from all images. An image that is missing or is no JSON object is null.
    """
    names = [c for c in columns if c in df.columns and isinstance(df.schema[c].dataType, T.StringType)]
    plain = df.select(*[plain_json(quoted(c)).alias(c) if c in names else quoted(c) for c in df.columns])
    if struct is None:
        images = plain.select(F.explode(F.array(*[quoted(c) for c in names])).alias("image")) if names else None
        struct = document_struct(images, "image") if images is not None else T.StructType([])
    out = plain.select(*[F.from_json(quoted(c), struct).alias(c) if c in names else quoted(c) for c in plain.columns])
    for c in columns:
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast(struct))
    return out


def _fields(document: Column) -> Column:
    """A JSON object's fields as a map of JSON texts; null for anything else."""
    return F.transform_values(F.from_json(document, "map<string,variant>"), lambda _, v: F.coalesce(F.to_json(v), F.lit("null")))


def _document(fields: Column) -> Column:
    """JSON text of a map of JSON texts."""
    member = lambda x: F.concat(F.lit('"'), F.regexp_replace(x["key"], r'(["\\])', r"\\$1"), F.lit('":'), x["value"])
    return F.concat(F.lit("{"), F.array_join(F.transform(F.map_entries(fields), member), ","), F.lit("}"))


def latest_documents(changes: DataFrame, key: str, order: Sequence[str], *, op: str = "op", after: str = "after", patch: str = "patch",
                     struct: T.StructType | None = None, keep_deleted: bool = False) -> DataFrame:
    """The newest image of every document: ``key``, its fields and ``__deleted``, one row per key.

    Inserts, snapshot reads, updates with a whole image in ``after`` and patches that are
    whole documents (no ``$set`` or ``$unset``) set the image; deletes remove it; later patches set or remove top-level
    fields. ``order`` names columns that order the changes of a key; nulls in it come first. Patches of a document that no event
    has shown set fields of an empty one. Deleted documents are left out, or
    kept with null fields. A field named like ``key`` is the key. Rows without a key are left out.

    The newest whole image of a key and the newest value of each patched field are
    map-side combined maxima; only a document's fields are ever gathered.
    """
    at = F.struct(*[quoted(c) for c in order])
    text = lambda c: plain_json(quoted(c)) if c in changes.columns else F.lit(None).cast("string")
    rows = changes.where(quoted(key).isNotNull()).select(quoted(key).alias("k"), at.alias("at"), quoted(op).alias("op"), text(after).alias("full"), text(patch).alias("patch"))
    parts = F.from_json("patch", "map<string,string>")
    partial = F.map_contains_key(parts, SET) | F.map_contains_key(parts, UNSET)
    rows = rows.withColumn("partial", F.coalesce((F.col("op") == "u") & F.col("full").isNull() & partial, F.lit(False)))
    whole = rows.where("not partial and (op = 'd' or full is not null or patch is not null)")
    whole = whole.groupBy("k").agg(F.max("at").alias("base_at"), F.max_by(F.struct("op", F.coalesce("full", "patch").alias("text")), "at").alias("base"))

    patches = rows.where("partial").join(whole.select("k", "base_at"), "k", "left").where("base_at is null or at > base_at")
    set_ = F.coalesce(_fields(parts[SET]), F.expr("map()").cast("map<string,string>"))
    unset = F.coalesce(F.transform_values(F.from_json(parts[UNSET], "map<string,string>"), lambda _, v: F.lit(None).cast("string")), F.expr("map()").cast("map<string,string>"))
    named = patches.select("k", "at", F.explode(F.array_union(F.map_entries(set_), F.map_entries(unset))).alias("f"))
    newest = named.groupBy("k", F.col("f.key").alias("name")).agg(F.max_by(F.struct(F.col("f.value").alias("value")), "at").alias("v"))
    patched = newest.groupBy("k").agg(F.map_from_entries(F.collect_list(F.struct("name", F.col("v.value").alias("value")))).alias("patched"))

    images = whole.join(patched, "k", "full")
    deleted = F.coalesce((F.col("base.op") == "d") & F.col("patched").isNull(), F.lit(False))
    base = F.when(F.col("base.op") == "d", F.lit(None).cast("string")).otherwise(F.col("base.text"))
    empty = F.expr("map()").cast("map<string,string>")
    old = F.map_filter(F.coalesce(_fields(base), empty), lambda k, _: ~F.coalesce(F.map_contains_key("patched", k), F.lit(False)))
    new = F.map_filter(F.coalesce("patched", empty), lambda _, v: v.isNotNull())
    images = images.select(F.col("k"), deleted.alias("gone"), F.when(~deleted, _document(F.map_concat(old, new))).alias("text"))
    if not keep_deleted:
        images = images.where("not gone")
    if struct is None:
        struct = document_struct(images, "text")
    out = images.select("k", "gone", F.from_json("text", struct).alias("image"))
    return out.select(F.col("k").alias(key), *[F.col("image").getField(f.name).alias(f.name) for f in struct.fields if f.name != key], F.col("gone").alias(DELETED))


__all__ = ["decode_documents", "document_struct", "latest_documents", "plain_json"]
