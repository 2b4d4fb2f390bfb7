"""Raw JSON to the curated document table."""

from __future__ import annotations

import json
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import mapping as paths
from docloom.functions.content import texts_of

_FIELDS = ("id", "title", "metadata", "content", "content_full", "content_raw", "html_content", "content_type", "error", "record")
_TEXTS = ("content_full", "content_raw", "html_content")
#: Metadata without a value.
DEFAULTS = {"language": "English", "classification": "PROTECTED", "type": "KNOWLEDGE"}
EXPIRY = "2260-12-31T23:59:59.999999Z"
#: JSON of content with a classification that is not empty and not PUBLIC; a key's opening quote follows a brace or a comma, a text's never ends before a colon.
_NOT_PUBLIC = r'[{,]"classification":(?!("PUBLIC"|null|""|\[\]|\{\}|false|0)[,}])'


def _parsed_texts(delimiter: str | None) -> Any:
    @F.pandas_udf(", ".join(f"{t} string" for t in _TEXTS))
    def texts(contents: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([dict.fromkeys(_TEXTS) if c is None else texts_of(json.loads(c), delimiter) for c in contents], columns=list(_TEXTS))

    return texts(F.col("content"))


def _plain_texts(blocks: Column, delimiter: str | None) -> Column:
    text = lambda v: F.coalesce(F.try_variant_get(v, "$", "string"), F.lit(""))
    held = lambda b: F.when(b["rows"].isNotNull(), F.concat(F.coalesce(text(b["columns"]), F.lit("")), F.lit("\n"), text(b["rows"]))).otherwise(F.coalesce(F.array_join(F.transform(b["data"], text), "\n"), F.lit("")))
    title = lambda b: F.when(text(b["title"]) != "", F.concat(F.lit(f"\n{delimiter or ''}# "), text(b["title"]), F.lit("\n"))).otherwise("")
    raw = F.array_join(F.transform(blocks, held), "\n")
    full = F.array_join(F.transform(blocks, lambda b: F.concat(title(b), held(b))), "\n")
    return F.struct(full.alias("content_full"), raw.alias("content_raw"), raw.alias("html_content"))


def map_records(records: DataFrame, json_col: str, mapping: dict[str, Any] | None = None, root: str | None = None, delimiter: str | None = None, markup: bool = True) -> DataFrame:
    """One row a document: fields, metadata and content as JSON, and ``error`` with the record where it cannot be read.

    Records are parsed once, as VARIANT, and the mapping is an expression over them. Only the texts of content leave the JVM,
    because HTML needs a parser and blocks within blocks have no Spark type, and only where a query takes them; with
    ``markup=False`` HTML and what a block's data hold beside texts stay as they stand, and nothing leaves it.

    A record that is null, no JSON, beyond the size of a VARIANT or has a key twice is an error with its text; so is one without
    a value at ``root``. Each document without a name, or with metadata that are no object, is an error with its own JSON; the
    documents beside it stay. An empty list, like an empty table, has no documents. Only ``json_col`` is read, so other columns
    may have any name. A document is MIXED if its metadata say public and any classification inside its content does not.
    """
    if mapping:
        paths.checked(mapping)
    elif not markup:
        raise ValueError("content that is not mapped has blocks within blocks")
    fields = mapping or {"id": "$.id", "name": "$.name"}
    text = lambda v: F.try_variant_get(v, "$", "string")

    def document(found: Column) -> Column:
        name = F.nullif(text(paths.first(found, fields["name"])), F.lit(""))
        wrong = F.when(name.isNull(), "ValueError: a document needs a name")
        if not mapping:
            wrong = wrong.when(paths.own_metadata(found, DEFAULTS).isNull(), "TypeError: metadata must be an object")
        return F.struct(found.alias("doc"), name.alias("title"), wrong.alias("error"), F.when(wrong.isNotNull(), F.to_json(found)).alias("record"))

    unread = lambda why: F.array(F.struct(F.lit(None).cast("variant").alias("doc"), F.lit(None).cast("string").alias("title"), F.lit(why).alias("error"), F.col("record")))
    parsed = records.select(F.col(json_col).alias("record"), F.try_parse_json(json_col).alias("value"))
    found = F.when(F.col("value").isNull(), unread("ValueError: not a JSON record")).otherwise(F.coalesce(F.transform(paths.roots(F.col("value"), root), document), unread(f"ValueError: no value at {root}")))
    rows = parsed.select(F.explode(found).alias("found")).select("found.*")
    good = lambda value: F.when(F.col("error").isNull(), value)
    doc = F.col("doc")
    if mapping:
        metadata, blocks = paths.metadata(doc, mapping, DEFAULTS), paths.content(doc, mapping)
        content = F.to_json("blocks")
    else:
        metadata, blocks = paths.own_metadata(doc, DEFAULTS), F.lit(None).cast("string")
        content = F.coalesce(F.to_json(paths.first(doc, "$.content")), F.lit("[]"))
    rows = rows.select("title", "error", "record", good(text(paths.first(doc, fields["id"]))).alias("id"), good(metadata).alias("values"), good(blocks).alias("blocks"), *([] if mapping else ["doc"]))
    rows = rows.select("id", "title", F.to_json("values").alias("metadata"), good(content).alias("content"), "values", "blocks", "error", "record")
    groups = F.coalesce(F.to_json(F.col("values")["access_groups"]), F.lit("[]"))
    private = (F.coalesce(F.nullif(text(F.col("values")["classification"]), F.lit("")), F.lit("PROTECTED")) != "PUBLIC") | ~groups.isin("null", "[]", '""', "{}", "false", "0")
    kind = F.when(private, "PRIVATE").when(F.col("content").rlike(_NOT_PUBLIC), "MIXED").otherwise("PUBLIC")
    texts = _parsed_texts(delimiter) if markup else good(_plain_texts(F.col("blocks"), delimiter))
    rows = rows.select("*", texts.alias("texts"), good(kind).alias("content_type"))
    return rows.select(*(F.col("texts")[f].alias(f) if f in _TEXTS else F.when(F.col("error").isNull(), F.col(f)).alias(f) if f == "title" else F.col(f) for f in _FIELDS))


def curate(documents: DataFrame, metadata_keys: list[str], content_column: str = "content_full") -> DataFrame:
    """The curated table: one column for each metadata key, hashes, and where there is no id one made of the content, the same in every run."""
    if content_column not in ("content_full", "content_raw", "html_content"):
        raise ValueError(f"not a content column: {content_column}")
    rows = documents.where("error IS NULL").withColumn("id", F.coalesce("id", F.md5(F.to_json(F.struct("title", "metadata", "content")))))
    meta = lambda k: F.get_json_object("metadata", f"$['{k}']")
    typed = {"created": "timestamp", "modified": "timestamp", "expiry": "timestamp"}
    listed = ("tags", "access_groups", "region")
    out = [F.coalesce(F.try_to_timestamp(meta(k)), F.to_timestamp(F.lit(EXPIRY)) if k == "expiry" else F.lit(None).cast("timestamp")).alias(f"metadata_{k}") if k in typed else F.coalesce(F.from_json(meta(k), "array<string>"), F.array().cast("array<string>")).alias(f"metadata_{k}") if k in listed else meta(k).alias(f"metadata_{k}") for k in dict.fromkeys([*metadata_keys, "expiry"])]
    return rows.select("id", "title", F.col(content_column).alias("content"), F.length(content_column).cast("bigint").alias("length"), "content_type", F.md5(F.to_json(F.struct("id", "title", "metadata", "content_full"))).alias("md5"), F.md5("metadata").alias("metadata_md5"), F.md5("content_raw").alias("content_md5"), *out)


def metadata_keys(documents: DataFrame) -> list[str]:
    """The union of the batch's metadata keys: distinct names only reach the driver."""
    return sorted(r[0] for r in documents.where("error IS NULL").select(F.explode(F.json_object_keys("metadata"))).distinct().collect())
