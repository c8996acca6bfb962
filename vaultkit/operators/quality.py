"""Data quality: country presence, reject detection, reject keys, reject exclusion."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultkit.functions.hashing import hash_of
from vaultkit.functions.predicates import blank
from vaultkit.functions.text import upper_trim
from vaultkit.operators.dedupe import union_all
from vaultkit.spec import LoadContext, REJECT_COLUMNS

# Reject rules, first failing rule wins.
EMPTY_PRODUCT_NAME = "EMPTY_PRODUCT_NAME"
EMPTY_DATASET_PRODUCT_ID = "EMPTY_DATASET_PRODUCT_ID"
EMPTY_COUNTRY_CODE = "EMPTY_COUNTRY_CODE"
GEOGRAPHIC_ID_NOT_PRESENT = "GEOGRAPHIC_ID_NOT_PRESENT"
ERROR_LEVEL = "CRITICAL"

# Fields copied into the JSON image of a rejected row (written with keys in sorted order).
REJECTED_RECORD_FIELDS = (
    "geographic_id", "dataset_id", "source_dataset_id", "dataset_product_id", "product_name",
    "product_type_code", "hashkey", "hashdiff", "source_lastmodifieddate", "etl_batch_id",
    "record_source",
)

# Countries are a code list (a few hundred rows at most); above this bound the join shuffles.


def country_codes(countries: DataFrame, code_col: str = "iso2_code") -> DataFrame:
    """Distinct ``upper(trim(code))`` of the country reference, as column ``iso2_code``."""
    return countries.select(upper_trim(code_col).alias("iso2_code")).where(F.col("iso2_code").isNotNull()).distinct()


def keep_known_countries(df: DataFrame, countries: DataFrame, col: str = "geographic_id") -> DataFrame:
    """Semi join: rows whose ``upper(trim(col))`` is a known country code."""
    codes = country_codes(countries)
    return df.join(codes, upper_trim(col) == codes["iso2_code"], "left_semi")


def error_code(rules: Sequence[tuple[Column, str]]) -> Column:
    """Chained CASE: the code of the first rule whose predicate is true, else NULL."""
    out = None
    for pred, code in rules:
        out = F.when(pred, F.lit(code)) if out is None else out.when(pred, F.lit(code))
    return out


def product_reject_rules(known_country: Column) -> list[tuple[Column, str]]:
    return [
        (blank("product_name"), EMPTY_PRODUCT_NAME),
        (blank("dataset_product_id"), EMPTY_DATASET_PRODUCT_ID),
        (blank("geographic_id"), EMPTY_COUNTRY_CODE),
        (~known_country, GEOGRAPHIC_ID_NOT_PRESENT),
    ]


def rejected_record(fields: Sequence[str] = REJECTED_RECORD_FIELDS) -> Column:
    """JSON image of the row: keys sorted, NULLs kept, timestamps as text."""
    parts = []
    for name in sorted(fields):
        c = F.col(name)
        if name == "source_lastmodifieddate":
            c = c.cast("string")
        parts.append(c.alias(name))
    return F.to_json(F.struct(*parts), {"ignoreNullFields": "false"})


def find_rejects(staging: Mapping[str, DataFrame], countries: DataFrame, ctx: LoadContext,
                 as_variant: bool = False) -> DataFrame:
    """Rows of the product staging frames that fail a rule, one row per distinct failure.

    ``staging`` maps the source model name (kept in REJECT_SOURCE_MODEL) to its staging frame.
    The row image is JSON text (sorted keys, NULLs kept); ``as_variant=True`` stores it as VARIANT,
    converted after the DISTINCT and the key hash (VARIANT values cannot be compared or grouped).
    """
    cols = list(REJECTED_RECORD_FIELDS)
    tagged = union_all(
        df.select(*cols).withColumn("reject_source_model", F.lit(name)) for name, df in staging.items()
    )
    codes = country_codes(countries)
    joined = tagged.join(codes.withColumn("__known", F.lit(True)), upper_trim("geographic_id") == codes["iso2_code"], "left")
    known = F.col("__known").isNotNull()
    code = error_code(product_reject_rules(known))
    base = joined.where(code.isNotNull()).select(
        upper_trim("dataset_product_id").alias("dataset_product_id"),
        upper_trim("geographic_id").alias("source_country_code"),
        upper_trim("dataset_id").alias("dataset_id"),
        upper_trim("source_dataset_id").alias("source_dataset_id"),
        F.lit(ERROR_LEVEL).alias("error_level"),
        code.alias("error_code"),
        code.alias("error_message"),
        ctx.ts().alias("load_datetime"),
        F.col("source_lastmodifieddate").cast("timestamp_ntz").alias("source_lastmodifieddate"),
        F.col("hashkey"),
        F.col("hashdiff"),
        F.col("etl_batch_id"),
        F.col("record_source"),
        F.col("reject_source_model"),
        rejected_record().alias("rejected_record"),
    ).distinct()
    key = hash_of([
        "source_country_code", "dataset_id", "source_dataset_id", "dataset_product_id", "error_code",
        "hashkey", "hashdiff", F.md5(F.col("rejected_record")),
    ])
    out = base.withColumn("reject_key", key).select(*REJECT_COLUMNS)
    if as_variant:
        out = out.withColumn("rejected_record", F.parse_json("rejected_record"))
    return out


def new_rejects(found: DataFrame, existing: DataFrame | None) -> DataFrame:
    """Rejects whose key is not stored yet."""
    if existing is None:
        return found
    return found.join(existing.select("reject_key"), "reject_key", "left_anti").select(*found.columns)


def reject_ids(rejects: DataFrame) -> DataFrame:
    """Distinct rejected product ids (the reject set grows every batch; dedupe before joining)."""
    return rejects.select(F.col("dataset_product_id").alias("__reject_id")).where(F.col("__reject_id").isNotNull()).distinct()


def exclude_rejects(df: DataFrame, rejects: DataFrame | None, id_cols: Sequence[str] = ("dataset_product_id",),
                    batch_id: str | None = None) -> DataFrame:
    """Anti join on ``upper(trim(id))`` for every id column (both ends of an edge for relationships).

    By default an id rejected in any batch stays excluded; ``batch_id`` limits the exclusion to the
    rejects of that batch.
    """
    if rejects is None:
        return df
    if batch_id is not None:
        rejects = rejects.where(F.col("etl_batch_id") == batch_id)
    ids = reject_ids(rejects)
    out = df
    for c in id_cols:
        out = out.join(ids, upper_trim(c) == ids["__reject_id"], "left_anti")
    return out
