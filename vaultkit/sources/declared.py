"""Declared source tables: one schema per source, read without inference, checked before a load.

A source file may have its columns in any order and case and may have more of them; only declared ones
are read, in declared order and type. A declared column that a source lacks is an error that names it
(``MissingColumns``), unless it is declared optional: then it is NULL.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultkit.plans import constants as K
from vaultkit.plans.legacy import LEGACY_NULL_COLUMNS
from vaultkit.spec import IDENTIFIER, PRODUCT, RELATIONSHIP, EntitySpec


class MissingColumns(ValueError):
    """Declared columns that sources lack."""


# The sources' columns, text unless a type is stated.
_VERSIONED = "curr_flg int, last_updt_dt timestamp_ntz"
_CRM_PRODUCT = ("country_code_bi__c, id, name, description_vod__c, external_id_vod__c, product_type_vod__c, active_bi__c, "
                "therapeutic_area_vod__c, mdm_product_type_bi__c, isdeleted boolean, parent_product_vod__c, lastmodifieddate timestamp_ntz")
_COLUMNS = {
    **{f"crm_product_{r}": _CRM_PRODUCT for r in K.CRM_REGIONS},
    "crm_reference": "hashdiff",
    "dim_country": "iso2_code",
    "market_marcas": f"country, codigo, nome, siglalab, {_VERSIONED}",
    "market_producto": f"country, codigo, nome, marca, flg_classific, flg_etico, codigolab, codigoclasse, {_VERSIONED}",
    "market_corporacao": f"country, codigo, nome, sigla, {_VERSIONED}",
    "market_laboratorio": f"country, codigo, cdg, cdgcorporacao, {_VERSIONED}",
    "market_molecula_producto": f"country, cdgprod, cdgmol, {_VERSIONED}",
    "market_molecula": f"country, codigomole, nome, {_VERSIONED}",
    "catalogue_claves": "clave, nombre, forma_farma, concentracion, presentacion",
}
OPTIONAL = {"catalogue_claves": ("presentacion",)}


_TYPES = {"int": T.IntegerType(), "boolean": T.BooleanType(), "timestamp_ntz": T.TimestampNTZType()}


def _struct(columns: str) -> T.StructType:
    parts = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(c[0], _TYPES[c[1]] if len(c) > 1 else T.StringType()) for c in parts])


def _history(spec: EntitySpec, typed_dates: bool, without: Iterable[str] = ()) -> T.StructType:
    return T.StructType([T.StructField(c, T.DateType() if typed_dates and c in spec.date_cols else T.StringType())
                         for c in spec.columns if c not in set(without)])


def sources() -> dict[str, T.StructType]:
    """Schema of every declared source: thirteen source tables and six history tables."""
    out = {name: _struct(columns) for name, columns in _COLUMNS.items()}
    for variant in ("legacy", "market", "catalogue"):
        out[f"{variant}_product_history"] = _history(PRODUCT, variant == "catalogue", LEGACY_NULL_COLUMNS)
    out["legacy_identifier_history"] = _history(IDENTIFIER, False)
    for variant in ("market", "catalogue"):
        out[f"{variant}_relationship_history"] = _history(RELATIONSHIP, variant == "catalogue")
    return out


def missing(have: Iterable[str], name: str) -> list[str]:
    """Declared columns of a source that are not optional and not among ``have``."""
    have = {c.lower() for c in have}
    return [c for c in sources()[name].names if c not in have and c not in OPTIONAL.get(name, ())]


def require(found: Mapping[str, Iterable[str]]) -> None:
    """Raise ``MissingColumns`` with everything that the sources (name -> columns) lack."""
    lacking = {name: m for name, columns in found.items() if (m := missing(columns, name))}
    if lacking:
        raise MissingColumns("; ".join(f"{name} lacks {', '.join(m)}" for name, m in sorted(lacking.items())))


def shaped(df: DataFrame, name: str) -> DataFrame:
    """``df`` in the declared shape of a source."""
    require({name: df.columns})
    have = {c.lower(): c for c in df.columns}
    return df.select(*[(F.col(have[f.name]) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in sources()[name].fields])


def _path(base: str, name: str) -> str:
    return os.path.join(base, f"{name}.parquet")


def check_sources(spark: SparkSession, base: str, names: Iterable[str]) -> None:
    """Before a load: compare the footers of the named sources with their declarations."""
    require({name: spark.read.option("mergeSchema", "true").parquet(_path(base, name)).columns for name in names})


def read_source(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A source by its declared schema: no footer is read to plan, and only declared columns reach the scan."""
    return spark.read.schema(sources()[name]).parquet(_path(base, name))


class DeclaredSources(Mapping):
    """name -> DataFrame in declared shape, from a folder of Parquet tables or from frames given by name."""

    def __init__(self, spark: SparkSession | None = None, base: str | None = None, frames: Mapping[str, DataFrame] | None = None):
        self.frames = dict(frames or {})
        self.spark, self.base = spark, base
        require({name: df.columns for name, df in self.frames.items()})

    def __getitem__(self, name: str) -> DataFrame:
        if name in self.frames:
            return shaped(self.frames[name], name)
        if self.base is None or name not in sources():
            raise KeyError(name)
        return read_source(self.spark, self.base, name)

    def __iter__(self):
        return iter(sources() if self.base is not None else self.frames)

    def __len__(self) -> int:
        return len(sources() if self.base is not None else self.frames)
