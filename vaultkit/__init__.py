"""vaultkit — Data Vault 2.0 batch loading as Spark DataFrame operators.

Layout:
  functions/  column expressions (hashing, text cleansing, predicates, audit names)
  sources/    table readers, entity schemas, test-bed derivations from the driver tables
  operators/  DataFrame -> DataFrame operators (conform, labels, dedupe, quality, merge, delta, audit)
  plans/      domain staging pipelines and the end-to-end delta load
  streaming/  micro-batch wrapper that runs the delta load per trigger
"""

from vaultkit.spec import (
    EntitySpec,
    LoadContext,
    PRODUCT,
    IDENTIFIER,
    RELATIONSHIP,
)

__all__ = ["EntitySpec", "LoadContext", "PRODUCT", "IDENTIFIER", "RELATIONSHIP"]
