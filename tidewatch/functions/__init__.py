"""Column-expression helpers (all JVM-side, codegen-friendly)."""

from tidewatch.functions.exprs import (coerce_double, coerce_long, fixed4, nan_to_null,
                                       safe_div, sigmoid)
from tidewatch.functions.keys import (entity_key, fingerprint_key, na_token, stable_hash_bucket)

__all__ = ["coerce_double", "coerce_long", "fixed4", "nan_to_null", "safe_div", "sigmoid",
           "entity_key", "fingerprint_key", "na_token", "stable_hash_bucket"]
