"""Column-level building blocks (all JVM-side, codegen friendly)."""

from sparkwright.functions.numeric import (  # noqa: F401
    coerce_numeric, nan_to_null, is_missing, numeric_columns, bias_corrected_skew,
    safe_ratio, NUMERIC_TEXT_PATTERN,
)
from sparkwright.functions.hashing import hash_bucket, hash_order, hash_unit, poisson1  # noqa: F401
from sparkwright.functions.encoding import ordinal_code  # noqa: F401
from sparkwright.functions.text import (  # noqa: F401
    has_pii, EMAIL_PATTERN, PHONE_PATTERN, json_strip,
)
