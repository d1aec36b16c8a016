"""Column-level helpers (scalar functions); all are Spark SQL built-ins."""

from quarry.functions.buckets import (AGE_BOUNDS, AGE_LABELS_DASH, AGE_LABELS_OVERLAP,
                                      bucket_ordinal, bucketize)
from quarry.functions.casts import lenient_float, lenient_int
from quarry.functions.numeric import amount_units, ratio_half_up, units_sum, units_to_double
from quarry.functions.tags import split_tags
from quarry.functions.text import is_real_token, java_trim, normalize_text, tokenize
from quarry.functions.times import as_timestamp, year_of_epoch, year_range

__all__ = [
    "AGE_BOUNDS", "AGE_LABELS_DASH", "AGE_LABELS_OVERLAP", "bucket_ordinal", "bucketize",
    "lenient_float", "lenient_int", "amount_units", "units_sum", "units_to_double",
    "ratio_half_up", "split_tags", "is_real_token", "java_trim", "normalize_text", "tokenize",
    "as_timestamp", "year_of_epoch", "year_range",
]
