from finspark.functions.dates import day_of, month_boundaries_between, month_series, month_start
from finspark.functions.masking import hash_normalized, hash_raw, standardize_email
from finspark.functions.numeric import safe_ratio

__all__ = ["day_of", "month_boundaries_between", "month_series", "month_start", "hash_normalized",
           "hash_raw", "standardize_email", "safe_ratio"]
