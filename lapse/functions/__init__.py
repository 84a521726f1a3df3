"""Column-expression library (JVM-side, whole-stage-codegen friendly)."""

from .casting import safe_bigint, safe_double
from .stats import chi2_sf_df1, erf, erfc, norm_cdf
from .text import email_domain, first_token, normalize_name, strip_subaddress
from .timeparse import (TIMESTAMP_FORMATS, instant_to_utc_ntz, iso_week_key, month_floor_minus,
                        ntz_literal, parse_mixed_timestamp)

__all__ = [
    "safe_bigint", "safe_double", "chi2_sf_df1", "erf", "erfc", "norm_cdf",
    "email_domain", "first_token", "normalize_name", "strip_subaddress",
    "TIMESTAMP_FORMATS", "instant_to_utc_ntz", "iso_week_key", "month_floor_minus",
    "ntz_literal", "parse_mixed_timestamp",
]
