"""Column-level helpers; all return ``pyspark.sql.Column`` (JVM-side, codegen'd)."""

from realty_spark.functions.parse import nan_to_null, parse_date, parse_locale_number  # noqa: F401
from realty_spark.functions.dates import month_start, quarter_label  # noqa: F401
from realty_spark.functions.numeric import (  # noqa: F401
    clip, is_finite, round_half_even, safe_corr, safe_div, significance_flag,
)
