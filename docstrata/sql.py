"""The public functions under SQL names, for use inside ``spark.sql``."""

from __future__ import annotations

from pyspark.sql import SparkSession

from docstrata.functions.dates import SIZES
from docstrata.operators.html import digest_of, main_of, text_of, value_udf

_SPANS = {
    "weekly": ("sequence(first, last, interval 7 days)", "date_add(s, 6)"),
    "monthly": ("sequence(trunc(first, 'MM'), last, interval 1 month)", "date_sub(add_months(s, 1), 1)"),
    "quarterly": ("sequence(trunc(first, 'MM'), last, interval 3 months)", "date_sub(add_months(s, 3), 1)"),
}


def register_functions(spark: SparkSession) -> None:
    """Register the session's SQL functions.

    Scalars: ``format_search_date(date)``, ``compute_content_hash(bytes, file_type)``,
    ``normalize_html_content(bytes)``, ``clean_html(bytes)``.  Tables:
    ``monthly_partitions(first, last)`` and its weekly and quarterly siblings.
    """
    spark.udf.register("normalize_html_content", value_udf(text_of))
    spark.udf.register("clean_html", value_udf(main_of))
    spark.udf.register("html_text_digest", value_udf(digest_of))
    spark.sql(
        """CREATE OR REPLACE TEMPORARY FUNCTION compute_content_hash(content BINARY, file_type STRING) RETURNS STRING
        RETURN CASE WHEN file_type IN ('pdf', 'doc') THEN sha2(content, 256)
          ELSE html_text_digest(CASE WHEN coalesce(file_type, '') NOT IN ('pdf', 'doc') THEN content END) END"""
    )
    spark.sql(
        """CREATE OR REPLACE TEMPORARY FUNCTION format_search_date(d DATE) RETURNS STRING
        RETURN date_format(d, 'dd/MM/yyyy')"""
    )
    for size in SIZES:
        starts, full_end = _SPANS[size]
        spark.sql(
            f"""CREATE OR REPLACE TEMPORARY FUNCTION {size}_partitions(first DATE, last DATE)
            RETURNS TABLE (partition_start DATE, partition_end DATE)
            RETURN SELECT greatest(s, first), least({full_end}, last)
              FROM (SELECT explode(CASE WHEN first <= last THEN {starts} END) AS s)"""
        )
