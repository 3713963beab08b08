"""One query per training-data operator, their DuckDB SQL where SQL can express them, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cabwh.llm import (
    decontam,
    exact_dedup,
    html_extract,
    importance,
    licenses,
    near_dedup,
    packing,
    pii,
    quality,
    spelling,
    suffix_dedup,
    url_filter,
    warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        near_dedup.op1_near_dedup, html_extract.op2_extract, suffix_dedup.op3_suffix_dedup, quality.op4_quality,
        pii.op5_pii_surrogates, licenses.op6_license_scan, exact_dedup.op7_exact_dedup, packing.op8_pack,
        warc.op9_warc, decontam.op10_decontaminate,
        url_filter.op11_url_filter, importance.op12_importance, spelling.op13_spelling)
}

ORACLE_SQL: dict[str, str] = {"op7_exact_dedup": exact_dedup.SQL, "op9_warc": warc.SQL,
                              "op11_url_filter": url_filter.SQL}
