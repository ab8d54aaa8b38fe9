"""raceline: motorsport timing analytics on Spark DataFrames.

Layout
------
sources/    raw-table readers: JSON landing files, resume ledgers, and the
            mapping of the benchmark parquet tables onto the raw timing tables
operators/  reusable DataFrame operators (conform, dedup, incremental anti
            joins, session filters, hour chunks, interval join, data checks)
functions/  column expressions (null-ignoring concat, decimal rounding, ...)
plans/      the model DAG: staging -> intermediate -> marts, plus the
            dataset loaders built from the operators
llm/        operators that prepare language-model training data (optional)
"""

__all__ = ["session", "schemas"]
