"""ledgerline: lending-data quality and credit scoring as Spark DataFrame plans.

Sub-packages
------------
sources    readers/writers (CSV, Parquet, catalog tables) and the fixture
           derivation of the four lending relations from the driver tables
functions  column expressions: cleaning rules and credit-score rule tables
operators  DataFrame -> DataFrame operators: duplicate-key split, cleaners,
           scoring joins, the customer-loan mart, data-quality profiles
plans      end-to-end batch job and the registry of checked queries
streaming  incremental ingestion of the row-local cleaners
"""

__all__ = ["session"]
