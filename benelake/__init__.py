"""benelake: Spark-native beneficiary analytics.

Lakehouse (DataFrame API) and warehouse (Spark SQL) paths over an annual
person-level coverage summary, reconciled against each other, plus cohort
exploration, dashboard tiles, profiling, sampling and data-quality checks.
"""

__version__ = "0.1.0"
