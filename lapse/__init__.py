"""lapse: retention and churn analytics as Spark DataFrame operators.

Layout: ``sources`` (stored tables, derived domain views, document readers),
``functions`` (column expressions), ``operators`` (reusable distributed
building blocks), ``plans`` (the reports), ``streaming`` (incremental event
cleaning), ``oracle`` (DuckDB SQL used only by the correctness checks).
"""

__version__ = "0.1.0"
