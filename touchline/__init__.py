"""touchline: a PySpark-native match-data lakehouse library.

Raw (bronze) JSON -> cleaned (silver) matches and standings -> report (gold)
tables: team form, match results, league standings, head-to-head, plus
data-quality checks, snapshot history and point-in-time reads.

Every operator is a plain ``DataFrame -> DataFrame`` function built from
built-in Spark expressions; nothing runs per-row Python.
"""

__version__ = "0.1.0"
