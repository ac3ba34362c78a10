"""matchday: event and minute-series analytics on Spark DataFrames.

Every operator takes and returns ``pyspark.sql.DataFrame`` objects and is built
from Spark SQL expressions, joins, aggregations, windows and ``pyspark.ml``.
Nothing is collected to the driver inside an operator.

Layout
------
``sources``    reading tables; fixture views over the driver tables
``functions``  column expressions shared by the operators
``operators``  the user-level operators (results, standings, passing, top-n,
               presence, plus-minus, measurements, classification, evaluation)
``plans``      end-to-end queries (sf_dir -> DataFrame) and their SQL oracles

``python -m matchday --list`` lists the registered queries and runs any of
them.  ``llm`` holds the operations of a training-data pipeline; nothing else
in the library imports it.
"""

from matchday.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
