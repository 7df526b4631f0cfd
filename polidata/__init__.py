"""polidata: Spark-native building blocks for a public-affairs data warehouse.

Every public function maps a DataFrame (or Columns) to a DataFrame (or Column)
and stays lazy: nothing is collected to the driver.  Sub-packages:

* ``functions``  - Column expressions (null-strict aggregates, text, dates, codes)
* ``operators``  - DataFrame -> DataFrame operators (reshape, windows, joins,
                   aggregates, data quality, entity matching, geometry)
* ``sources``    - readers and writers (CSV families, fixed width, JSON, HTML
                   pages, header detection) with explicit schemas
* ``plans``      - the query catalogue and the composed pipelines

"""

from polidata.session import get_spark, checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir"]
