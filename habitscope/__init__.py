"""User-behaviour analytics as PySpark DataFrame operators.

Layout:

* ``sources``    typed and text CSV / Parquet readers, writers, views, caching, audits
* ``functions``  Column builders: scalar expressions, aggregates, window columns
* ``operators``  DataFrame -> DataFrame: cleaning, encoding, segmentation, reports,
  anomaly classes, exploration, clustering, regression, evaluation, explanation
* ``plans``      the end-to-end jobs over the wide user table
* ``registry``   the queries bound to the Parquet test tables and their SQL twins

Nothing here builds a SparkSession: the caller passes one in (or the DataFrame
carries it), and configuration stays with the caller.
"""

__version__ = "0.1.0"
