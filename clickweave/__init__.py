"""clickweave: a clickstream lakehouse pipeline on PySpark.

Entry points:

* ``clickweave.streaming.ingest.start_bronze_stream`` -- raw (Bronze) stream job
* ``clickweave.plans.silver.run_silver`` -- cleansed (Silver) daily job
* ``clickweave.operators.profile`` / ``clickweave.operators.quality`` -- profile
  queries and contract checks over any event table
* ``python -m clickweave.cli`` -- the same from the command line
"""

__version__ = "0.1.0"
