"""Shopping-behaviour analytics on Spark.

DataFrame in, DataFrame out: every operator declares a plan and leaves physical
decisions to Catalyst and adaptive execution.

* ``functions``  - Column expressions (log parsing, item hierarchy, periods, vectors)
* ``sources``    - readers, writers, and the adapters from the TPC-H-like test tables
* ``operators``  - the recommendation and log-statistics dataflows
* ``plans``      - whole jobs (input paths to output tables) and the query registry
* ``streaming``  - the per-minute API traffic on a stream
"""
