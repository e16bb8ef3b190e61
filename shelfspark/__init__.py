"""shelfspark: a retail medallion (bronze -> silver -> gold) analytics library on Spark.

Every operator is a plain ``DataFrame -> DataFrame`` or ``Column -> Column``
function built from Spark SQL built-ins, so Catalyst plans, prunes and
codegens the whole chain.  Sub-packages:

``functions``  column-level cleaning, parsing, keys and derived metrics
``operators``  dedup, windows, joins, incremental loads, SCD2, data checks
``sources``    landing JSON discovery and bronze projection, freshness, sinks,
               and the retail roles derived from the TPC-H-style test tables
``plans``      silver, inventory, campaign, gold dimension/fact and report builders
``streaming``  file-stream ingestion of a landing folder into bronze
"""

__version__ = "0.1.0"
