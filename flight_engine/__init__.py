"""flight_engine: Spark-native analytics over aircraft state data.

Every operator is a pure ``DataFrame -> DataFrame`` function built from
Spark SQL / DataFrame expressions so the same code serves batch jobs,
Structured Streaming micro-batches and tests.
"""

__version__ = "0.1.0"
