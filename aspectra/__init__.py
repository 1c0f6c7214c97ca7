"""aspectra — review-stream analytics expressed as Spark DataFrame plans.

Every stateless step is a ``DataFrame -> DataFrame`` function, so the same
code runs as a batch job or inside a Structured Streaming query.
"""

__version__ = "0.1.0"
