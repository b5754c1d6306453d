"""farelens: ride-record analytics as Spark DataFrame operators.

Pure ``DataFrame -> DataFrame`` functions shared by batch and Structured
Streaming: load rides under a fixed schema, clean them in counted steps,
derive calendar features, tag zones, slice by time, aggregate fares,
measure distances and densities, and apply keyed change batches.
"""

__version__ = "0.1.0"
