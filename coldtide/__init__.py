"""Spark-native analytics over the cold-storage buckets of a log platform.

The package reads bucket trees where they lie (shared file system or object
store), prunes whole buckets, decodes their event journals on the executors
and hands Arrow batches to Spark; everything relational above the scan is left
to Catalyst.
"""

__version__ = "0.1.0"
