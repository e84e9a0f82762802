"""farebox: a Spark-native lake-to-star batch pipeline.

Every stage is a ``DataFrame -> DataFrame`` function built from Spark SQL
built-ins, so Catalyst sees one plan per job and can prune, push down and
pick join strategies by itself.
"""

from farebox.params import PipelineParams

__all__ = ["PipelineParams"]
