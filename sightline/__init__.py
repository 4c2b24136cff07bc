"""sightline: camera-detection analytics on Spark DataFrames.

Frames and detection records come in from batch tables or Structured
Streaming sources; every operator is a plain ``DataFrame -> DataFrame``
transform so the same code serves batch and streaming.
"""

from sightline.session import checkpoint_dir, get_spark

__all__ = ["get_spark", "checkpoint_dir"]
