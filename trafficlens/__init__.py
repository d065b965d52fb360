"""trafficlens: packet traffic analytics on Spark (capture decoding, profiling,
classification pipelines, evaluation and cluster-metric questions)."""

__version__ = "0.1.0"
