"""roadlens: road-incident and user-activity analytics on Spark.

Batch operators live in ``roadlens.operators``, scalar Column helpers in
``roadlens.functions``, readers in ``roadlens.sources``, writers in
``roadlens.sinks``, Structured Streaming queries in ``roadlens.streaming``
and the registered checks (Spark query + SQL oracle) in ``roadlens.plans``.
"""

__version__ = "0.1.0"
