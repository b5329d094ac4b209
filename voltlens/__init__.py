"""voltlens: meter-anomaly analytics expressed as Spark DataFrame plans.

Sub-packages:
    sources    scans, typed loaders, JSON ingest, JDBC and file sinks, model store
    functions  scalar expressions: null tokens, lenient casts, parsing, schema helpers
    operators  dedupe, EAV widening, joins, profiles, features, fuzzy c-means,
               classification, evaluation metrics and statistics
    plans      composite jobs (dataset build, cleaning, training, scoring, publishing)
               and the analogue tables used by the query catalog
    streaming  file-stream variant of the API ingest
"""

from voltlens.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
