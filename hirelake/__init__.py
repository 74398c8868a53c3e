"""hirelake: a Spark-native job-postings analytics library.

Layers: ``functions`` (column expressions), ``operators`` (DataFrame ->
DataFrame), ``sources`` (readers / writers), ``plans`` (the postings profile
and the star schema), ``streaming`` (incremental file ingestion).
"""

__version__ = "0.1.0"
