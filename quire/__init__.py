"""quire: a Spark-native article recommendation pipeline.

The package is a set of DataFrame functions ``f(inputs, params) -> DataFrame``.
Every stage is expressed with DataFrame / Spark SQL / MLlib operators so Catalyst
and AQE pick the physical plan; only single rows and bounded counts reach the
driver (and MLlib's Word2Vec model, where that is asked for).

Layout
------
sources/    readers and adapters that give the driver tables the article and
            behaviour shapes the pipeline works on
functions/  column-level building blocks (text cleaning, time windows, vector
            arithmetic, distributed ranking, size-checked broadcast)
operators/  the pipeline stages (prepare, tokens, tf-idf, profile, vectors,
            similarity, recall)
streaming/  the incremental article update as a Structured Streaming query
sinks/      table writers (partitioned overwrite, keyed upsert, model save)
plans/      jobs that compose the stages, and the query registry used by
            ``__spark_entry__``
"""

__all__ = ["session"]
