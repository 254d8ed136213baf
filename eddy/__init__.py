"""eddy: comment-stream analytics on Spark DataFrames and Structured Streaming.

Every operator is a ``DataFrame -> DataFrame`` function, so the same code runs
over a static table and, through ``foreachBatch`` or a streaming plan, over a
live stream.  Sub-packages:

- ``eddy.sources``   readers, message codecs, topic model, sinks
- ``eddy.functions`` column expressions (tokenizer, time conversion, defaults)
- ``eddy.operators`` set-based operators (keywords, sentiment, language,
  validation, report, latency)
- ``eddy.plans``     fused plans and the registered query catalog
- ``eddy.streaming`` Structured Streaming jobs built from the operators
"""

__version__ = "0.1.0"
