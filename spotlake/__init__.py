"""spotlake: a Spark-native engine for pooled imaging screens and probe design."""
