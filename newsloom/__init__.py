"""News analytics over Spark DataFrames: feeds per topic, clusters, language, compression and their sinks."""
