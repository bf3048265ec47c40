"""sparkcat: catalogue-style entity resolution as DataFrame, SQL and Structured Streaming operators."""
