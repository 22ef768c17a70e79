"""Multi-stream alignment and response analytics on Spark."""
