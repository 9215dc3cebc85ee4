"""millrace: composable PySpark operators for text, log, report, stream and learning jobs.

Every operator is a function from DataFrame to DataFrame. Planning and execution
stay with Catalyst, AQE and Structured Streaming.
"""
