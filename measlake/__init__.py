"""measlake: linked measurement tables built with Spark DataFrames.

Sources read text, JSON and Parquet collections; functions are column
expressions; operators take and return DataFrames; plans join them into the
four linked tables; sinks write them.
"""
