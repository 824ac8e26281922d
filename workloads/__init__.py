"""Queries that run the library's operators over the supplied tables.

Each module registers pairs: a Spark query and, where SQL can state the same
result, the SQL. Texts the readers need (curve files, model JSON, manifests)
are composed from table columns by Spark, row by row.
"""
