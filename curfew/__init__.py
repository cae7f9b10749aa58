"""Player-session compliance analytics on PySpark.

Raw session logs are cleaned, typed and graded, kept in a day-partitioned fact
table, and answered for by DataFrame functions and streaming queries.
"""
