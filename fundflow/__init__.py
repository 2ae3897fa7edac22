"""Fund price and transaction feeds as Spark DataFrame operators.

The package never builds a session, never changes a caller's settings and
prints nothing. Sessions are expected to run with
``spark.sql.session.timeZone=UTC``: message days and payload times are read in
the session zone.
"""
