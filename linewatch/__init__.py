"""linewatch: rail-disruption analytics as PySpark DataFrame operators.

Every operator is a lazy ``DataFrame -> DataFrame`` function built from Spark's
own expressions; the jobs in :mod:`linewatch.plans` compose them into bronze,
silver, gold and notification tables.
"""
