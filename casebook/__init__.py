"""Linked event histories as Spark jobs.

``functions``  expressions: they take and return a ``Column``
``operators``  relational steps: ``DataFrame`` in, ``DataFrame`` out, no action inside
``sources``    readers and writers
``plans``      the composite jobs that chain the operators into products
"""
