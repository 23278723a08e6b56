"""Operators for training-data pipelines.

Nothing outside this subpackage imports it.  The Python kernels are imported by name on the executors, so
that a worker process keeps its caches between tasks; ``weirflow.shipping`` sends the package there.
"""
