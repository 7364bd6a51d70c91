"""Operators for training corpora. Nothing else in the library imports this subpackage.

Python runs on the executors here, so the package must be importable there
(``spark.submit.pyFiles``, or installed on the machines).
"""
