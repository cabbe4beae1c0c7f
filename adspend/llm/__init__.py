"""Operators of a training-data pipeline over the documents, embeddings and
conversations tables.

One module per operator (``op01_...`` to ``op13_...``), ``registry.py`` with the named
queries and their SQL, ``common.py`` with shared helpers. Nothing else in the library
imports this subpackage.

Functions of this subpackage that run inside tasks are pickled by value, so executors
need the third-party libraries only, not this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
