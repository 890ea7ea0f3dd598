"""Operators of a training-data pipeline, their named queries and check SQL.

Nothing outside this folder, ``tests/llm`` and ``corpus_pipeline.py`` imports it. Functions that
run in Python workers are sent there whole, so executors need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
