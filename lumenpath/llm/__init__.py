"""Operators of a training-data pipeline: filters, extraction, scoring, deduplication, search and tokenization.

Each module holds one operator with a general DataFrame interface; ``queries`` applies them to the
given tables.  Nothing outside this package imports it.  Functions that run inside tasks travel by
value, so executors need numpy and pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
