"""Training-data operators: near-duplicates, line and passage dedup, quality, language, extraction, licences, mixing.

Nothing outside this subpackage imports it; `corpus_pipeline.py` chains five of its operators.
"""

import sys

from pyspark import cloudpickle

# Functions for tasks travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
