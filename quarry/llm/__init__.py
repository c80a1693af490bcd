"""Operators for preparing language-model training data.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it; the entry
module adds its queries when the folder is there.
"""

import sys

from pyspark import cloudpickle

# functions that run in Python workers are sent with the task, so executors need no install
cloudpickle.register_pickle_by_value(sys.modules[__name__])
