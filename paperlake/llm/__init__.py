"""Operators for preparing training corpora.

Functions of this package that run inside tasks travel to the workers by
value, so executors need numpy, pyarrow and the tokenizer library, but not
this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
