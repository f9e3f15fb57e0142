"""Training-data operators: quality, near-duplicates, mixing, licenses, chat, decontamination, WARC.

Nothing else in the library imports this subpackage. Each operator is a
function from DataFrames to DataFrames with its own general interface;
:mod:`pickwise.llm.queries` registers the thin ``opN_<name>`` queries.

Functions that run on workers are shipped by value, so executors need numpy,
pyarrow, xxhash and zstandard, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
