"""Training-data operators: filtering, deduplication, decontamination, mixing, formatting and scoring.

Every operator takes DataFrames and returns DataFrames; nothing else in the
library imports this subpackage. Common rules, unless an operator says
otherwise: a null text is an empty text, rows are judged one by one (repeated
rows give repeated results), columns other than the named ones are carried or
ignored but never clash with the operator's own, and an empty input gives an
empty result of the same schema.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the Python workers by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
