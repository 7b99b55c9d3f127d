"""mcqflow: multiple-choice question dataset curation on Spark DataFrames.

Every operator is a DataFrame -> DataFrame function built from Spark SQL
expressions, windows, joins and higher-order functions.  Python code runs
inside tasks only where a user-supplied model or tokenizer is called.
"""

import sys as _sys

from mcqflow.session import get_spark, checkpoint_dir

# Python code shipped to executors (model callables, tokenizer UDFs) is
# pickled by value, so workers need no installed copy of this package.
try:
    from pyspark import cloudpickle as _cp
    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 -- older cloudpickle: ship the package with --py-files
    pass

__all__ = ["get_spark", "checkpoint_dir"]
