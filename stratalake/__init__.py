"""Lake analytics on Spark: bronze views, silver and gold models, marts, checks and governance.

Every public operator takes DataFrames and returns a DataFrame. Nothing reads the clock: operators that
depend on "today" take an ``as_of`` argument.
"""

import sys

from pyspark import cloudpickle

from stratalake.session import build_session

# Functions sent to executors carry their code, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session"]
