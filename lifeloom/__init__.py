"""Customer-lifecycle analytics as DataFrame operators and streaming queries.

Every operator is a function of DataFrames plus an explicit ``as_of`` time and
returns DataFrames; nothing reads the wall clock.  See ``README.md``.
"""

import sys

from pyspark import cloudpickle

# Ship this package's task-side helpers with the task, so that executors need no installation.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
