"""roadlog: connected-vehicle telemetry analytics as plain Spark DataFrame functions.

Every operator takes DataFrames and returns DataFrames.  Nothing in this
package runs an action while a plan is being built; the only eager parts are
the sinks, the streaming starters and the job functions in ``roadlog.plans``
that write their results.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# The few functions that run inside tasks travel with the job, so executors do
# not need the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
