"""Operators for preparing training text: mixing, deduplication, extraction, scanning, packing.

Their functions travel to the executors by value, so that these need not have the
package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
