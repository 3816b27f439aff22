"""Operators for preparing training data from web-scale text.

Functions that run in tasks travel with the tasks, so executors need not have this
package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
