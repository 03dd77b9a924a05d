"""Training-data operators: each module holds one operator, ``queries``
binds them to the landed tables, ``oracle`` states them in SQL where SQL
can.  Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# task functions travel by value, so executors need no installed copy
cloudpickle.register_pickle_by_value(sys.modules[__name__])
