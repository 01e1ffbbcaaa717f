"""Training-data operators: near duplicates, token counts, decontamination,
language models, language ID, quality, packing, chat rendering, personal data
and license scans. Nothing else in the library imports this subpackage.

The Python kernels of these operators are shipped to the workers by value, so
a cluster needs no copy of the repository on its executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
