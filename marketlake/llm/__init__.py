"""Training-data operators at corpus scale: decontamination, deduplication, search, scoring, packing.

One module per operator; ``queries`` registers them. Shared helpers: ``blocks`` (Arrow text batches as numpy
arrays: words, hashes, shingles), ``tables`` (shared tables that cut lineage), ``ranks`` (gapless numbers
without a global sort), ``components`` (distributed union-find). Nothing else in the library imports this.
"""

import sys

from pyspark import cloudpickle

# tasks carry the code that they run: executors need no copy of this package on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])
