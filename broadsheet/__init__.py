"""News-article processing on Spark: collect, clean, analyse and vectorise.

Every operator is a function from DataFrame to DataFrame (or Column to Column),
so the pieces compose with ``DataFrame.transform`` and Catalyst sees one plan.
"""

import sys

from pyspark import cloudpickle

from broadsheet.schema import ARTICLE_COLUMNS, ARTICLE_SCHEMA

__all__ = ["ARTICLE_COLUMNS", "ARTICLE_SCHEMA"]

# Functions travel to the Python workers by value: executors need no copy of this
# package, only the libraries it uses.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
