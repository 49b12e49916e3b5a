"""Operators for preparing language-model training text.

Nothing else in the library imports this subpackage. Shared rules of all its operators:

* only the columns an operator names are read, so extra columns never clash;
* a null text counts as empty unless the operator says otherwise;
* a row without ``doc_id`` keeps its own results but is never compared with other documents;
* repeated rows get the same result each, and documents are told apart by ``doc_id``, with a
  hash of the text beside it where positions inside a text travel on their own.
"""

import sys

from pyspark import cloudpickle

# Functions run by tasks travel whole, so that executors need not have the library installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
