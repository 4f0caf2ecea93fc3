"""quarry: corpus preparation and evaluation as Spark DataFrame jobs.

Every operator is a function ``DataFrame -> DataFrame`` (or a column
expression builder) so that Catalyst sees one declarative plan. Python
workers are used only where a user plugs in a model, tokenizer or decoder,
and for the block-wise similarity kernel of semantic clustering.
"""

import sys as _sys

try:  # ship quarry's Python helpers to executors with the closures that use them
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle: the package must then be installed on executors
    pass

from quarry.session import get_spark, shared_dir  # noqa: E402

__all__ = ["get_spark", "shared_dir"]
