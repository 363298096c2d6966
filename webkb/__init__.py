"""webkb: a Spark-native web-corpus to knowledge-base pipeline.

Pages, assets and fetch logs are tables; crawling, element projection,
content transforms, keyed sinks and search are DataFrame plans.
"""

from __future__ import annotations

import sys

# Python steps (HTML parse, Markdown, PDF text) are shipped to the Python
# workers by value, so executors need no installed copy of this package.
try:  # pragma: no cover - depends on the pyspark build
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass

__all__ = ["__version__"]
__version__ = "0.1.0"
