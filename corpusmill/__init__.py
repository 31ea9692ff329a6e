"""corpusmill: a Spark-native toolkit for preparing low-resource-language corpora.

Every operator is a function from DataFrame(s) to a DataFrame built on Spark's
own expressions, aggregates and joins.  Sub-packages:

* ``functions`` - column expressions (text normalisation, float parsing, hashing, URLs)
* ``sources``   - readers: source registry, XML corpora, JSONL, file inventories
* ``operators`` - examples table, dedupe, manifests, splits, summaries, speech, model data
* ``sinks``     - JSONL / CSV / markdown / LJSpeech writers
* ``plans``     - composite jobs (extract, split, stats, prepare-tts) and the test-table adapter
"""

__version__ = "0.1.0"

# Python UDFs of this package (NFC, byte decoding, XML root attributes) are shipped
# to the workers by value, so executors need not have the package installed or on
# their path.
try:  # pragma: no cover - depends on the pyspark build
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass
