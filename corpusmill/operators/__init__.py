"""DataFrame operators: examples table, dedupe, manifests, splits, summaries,
speech datasets and model data.  Each takes and returns DataFrames; keys are
passed as Columns."""
