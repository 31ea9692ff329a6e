"""Writers for JSONL, CSV, markdown and LJSpeech metadata.  All go through
Spark's file sources and their commit protocol (atomic publish of a folder)."""
