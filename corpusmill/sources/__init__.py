"""Readers: the source registry, XML corpora, JSONL manifests and file inventories."""
