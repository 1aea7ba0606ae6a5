"""Readers and writers: JSON-lines batches and manifests, generator, metadata scans, testdata proxy."""
