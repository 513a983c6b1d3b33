"""Operators for preparing training data: tokens, near duplicates, quality, mixing, packing, shards.

Every operator takes and returns frames. Work is dealt out by Spark; Python
runs inside tasks on Arrow batches of bounded size, and intermediate tables go
to the shared folder (:func:`corbel.sources.scratch.scratch_path`).
"""
