"""Incremental refresh with Structured Streaming.

Every sink writes one folder per micro-batch, ``<table>/batch_id=N``, and
replaces that folder when Spark replays the batch. A failure between the write
and the commit therefore changes nothing: results stay exactly-once.
"""
