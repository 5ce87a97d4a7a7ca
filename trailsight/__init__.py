"""Analytics over places ("items") and the visits people log on them, as Spark jobs.

Layers, lowest first:

* ``functions``  column expressions: fixed domains, scopes, periods, text and page parsing
* ``operators``  DataFrame -> DataFrame building blocks
* ``sources``    readers and writers
* ``plans``      published reports and the views used as test fixtures
* ``streaming``  incremental ingest with Structured Streaming
"""
