"""rtdw: a real-time data warehouse for online-shop data, built on Spark.

Layers, each a set of ``DataFrame -> DataFrame`` functions:

* ``functions``  column expressions (time, text, codes, names)
* ``sources``    topic, change-record and dimension readers
* ``operators``  parsing, routing, keyed rules, joins, statistics
* ``streaming``  the same operators run as Structured Streaming jobs
* ``sinks``      topic, dimension and OLAP writers
* ``plans``      the operators applied to the sample tables, with check SQL
"""
