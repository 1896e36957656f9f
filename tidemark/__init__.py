"""tidemark: tables, topics and JSON documents as Spark DataFrames.

The library moves rows between SQL tables, message topics and document
stores, and counts what it finds on the way.  Everything is a plain
``DataFrame -> DataFrame`` function; most work unchanged on batch and stream.

* ``tidemark.sources``   - topics, tables, result pages, document collections
* ``tidemark.functions`` - column expressions: decoding, JSON text, ISO times
* ``tidemark.operators`` - parsing, counting, polling, topic statistics
* ``tidemark.streaming`` - sinks, quarantine, KPI stores, running queries
* ``tidemark.plans``     - end-to-end flows and the registered queries
"""

from tidemark.session import build_session, configure, run_dir

__all__ = ["build_session", "configure", "run_dir"]
