"""lodestar: content-based recommendation and search over document corpora, on Spark.

Every operator takes and returns DataFrames. Sub-packages:

* ``sources``   - driver tables, fixture views, JSON / Parquet / catalog I/O
* ``functions`` - Column-level text helpers (tokenisers, stop words, tag tokens)
* ``operators`` - index, similarity, ranking, search, tags, TF-IDF, dense, LSA
* ``plans``     - end-to-end pipelines (batch build, serving queries)
* ``streaming`` - request streams joined with the materialised recommendations
"""

from lodestar.session import build_session, materialize  # noqa: F401

__all__ = ["build_session", "materialize"]
