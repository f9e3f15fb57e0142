"""pickwise: product-recommendation analytics as Spark DataFrame jobs.

Every operator is a function from DataFrames to DataFrames. The working shape
of a recommendation table is long form ``(key, product_id, score)``; nesting
into ``recs`` arrays happens last, in :func:`pickwise.operators.topk.to_recs`.
"""

from pickwise.session import checkpoint_root, get_session, scratch_path

__all__ = ["get_session", "checkpoint_root", "scratch_path"]
