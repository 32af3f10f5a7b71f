"""lexgrid: text labelling and entity resolution as Spark DataFrame jobs.

Sub-packages
------------
functions   column expressions (cleaning, prompts, token arrays, labels, tiers)
operators   DataFrame -> DataFrame operators that shuffle (ranks, splits,
            batches, vocabularies, metrics, clustering, scoring, training)
sources     readers and writers (CSV, splits, workbooks, submissions)
streaming   the scoring job on a stream
plans       the registered queries bound to the driver tables, with their
            DuckDB twins
"""

from lexgrid.session import build_session, checkpoint_root

__all__ = ["build_session", "checkpoint_root"]
