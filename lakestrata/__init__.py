"""Lake table operators on PySpark.

Layers of a snapshot data lake (raw -> trusted -> refined) built from plain
DataFrame operators: reconciliation of what is loaded, harmonisation of
differently laid out sources, data-quality labels, cumulative -> daily series
and a star schema.  Every operator takes and returns a ``DataFrame``.
"""

from lakestrata.session import build_session, scratch_path, tune_for_scale

__all__ = ["build_session", "scratch_path", "tune_for_scale"]
