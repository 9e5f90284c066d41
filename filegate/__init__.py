"""filegate - file-drop completeness tracking on Spark DataFrames.

Entry points: ``filegate.plans.jobs`` (``run_ingest``, ``run_evaluate``, ``run_dispatch``,
``run_cycle``), ``filegate.streaming.ingest.run_ingest_stream``; operators live in
``filegate.operators``, column rules in ``filegate.functions``, readers and the
control-table store in ``filegate.sources``.
"""

__version__ = "0.1.0"
