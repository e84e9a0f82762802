"""Operators of a training-data pipeline: tokenising, packing, quality and
toxicity scores, secret scans, near- and substring-duplicates, vector search.

Nothing outside this subpackage imports it (``__spark_entry__.py`` adds its
queries when it can be imported, ``corpus_pipeline.py`` chains five of them).

Conventions shared by all operators:

* rows are rows: a repeated row gets the same answer as its first copy, extra
  columns are ignored, a null text counts as empty unless stated otherwise;
* Python runs only inside Arrow-batched tasks; work on a batch is vectorised;
* tables that are read more than once are written below
  ``spark.checkpoint.dir`` (:func:`farebox.llm.runtime.stored`).
"""
