"""Operators for building a training corpus.

Each module holds one operator with its own general interface; the thin
``opN_*`` queries that apply them to the test tables are in
:mod:`audix.llm.catalogue`, their SQL twins in :mod:`audix.llm.oracle`.
Nothing outside this package imports it, apart from the guarded hook in
``__spark_entry__.py`` and the pipeline in ``corpus_pipeline.py``.
"""
