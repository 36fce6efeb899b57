"""Operators of a training-data pipeline over tables of documents.

Every operator takes DataFrames and returns DataFrames; the general interface
is in the module of the operator, the registered queries in
``roadlog.llm.queries``.  Common to all of them:

* A null text counts as empty.  A null ``doc_id`` is a value like any other.
* Columns that an operator does not name are ignored, whatever they are called.
* Empty tables give empty results of the same schema.
* Intermediate tables are Parquet below the folder named by
  ``spark.checkpoint.dir`` (``roadlog.workspace``), so a lost executor costs a
  re-read and not a different answer.
"""
