"""Operators for preparing training text: packing, deduplication, scans, scores, decontamination.

Nothing outside this folder imports it. Rules shared by all operators:

* A null text counts as the empty text. Texts are read whole, as UTF-8 bytes.
* Rows that share a ``doc_id`` are one document; a null ``doc_id`` is a document of its own that
  sorts before every other.
* Columns an operator does not know are carried along or left out, never interpreted. Where an
  operator adds a column whose name the input already bears, the operator's column replaces it.
  Names that begin with two underscores are the operators' own.
* An empty table gives an empty result of the same shape.
"""
