"""Training-data operators: tokenising, deduplication, scoring, mixing, sharding.

Nothing else in the library imports this package; ``queries.py`` registers one
query per operator.  Conventions shared by every operator:

* it selects the key and text columns it needs under private names first, so
  extra columns of the input (whatever their names) cannot clash;
* a null text counts as the empty text, a null key is a key of its own;
* an empty table gives an empty result with the documented columns;
* repeated rows are separate rows and each gets its own result row.
"""
