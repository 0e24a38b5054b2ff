"""Training-data operators: scans, classifiers, tokenizing, mixing,
fingerprints, similarity joins, sharding and de-duplication of text corpora.

Nothing outside this package imports it.  ``queries.QUERIES`` and
``queries.ORACLE_SQL`` hold its registered jobs.
"""
